"""Steps that count rows in an order do so without whole rows in one task."""

from __future__ import annotations

from test_queries import DATA

from talkloom.operators import evaluation, select, selection
from talkloom.plans import registry


def test_split_leakage_splits_digests(spark, monkeypatch):
    seen, split = [], select.split
    monkeypatch.setattr(select, "split", lambda rows, *a: (seen.append(rows.columns), split(rows, *a))[1])
    assert registry.queries()["split_leakage"](spark, DATA).count() == 1
    assert seen == [["doc_id", "digest"]]


def test_ranges_of_wide_rows_are_short(spark, tmp_path):
    placed = selection.numbered(spark.range(100_000).selectExpr("100000 - id as k"), ["k"], "pos", str(tmp_path / "n"))
    assert placed.where("pos <> k - 1").count() == 0
    assert len(list((tmp_path / "n/placed").glob("part-*"))) == 4


def test_details_are_numbered_without_their_texts(spark, monkeypatch):
    """Sparse, negative and repeated indexes too."""
    seen, numbered = [], selection.numbered
    monkeypatch.setattr(selection, "numbered", lambda rows, *a: (seen.append(rows.columns), numbered(rows, *a))[1])
    ids = [-5, 1 << 40, 3, 3, 10]
    samples = spark.createDataFrame([(i, f"t{i}", "g") for i in ids], "sample_index long, raw_transcript string, gold_label string")
    out = spark.createDataFrame([(i, "o", 1.0) for i in set(ids)], "sample_index long, text string, duration_ms double")
    judged = spark.createDataFrame([(i, {}, {}) for i in set(ids) - {10}], "sample_index long, baseline_scores map<string,double>, candidate_scores map<string,double>")
    rows = evaluation.detail(samples, out, out, judged).orderBy("sample_index").collect()
    assert [(r["sample_index"], r["raw_transcript"]) for r in rows] == list(enumerate(["t-5", "t3", "t3", f"t{1 << 40}"]))
    assert seen == [["sample_index"]]

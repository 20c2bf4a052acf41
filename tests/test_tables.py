from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from talkloom import schemas
from talkloom.functions.text import md5_int
from talkloom.operators import dataset, evaluation, resampling, responders, select, upsert
from talkloom.sources import jsonl, sinks
from talkloom.sources import text as text_source
from talkloom.streaming import ingest


def write(path, lines):
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n", encoding="utf-8")
    return str(path)


def test_lenient_scan(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", [{"request_id": "a", "label": "1"}, "", "   ", "{bad", {"x": 2}, "[1]", {"request_id": "b", "label": 5}, {"request_id": "a", "label": "2"}])
    rows = jsonl.scan_keyed(spark, path).orderBy("pos").select("request_id", "label").collect()
    assert [tuple(r) for r in rows] == [("a", "2"), ("b", "5")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jsonl.scan_lines(spark, str(tmp_path / "none.jsonl"))


def test_files_keep_the_order_in_which_they_are_given(spark, tmp_path):
    paths = [write(tmp_path / f"{n}.jsonl", [{"request_id": f"{n}{i}"} for i in range(3)]) for n in "bca"]
    rows = jsonl.scan_lenient(spark, paths, "request_id string").orderBy("pos").collect()
    assert [r["request_id"] for r in rows] == [f"{n}{i}" for n in "bca" for i in range(3)]


def test_strict_scan_fails_on_a_bad_line(spark, tmp_path):
    row = {"request_id": "a", "request_json_valid": True, "response_json_valid": True}
    good = write(tmp_path / "good.jsonl", [row, row | {"request_id": "b", "response_json_valid": None}])
    assert [r["request_id"] for r in jsonl.scan_log(spark, good).collect()] == ["a"]
    bad = write(tmp_path / "bad.jsonl", [row, "{bad"])
    with pytest.raises(Exception, match="(?i)malformed"):
        jsonl.scan_log(spark, bad).collect()


def test_eval_samples_and_cache(spark, tmp_path):
    block = lambda role, t: {"role": role, "content": [{"type": "text", "text": t}]}
    path = write(tmp_path / "eval.jsonl", [{"messages": [block("system", "s"), block("user", "<TRANSCRIPT> t </TRANSCRIPT>"), block("assistant", "g")]}, {"messages": [block("system", "s"), block("user", " plain "), block("assistant", "g2")]}])
    rows = jsonl.scan_eval_samples(spark, path).orderBy("pos").collect()
    assert [(r["raw_transcript"], r["gold_label"], r["custom_vocabulary"]) for r in rows] == [("t", "g", ""), ("plain", "g2", "")]
    cache = write(tmp_path / "cache.jsonl", [{"raw_transcript": "t", "baseline_scores": {}, "candidate_scores": {}, "baseline_output": "old"}, {"raw_transcript": "t", "baseline_scores": {}, "candidate_scores": {}, "baseline_output": "new"}, {"raw_transcript": "u", "baseline_scores": {}}])
    assert [(r["raw_transcript"], r["baseline_output"]) for r in jsonl.scan_cache(spark, cache).collect()] == [("t", "new")]


def test_upsert(spark):
    old = spark.createDataFrame([("a", 1, 0), ("b", 1, 1), ("a", 2, 2)], "request_id string, v int, pos int")
    new = spark.createDataFrame([("c", 1, 0), ("b", 5, 1)], "request_id string, v int, pos int")
    once = upsert.upsert(old, new)
    assert sorted((r["request_id"], r["v"]) for r in once.collect()) == [("a", 2), ("b", 5), ("c", 1)]
    assert sorted(map(tuple, upsert.upsert(once, new).select("request_id", "v").collect())) == [("a", 2), ("b", 5), ("c", 1)]


def test_split_is_exact_and_disjoint(spark):
    for n, expected in ((1, 0), (9, 0), (10, 1), (29, 2), (1611, 161)):
        rows = select.split(spark.range(n), "id").collect()
        assert len(rows) == n and sum(r["part"] == "eval" for r in rows) == expected


def test_selection_order(spark):
    log = spark.createDataFrame([(f"r{i}", i, "x" * (i % 4)) for i in range(10)], "request_id string, pos int, response_text string")
    done = spark.createDataFrame([("r3",), ("r7",)], "request_id string")
    assert [r["request_id"] for r in select.select_for_labelling(log, done, [], True, False, 2, 0).collect()] == ["r2", "r6"]
    assert [r["request_id"] for r in select.select_for_labelling(log, done, ["r3"], True, False, 0, 1).collect()] == ["r3"]
    assert select.select_for_labelling(log, done, ["r3"], False, False, 0, 0).count() == 0


def test_eligible_ignores_validation_unless_asked(spark):
    rows = spark.createDataFrame([("a", True, ("fail", None, None)), ("syn-001", None, None), ("c", False, None)], "request_id string, manually_reviewed boolean, validation struct<status:string,type:string,reason:string>")
    assert {r["request_id"] for r in dataset.eligible(rows).collect()} == {"a", "syn-001"}
    assert {r["request_id"] for r in dataset.eligible(rows, exclude_failed=True).collect()} == {"syn-001"}


def test_bucket_bounds(spark):
    counts = spark.createDataFrame([(n,) for n in (0, 49, 50, 99, 100, 199, 200, 499, 500)], "words long")
    assert [r["n"] for r in dataset.length_distribution(spark, counts).collect()] == [2, 2, 2, 2, 1]
    assert [r["pct_n"] for r in dataset.length_distribution(spark, counts.limit(0)).collect()] == [0.0] * 5


def test_synthetic_rows(spark):
    assigned = spark.createDataFrame([(1, "<RAW_TRANSCRIPT> r </RAW_TRANSCRIPT><CLEAN_TRANSCRIPT> c </CLEAN_TRANSCRIPT>"), (2, "no tags")], "index long, reply string")
    rows = dataset.synthetic_rows(assigned, "reply", "p", "v", "m").collect()
    assert [(r["request_id"], r["label"]) for r in rows] == [("syn-001", "c")]


def test_latency_and_wilcoxon(spark):
    stats = evaluation.latency(spark.createDataFrame([(1.0,), (2.0,), (4.0,), (0.0,)], "d double"), "d").first()
    assert abs(stats["p90"] - 3.6) < 1e-9 and abs(stats["avg"] - 7 / 3) < 1e-9
    assert evaluation.latency(spark.createDataFrame([(0.0,)], "d double"), "d").first()["p50"] == 0.0
    many = spark.range(1, 1001).select(F.col("id").cast("double").alias("d"))
    assert abs(evaluation.latency(many, "d", accuracy=1000).first()["p90"] - evaluation.latency(many, "d").first()["p90"]) <= 2
    diffs = [1, -2, 2, 3, -3, 3, 4, 5, 0, 6, 7, -1]
    row = evaluation.with_p(evaluation.wilcoxon(spark.createDataFrame([(float(d),) for d in diffs], "d double"))).first()
    sizes = sorted(abs(d) for d in diffs if d)
    rank = {s: sum(i + 1 for i, x in enumerate(sizes) if x == s) / sizes.count(s) for s in sizes}
    assert row["w_plus"] == sum(rank[abs(d)] for d in diffs if d > 0) and row["n"] == 11 and 0 < row["p"] < 1
    assert evaluation.wilcoxon(spark.createDataFrame([(1.0,)], "d double")).first()["z"] is None


def test_bootstrap_and_permutation(spark):
    values = [random.Random(i).gauss(1, 1) for i in range(40)]
    diffs = spark.createDataFrame(list(enumerate(values)), "pos long, d double")
    ci = resampling.bootstrap_ci(diffs, 400).first()
    assert ci["low"] < sum(values) / 40 < ci["high"]
    assert resampling.permutation_p(diffs, 400).first()["p"] < 0.05


def test_coins(spark):
    got = spark.range(12).select(responders.mersenne_coin(F.col("id") + 42).alias("c")).collect()
    assert "".join("b" if r["c"] else "c" for r in got) == "cbbbcbcbbbcc"
    assert spark.range(1).select(md5_int(F.lit("42:1")).alias("x")).first()["x"] == 1494077868


def test_responders(spark):
    rows = spark.createDataFrame([("p1",), ("p2",)], "prompt string")

    def answer(prompt: str) -> str:
        if prompt == "p2":
            raise ValueError("refused")
        return prompt.upper()

    called = {r["prompt"]: (r["reply"], r["error"]) for r in responders.Call(answer).respond(rows, "prompt").collect()}
    assert called == {"p1": ("P1", None), "p2": ("", "refused")}
    replies = rows.where("prompt = 'p1'").select(responders.prompt_key(F.col("prompt"), "m").alias("key"), F.lit("yes").alias("reply"), F.lit(1.0).alias("duration_ms"))
    replayed = {r["prompt"]: r["reply"] for r in responders.Replay(replies, "m").respond(rows, "prompt").collect()}
    assert replayed == {"p1": "yes", "p2": None}


def test_ini_and_versions(spark, tmp_path):
    path = write(tmp_path / "models.ini", ["[*]", "c = 1", "; note", "[a]", "m = x=y", "c = 2", "[b]"])
    assert {(r["section"], r["key"]): r["value"] for r in text_source.read_ini(spark, path).collect()} == {("a", "c"): "2", ("a", "m"): "x=y", ("b", "c"): "1"}
    assert sinks.next_version(spark.createDataFrame([], "name string"), "m").first()["next_v"] == 1


def test_snapshot_only_when_changed(spark, tmp_path):
    rows = spark.range(5)
    path = sinks.snapshot(spark, rows, str(tmp_path), "2020-01-01", None)
    last = spark.read.schema("id long").json(path)
    assert sinks.snapshot(spark, rows.repartition(3), str(tmp_path), "2020-01-02", last) is None
    assert sinks.snapshot(spark, spark.range(6), str(tmp_path), "2020-01-02", last) is not None


def test_log_stream_appends(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "a.jsonl", [{"request_id": "a"}, {"request_id": "b"}])
    stream = ingest.read_log_stream(spark, str(tmp_path / "in"))
    ingest.append_log(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.schema(schemas.REQUEST_LOG).json(str(tmp_path / "out")).count() == 2

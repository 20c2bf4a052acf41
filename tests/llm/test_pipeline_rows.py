"""The pipeline's decisions by row: null ids, repeated rows, ids with two texts, empty tables."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
import pytest
from test_text_operators import DATA

#: The columns of documents, and others that clash with names the stages use.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, Known int, accepted string, component_id int"
A = "one two three four five six seven eight nine ten eleven twelve"
B = "red orange yellow green blue indigo violet black white grey brown pink"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "web", len(t or ""), "r", 1, "a", 2) for i, t in rows], SCHEMA)


def kept(stage, spark, rows):
    docs = table(spark, rows)
    got = stage(spark, docs, DATA)
    assert got.columns == docs.columns and {tuple(r)[5:] for r in got.collect()} <= {("r", 1, "a", 2)}
    return Counter((r["doc_id"], r["text"]) for r in got.collect())


def test_duplicates_go_by_row(spark):
    rows = [(1, A), (1, A), (None, A), (None, B), (None, B), (7, "lone words here"), (7, A), (8, ""), (8, ""), (9, None), (9, None), (8, None)]
    want = [(1, A), (None, B), (7, "lone words here"), (8, ""), (9, None), (8, None)]
    assert kept(corpus_pipeline.deduplicate, spark, rows) == Counter(want)


def test_contaminated_rows_go_by_row(spark):
    passage = next(r["text"] for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect() if len((r["text"] or "").split()) >= 10)
    rows = [(None, f"see {passage} there"), (None, A), (5, passage), (5, B), (6, B), (6, B)]
    assert kept(corpus_pipeline.decontamination, spark, rows) == Counter([(None, A), (5, B), (6, B), (6, B)])


def test_first_stages_keep_repeated_and_nameless_rows(spark):
    text = spark.read.parquet(f"{DATA}/documents.parquet").where("lang = 'en'").orderBy("doc_id").first()["text"]
    rows = [(None, text), (1, text), (1, text), (2, None), (3, ""), (4, "12 34"), (5, text * 200)]
    want = Counter([(None, text), (1, text), (1, text), (5, text * 200)])
    assert kept(corpus_pipeline.language_id, spark, rows) == want
    assert kept(corpus_pipeline.quality_filter, spark, rows) == Counter(rows)  # no document has labels of both classes


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:4]])
def test_empty_table(spark, stage):
    assert kept(stage, spark, []) == Counter()

"""Rows that could take a task down: nested exceptions, malformed expressions, many rows of one id."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import functions as F

from talkloom.llm import fingerprint, license_scan, quality, warc


def scan(text):
    n = license_scan.scan_text(text.encode(), license_scan.build_automaton(), license_scan.build_tag_automaton())
    return {"labels": n[5], "expressions": n[7], "permitted": n[8]}


def test_with_joins_one_licence_and_one_exception():
    for n in (2, 14, 60, 2000):
        line = " with ".join(f"(a-{i} or b-{i})" for i in range(n))
        found = scan(f"SPDX-License-Identifier: {line}\n")
        assert found["expressions"] == [] and found["permitted"] is False
        assert set(found["labels"].split(",")) <= {f"{c}-{i}" for c in "ab" for i in range(n)} and len(found["labels"]) <= 20 * n
    good = scan("SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0 OR MIT\n")
    assert good == {"labels": "gpl-2.0 with classpath-exception-2.0,mit", "expressions": ["GPL-2.0 WITH Classpath-exception-2.0 OR MIT"], "permitted": True}


def test_malformed_expressions_keep_their_licences():
    for text, labels in (("MIT OR", "mit"), ("(MIT", "mit"), ("MIT AND (ISC OR", "isc,mit"), ("MIT OR OR ISC", "mit"), ("(MIT AND )", "mit")):
        assert scan(f"x SPDX-License-Identifier: {text}\n") == {"labels": labels, "expressions": [], "permitted": False}, text
    assert scan("SPDX-License-Identifier: 2024\n") == {"labels": "", "expressions": [], "permitted": None}


def test_rows_of_one_id_are_dealt_out(spark):
    """Half of all rows lack an id; no range holds them all, and every row is compared with the next."""
    rows = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("doc_id"), F.concat(F.lit("text number "), F.md5(F.col("id").cast("string"))).alias("text"))
    packed = fingerprint.packed_texts(rows.withColumnRenamed("doc_id", "id"), "bigint").withColumn("turn", F.xxhash64("packed"))
    dealt = packed.repartitionByRange(8, F.col("id").desc_nulls_last(), "turn").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in dealt) < 1000
    got = fingerprint.fingerprint_documents(rows)
    assert got.count() == 4000 and got.where("doc_id is null").count() == 2000
    assert got.where("near_next is null").count() == 0


def test_the_fit_is_bounded_however_ids_repeat(spark, monkeypatch):
    """Rows without an id and rows of one labelled id, far beyond the bounds."""
    seen = {}
    monkeypatch.setattr(quality, "co_train", lambda text_x, meta_x, y, pool_text, pool_meta: seen.update(known=len(y), pool=len(pool_text)))
    monkeypatch.setattr(quality, "MAX_LABELLED", 200)
    monkeypatch.setattr(quality, "MAX_POOL", 200)
    number = F.col("id").cast("string")
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, F.lit(7)).cast("long").alias("doc_id"), F.concat(F.lit("word "), number).alias("text"),
        F.lit("s").alias("source"), F.lit("l").alias("lang"), F.length(number).cast("long").alias("n_chars"),
    )
    quality.fit(rows, spark.createDataFrame([(7, 1), (8, 0)], "doc_id long, quality int"))
    assert seen["known"] == 200 and 20 <= seen["pool"] <= 400


def test_archives_on_s3_are_opened_by_any_of_its_names():
    for path in ("s3a://bucket/a.warc.gz", "s3n://bucket/a.warc.gz", "s3://bucket/a.warc.gz"):
        files, name = fs.FileSystem.from_uri(warc.arrow_uri(path) + "?region=us-east-1")
        assert isinstance(files, fs.S3FileSystem) and name == "bucket/a.warc.gz"
    assert warc.arrow_uri("file:/tmp/a") == "file:/tmp/a" and warc.arrow_uri("hdfs://n/a") == "hdfs://n/a"

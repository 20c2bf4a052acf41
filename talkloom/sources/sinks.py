"""Sinks: appends, versioned rewrites, snapshots, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .work import file_system


def append_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def failed_replies(replies: DataFrame, path: str) -> None:
    """Append replies (sample_index, attempt, raw_response) that didn't parse, for later inspection."""
    append_json(replies.select("sample_index", "attempt", "raw_response"), path)


def write_version(rows: DataFrame, base: str, version: int) -> str:
    """A keyed table is rewritten once per batch, into a folder of its own."""
    path = f"{base}/v{version:06d}"
    rows.write.mode("errorifexists").json(path)
    return path


def write_splits(train: DataFrame, evaluation: DataFrame, base: str) -> None:
    """Both splits are always written, so an empty one leaves no stale rows behind."""
    train.write.mode("overwrite").json(f"{base}/train")
    evaluation.write.mode("overwrite").json(f"{base}/eval")


def write_results(detail: DataFrame, summary: DataFrame, base: str, stamp: str) -> None:
    detail.write.mode("errorifexists").json(f"{base}/{stamp}_detail")
    summary.coalesce(1).write.mode("errorifexists").json(f"{base}/{stamp}_summary")


def content_hash_columns(columns: list[str]) -> tuple[Column, Column]:
    """Aggregates n and hash of rows; equal multisets of rows, in any order, share them.

    Row hashes are summed, so no rows meet in one place.
    """
    row = F.to_json(F.struct(*(F.col(c) for c in columns)), {"ignoreNullFields": "false"})
    number = F.conv(F.substring(F.md5(row), 1, 15), 16, 10).cast("decimal(38,0)")
    return F.count("*").alias("n"), F.coalesce(F.sum(number), F.lit(0)).cast("string").alias("hash")


def content_hash(rows: DataFrame) -> DataFrame:
    """One row (n, hash) of all rows, see ``content_hash_columns``."""
    return rows.agg(*content_hash_columns(rows.columns))


def snapshot(spark: SparkSession, rows: DataFrame, base: str, day: str, last: DataFrame | None) -> str | None:
    """Write a dated snapshot unless the last one has the same content."""
    now = content_hash(rows).first()
    if last is not None and content_hash(last).first() == now:
        return None
    path = f"{base}/{day}_{now['n']}"
    rows.write.mode("overwrite").json(path)
    return path


def next_version(names: DataFrame, stem: str) -> DataFrame:
    """One row (next_v): one more than the largest ``stem.vN.ext``, from 1."""
    own = names.where(F.startswith("name", F.lit(f"{stem}.v")))
    number = F.expr(r"try_cast(regexp_extract(name, '\\.v([0-9]+)\\.[^.]*$', 1) as int)")
    return own.agg((F.coalesce(F.max(number), F.lit(0)) + 1).alias("next_v"))


def backup_name(names: DataFrame, stem: str, extension: str = "gguf") -> DataFrame:
    """One row (name, backup) if a current, unversioned file of the stem exists; full-precision
    files (``BF16``) and versioned names are no current ones."""
    current = names.where((F.col("name") == f"{stem}.{extension}") & ~F.contains("name", F.lit("BF16")) & ~F.col("name").rlike(r"\.v[0-9]+\."))
    numbered = current.distinct().crossJoin(next_version(names, stem))
    return numbered.select("name", F.concat(F.lit(f"{stem}.v"), F.col("next_v").cast("string"), F.lit(f".{extension}")).alias("backup"))


def backup(spark: SparkSession, folder: str, stem: str, extension: str = "gguf") -> str | None:
    """Copy the stem's current file in a folder to its next version; gives the new name, None where there is no such file."""
    files, where = file_system(spark, folder)
    names = [(s.getPath().getName(),) for s in files.listStatus(where)]
    row = backup_name(spark.createDataFrame(names, "name string"), stem, extension).first()
    if row is None:
        return None
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    at = lambda name: hadoop.Path(where, name)
    hadoop.FileUtil.copy(files, at(row["name"]), files, at(row["backup"]), False, spark.sparkContext._jsc.hadoopConfiguration())
    return row["backup"]

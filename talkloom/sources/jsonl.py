"""JSON lines: strict and lenient scans with explicit schemas and row positions.

Row order is a column, ``pos``, since DataFrames have none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import has_tag, strip, tag, tag_or_all


def scan_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Non-blank lines with ``pos``, which grows by path as given, file, block and line.

    A missing path is an error, as it is for the original tools.
    """

    def one(number: int, path: str) -> DataFrame:
        place = F.struct(F.lit(number).alias("given"), F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
        return spark.read.text(path).select("value", place.alias("pos"))

    given = [paths] if isinstance(paths, str) else paths
    return reduce(DataFrame.unionAll, (one(k, p) for k, p in enumerate(given))).where(strip("value") != "")


def scan_strict(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """JSON lines of which a malformed one fails the scan."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(paths)


def scan_log(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Log rows whose request and response both are valid JSON."""
    return valid_rows(scan_strict(spark, paths, schemas.REQUEST_LOG))


def valid_rows(log: DataFrame) -> DataFrame:
    return log.where("coalesce(request_json_valid, false) and coalesce(response_json_valid, false)")


def is_object(line: Column | str) -> Column:
    return F.try_variant_get(F.try_parse_json(line), "$", "map<string,variant>").isNotNull()


def scan_lenient(spark: SparkSession, paths: str | list[str], schema: str, key: str | None = None) -> DataFrame:
    """Lines that parse to objects, and have the key if one is asked for.

    Every line is parsed by itself, so one bad line costs no other.
    """
    lines = scan_lines(spark, paths)
    rows = lines.where(is_object("value")).select("pos", F.from_json("value", schema).alias("row")).select("pos", "row.*")
    return rows if key is None else rows.where(F.col(key).isNotNull())


def last_per_key(rows: DataFrame, key: str, order: str = "pos") -> DataFrame:
    """One row per key: the last value, at the first position."""
    value = F.struct(*(c for c in rows.columns if c not in (key, order)))
    kept = rows.groupBy(key).agg(F.min(order).alias(order), F.max_by(value, F.col(order)).alias("value"))
    return kept.select(key, order, "value.*")


def scan_keyed(spark: SparkSession, paths: str | list[str], schema: str = schemas.LABELED, key: str = "request_id") -> DataFrame:
    return last_per_key(scan_lenient(spark, paths, schema, key), key)


def scan_reviewed(spark: SparkSession, paths: str | list[str], reviewed_only: bool = False) -> DataFrame:
    rows = scan_strict(spark, paths, schemas.LABELED)
    return rows.where("coalesce(manually_reviewed, false)") if reviewed_only else rows


def scan_chat_samples(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return scan_strict(spark, paths, schemas.CHAT_SAMPLE)


def eval_columns(messages: Column) -> dict[str, Column]:
    """Texts of the three messages of a sample, transcript and vocabulary."""
    text = lambda i: messages[i]["content"][0]["text"]
    return {
        "system_text": text(0),
        "user_text": text(1),
        "gold_label": text(2),
        "raw_transcript": tag_or_all(text(1), "TRANSCRIPT"),
        "custom_vocabulary": F.when(has_tag(text(1), "CUSTOM_VOCABULARY"), tag(text(1), "CUSTOM_VOCABULARY")).otherwise(""),
    }


def scan_eval_samples(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    lines = scan_lines(spark, paths)
    rows = lines.select("pos", F.from_json("value", schemas.CHAT_SAMPLE, {"mode": "FAILFAST"}).alias("s"))
    return rows.select("pos", *(c.alias(k) for k, c in eval_columns(F.col("s.messages")).items()))


def usable_cache(rows: DataFrame) -> DataFrame:
    """Cached results by transcript; the last of equal transcripts counts."""
    usable = rows.where("coalesce(raw_transcript, '') <> '' and baseline_scores is not null and candidate_scores is not null")
    return last_per_key(usable, "raw_transcript")


def scan_cache(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return usable_cache(scan_lenient(spark, paths, schemas.EVAL_DETAIL))

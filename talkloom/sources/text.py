"""Whole text files and INI registries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def whole_text(spark: SparkSession, path: str, trimmed: bool = False) -> str:
    """One prompt or vocabulary file as a string; such files are small by nature."""
    text = spark.read.text(path, wholetext=True).first()["value"]
    return text.strip() if trimmed else text


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of whole files, each a row; texts stay with Spark."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def resolve_sections(lines: DataFrame, defaults: str = "*") -> DataFrame:
    """(section, key, value) of INI lines (pos, line), defaults filled in.

    A section has every key of the default section and its own keys, which go first.
    A registry is a small file, so its lines meet in one window.
    """
    line = F.trim("line")
    header = F.regexp_extract(line, r"^\[(.*)\]$", 1)
    marked = lines.select("pos", line.alias("line"), F.nullif(header, F.lit("")).alias("header"))
    section = F.last("header", ignorenulls=True).over(Window.orderBy("pos"))
    pairs = (
        marked.withColumn("section", section)
        .where("header is null and section is not null and line like '%=%' and line not like ';%' and line not like '#%'")
        .select("section", F.trim(F.regexp_extract("line", "^([^=]*)=", 1)).alias("key"), F.trim(F.regexp_extract("line", "^[^=]*=(.*)$", 1)).alias("value"))
    )
    names = marked.where(F.col("header") != defaults).select(F.col("header").alias("section")).distinct()
    common = pairs.where(F.col("section") == defaults).select("key", F.col("value").alias("common"))
    own = pairs.where(F.col("section") != defaults)
    keys = names.crossJoin(F.broadcast(common.select("key"))).union(own.select("section", "key")).distinct()
    return (
        keys.join(own, ["section", "key"], "left").join(common, "key", "left")
        .select("section", "key", F.coalesce("value", "common").alias("value"))
    )


def read_ini(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("pos"), F.col("value").alias("line"))
    return resolve_sections(lines)

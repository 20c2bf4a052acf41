"""Keyed tables: upsert, update, marking, counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.jsonl import last_per_key


def upsert(old: DataFrame, new: DataFrame, key: str = "request_id", order: str = "pos") -> DataFrame:
    """Insert or replace by key: the last value, at the key's first position."""
    first = old.withColumn("_turn", F.lit(0))
    rows = first.unionByName(new.withColumn("_turn", F.lit(1)), allowMissingColumns=True)
    rows = rows.withColumn("_at", F.struct("_turn", order)).drop("_turn", order)
    return last_per_key(rows, key, "_at").withColumn(order, F.col(f"_at.{order}")).drop("_at")


def update(rows: DataFrame, changes: DataFrame, key: str, column: str) -> DataFrame:
    """Set a column on matching keys; unknown keys are ignored."""
    fresh = changes.select(key, F.col(column).alias("_new"))
    return rows.join(fresh, key, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def mark_reviewed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows marked as reviewed, and one row (changed) counting those that weren't."""
    changed = rows.agg(F.count_if(~F.coalesce("manually_reviewed", F.lit(False))).alias("changed"))
    return rows.withColumn("manually_reviewed", F.lit(True)), changed


def validation_counts(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count_if(F.col("validation.status") == "pass").alias("passed"),
        F.count_if(F.col("validation.status") == "fail").alias("failed"),
        F.count_if(F.col("validation").isNull()).alias("open"),
        F.count("*").alias("total"),
    )


def failures_by_type(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.coalesce("validation.type", F.lit("UNKNOWN")).alias("type")).agg(F.count("*").alias("n"))

"""Streams: request-log ingest, and keyed tables kept current by micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..sources.keyed_table import KeyedTable


def read_log_stream(spark: SparkSession, path: str) -> DataFrame:
    """Log rows as they arrive as files of JSON lines."""
    return spark.readStream.schema(schemas.REQUEST_LOG).json(path)


def append_log(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Exactly-once append; what is there when it starts is worked off."""
    return rows.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def deduplicated(rows: DataFrame, key: str, time: str, delay: str = "1 day") -> DataFrame:
    """First row of each key; keys are forgotten after ``delay``, so state is bounded."""
    stamped = rows.withColumn(time, F.col(time).cast("timestamp"))
    return stamped.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def keep_current(rows: DataFrame, table: KeyedTable, checkpoint: str) -> StreamingQuery:
    """Upsert every micro-batch into a keyed table, whose touched buckets alone are written.

    The table remembers the stream's last batch, so one that runs twice is applied once.
    """

    def apply(batch: DataFrame, number: int) -> None:
        table.apply(batch, checkpoint, number)

    return rows.writeStream.foreachBatch(apply).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_latency(rows: DataFrame, time: str, value: str, by: str, window: str = "10 minutes", delay: str = "10 minutes") -> DataFrame:
    """Count and mean per time window and group, late rows up to ``delay``."""
    stamped = rows.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    return stamped.groupBy(F.window(time, window), by).agg(F.count("*").alias("n"), F.avg(value).alias("mean"))

"""Streams with a state of their own per key: first position and last value, windows with late rows told apart.

Both are stateful processors; their state lives in the state store, so a run
goes on where the one before ended, and timers of event time forget keys and
close windows as the watermark passes.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The state store that stateful processors ask for.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_store(spark: SparkSession) -> None:
    """Stateful processors need this store; it also keeps state off the heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


class FirstAndLast(StatefulProcessor):
    """Holds (first position, last position, last value as JSON, time of the last row) of a key."""

    def __init__(self, key: str, order: str, delay_ms: int):
        self.key, self.order, self.delay_ms = key, order, delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "first long, last long, value string, seen long")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        first, last, value, seen = tuple(self.held.get()) if self.held.exists() else (None, None, None, None)
        for row in rows:
            at = row["_at"]
            first = at if first is None else min(first, at)
            if last is None or at >= last:
                last, value = at, row["_value"]
            seen = row["_ms"] if seen is None else max(seen, row["_ms"])
        self.held.update((first, last, value, seen))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(max(seen + self.delay_ms, timerValues.getCurrentWatermarkInMs() + 1))
        yield Row(_key=key[0], _first=first, _value=value)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        self.held.clear()
        return iter(())

    def close(self) -> None:
        pass


def first_and_last(rows: DataFrame, key: str, order: str, time: str, delay: str = "1 day", forget_ms: int = 86_400_000) -> DataFrame:
    """A stream of the keys that a batch touched: the last value, at the first position.

    A key is forgotten once the watermark has passed its last row by ``forget_ms``,
    so state is bounded by the keys of that time; a key that comes back later
    starts anew.
    """
    use_state_store(rows.sparkSession)
    value = T.StructType([f for f in rows.schema if f.name not in (key, order)])
    stamped = rows.withColumn("_time", F.col(time).cast("timestamp")).withWatermark("_time", delay)
    # the state machine sees plain columns: time as a number, the value as one text
    plain = stamped.select(
        F.col(key).cast("string").alias("_key"), F.col(order).cast("long").alias("_at"), F.unix_millis("_time").alias("_ms"),
        F.to_json(F.struct(*value.names), {"ignoreNullFields": "false"}).alias("_value"),
    )
    kept = plain.groupBy("_key").transformWithState(FirstAndLast(key, order, forget_ms), "_key string, _first long, _value string", "Update", "EventTime")
    read = F.from_json("_value", value)
    return kept.select(F.col("_key").alias(key), F.col("_first").alias(order), read.alias("_row")).select(key, order, "_row.*")


class Windows(StatefulProcessor):
    """Counts and sums of one group's time window until the watermark closes it; rows of closed windows are late."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "n long, total double")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        group, start, end = key
        if end <= timerValues.getCurrentWatermarkInMs():
            for row in rows:
                yield Row(_group=group, _start=start, _n=None, _mean=None, _late=row["_row"])
            return
        n, total = tuple(self.held.get()) if self.held.exists() else (0, 0.0)
        if not n:
            self.handle.registerTimer(end)
        for row in rows:
            n, total = n + 1, total + (row["_v"] or 0.0)
        self.held.update((n, total))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        group, start, _ = key
        n, total = tuple(self.held.get())
        self.held.clear()
        yield Row(_group=group, _start=start, _n=n, _mean=total / n, _late=None)

    def close(self) -> None:
        pass


def windows_and_late_rows(rows: DataFrame, time: str, value: str, by: str, window_ms: int, delay: str) -> DataFrame:
    """A stream of closed windows (_group, _start, _n, _mean) and of late rows (_late, as JSON), in one; append mode.

    Null values count as 0, null times as the epoch.
    """
    use_state_store(rows.sparkSession)
    stamped = rows.withColumn("_time", F.coalesce(F.col(time).cast("timestamp"), F.timestamp_millis(F.lit(0)))).withWatermark("_time", delay)
    start = F.floor(F.unix_millis("_time") / window_ms) * window_ms
    # the time goes on as a number only, or Spark would drop late rows itself
    plain = stamped.select(
        F.col(by).cast("string").alias("_group"), start.alias("_start"), (start + window_ms).alias("_end"),
        F.col(value).cast("double").alias("_v"), F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("_row"),
    )
    schema = "_group string, _start long, _n long, _mean double, _late string"
    return plain.groupBy("_group", "_start", "_end").transformWithState(Windows(), schema, "Append", "EventTime")


def write_windows(stream: DataFrame, schema: str | T.StructType, by: str, base: str, checkpoint: str):
    """Closed windows to ``base/windows`` (by, start, n, mean) and late rows to ``base/late``, exactly once each.

    Folders are named by batch, so one that runs twice writes the same.
    """

    def split(batch: DataFrame, number: int) -> None:
        whole = batch.where("_late is null").select(F.col("_group").alias(by), F.timestamp_millis("_start").alias("start"), F.col("_n").alias("n"), F.col("_mean").alias("mean"))
        late = batch.where("_late is not null").select(F.from_json("_late", schema).alias("r")).select("r.*")
        whole.write.mode("overwrite").parquet(f"{base}/windows/batch={number}")
        late.write.mode("overwrite").parquet(f"{base}/late/batch={number}")

    return stream.writeStream.foreachBatch(split).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

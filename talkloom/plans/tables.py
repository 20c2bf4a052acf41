"""Queries of keyed tables, streams with state, the log source, order statistics and prefixes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import select, selection
from ..sources import log_source
from ..sources.keyed_table import KeyedTable, bucket_of
from ..sources.snapshots import Snapshots
from ..streaming import ingest, keyed_state
from .parity import query
from .standins import load, work_folder

# ---- keyed tables ----

_BUCKET = "('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 64"


@query(f"""WITH k AS (SELECT *, {_BUCKET} AS bucket, doc_id % 97 = 0 AS changed FROM documents WHERE doc_id % 10 <> 3 OR doc_id % 97 = 0)
SELECT bucket::INT AS bucket, max(CASE WHEN changed THEN 1 ELSE 0 END)::INT AS version, count(*)::BIGINT AS n,
  sum(CASE WHEN changed THEN -n_chars ELSE n_chars END)::BIGINT AS v, sum(CASE WHEN doc_id % 10 <> 3 THEN doc_id ELSE doc_id + 1000000000 END)::BIGINT AS pos
FROM k GROUP BY bucket""")
def bucketed_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyed table after two runs of a stream: its rows, and by which version each bucket was written."""
    base, docs = work_folder(spark), load(spark, sf_dir, "documents")
    schema = "doc_id long, pos long, v long"
    changed = F.col("doc_id") % 97 == 0
    first = docs.where("doc_id % 10 <> 3").select("doc_id", F.col("doc_id").alias("pos"), F.col("n_chars").alias("v"))
    second = docs.where(changed).select("doc_id", (F.col("doc_id") + 1_000_000_000).alias("pos"), (-F.col("n_chars")).alias("v"))
    table = KeyedTable(spark, f"{base}/table", schema, "doc_id", "pos", buckets=64)
    for rows in (first, second):
        rows.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(schema).parquet(f"{base}/in")
        ingest.keep_current(stream, table, f"{base}/state").awaitTermination()
    table.vacuum()
    held = spark.createDataFrame(list(table.manifest().buckets.items()), "bucket int, version int")
    sums = table.read().groupBy(bucket_of(F.col("doc_id"), 64).alias("bucket")).agg(F.count("*").alias("n"), F.sum("v").alias("v"), F.sum("pos").alias("pos"))
    return sums.join(F.broadcast(held), "bucket").select("bucket", "version", "n", "v", "pos")  # 64 rows


@query("""WITH d AS (SELECT doc_id, coalesce(source, '') AS source, n_chars, doc_id % 211 = 5 AS changed FROM documents)
SELECT count(*)::BIGINT AS n, sum(CASE WHEN changed THEN -n_chars ELSE n_chars END)::BIGINT AS v, count(*) FILTER (changed)::BIGINT AS n_changed,
  0::BIGINT AS unfound, true AS fewer_written, 0::INT AS written_again FROM d""")
def snapshot_by_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second snapshot writes only the leaves of key ranges in which documents changed, a third one nothing."""
    docs = load(spark, sf_dir, "documents").select("doc_id", F.coalesce("source", F.lit("")).alias("source"), "n_chars")
    changed = F.col("doc_id") % 211 == 5
    later = docs.withColumn("n_chars", F.when(changed, -F.col("n_chars")).otherwise(F.col("n_chars")))
    shots = Snapshots(spark, f"{work_folder(spark)}/shots", "doc_id", parts=64)
    first, second = shots.take(docs), shots.take(later)
    third = len(shots.take(later.repartition(3)))
    wrote = [(shots.written(k), len(ranges)) if ranges else (0, 0) for k, ranges in enumerate((first, second))]
    paths = [f"{shots.base}/data/v=1/_part={p}" for p in second]
    again = spark.read.schema(docs.schema).parquet(*paths) if paths else docs.limit(0)
    differs = changed & (F.col("n_chars") != 0)  # an empty document's row stays as it was
    found = later.where(differs).join(again, ["doc_id", "n_chars"], "left_anti").agg(F.count("*").alias("unfound"))
    sums = shots.read(docs.schema).agg(F.count("*").alias("n"), F.sum("n_chars").alias("v"), F.count_if(changed).alias("n_changed"))
    told = F.lit(wrote[1] < wrote[0]).alias("fewer_written"), F.lit(third).alias("written_again")
    return sums.crossJoin(F.broadcast(found)).select("*", *told)  # one row each


# ---- streams ----


def _event_runs(spark: SparkSession, sf_dir: str, base: str, first: str) -> list[DataFrame]:
    """The events as two runs of a file stream: those of a condition, then the others."""
    events = load(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    streams = []
    for k, condition in enumerate((first, f"not ({first})")):
        events.where(condition).write.parquet(f"{base}/in{k}")
        streams.append(spark.readStream.schema(events.schema).parquet(f"{base}/in[0-{k}]"))
    return streams


@query("""SELECT user_id, min(event_id)::BIGINT AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id""")
def first_and_last_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last value at first position of each user, from a stateful stream that is stopped and taken up again."""
    base = work_folder(spark)
    table = KeyedTable(spark, f"{base}/table", "user_id string, event_id long, event_type string, value double", "user_id", "event_id", buckets=16)
    half = load(spark, sf_dir, "events").agg(F.coalesce(F.floor(F.max("event_id") / 2), F.lit(0))).first()[0]
    for stream in _event_runs(spark, sf_dir, base, f"event_id <= {half}"):
        kept = keyed_state.first_and_last(stream, "user_id", "event_id", "ts", "60 days")
        ingest.keep_current(kept.select("user_id", "event_id", "event_type", "value"), table, f"{base}/state").awaitTermination()
    return table.read().withColumn("user_id", F.col("user_id").cast("long"))


_HOURS = 6 * 3_600_000
_WINDOW = f"floor(epoch_ms(ts) / {_HOURS})::BIGINT * {_HOURS}"


@query(f"""WITH e AS (SELECT event_id, event_type, value, {_WINDOW} AS s, event_id % 3 <> 0 AS one, epoch_ms(ts) AS ms FROM events),
m AS (SELECT max(ms) FILTER (one) - {_HOURS} AS wm1, max(ms) - {_HOURS} AS wm2 FROM e),
j AS (SELECT e.*, wm2, NOT one AND s + {_HOURS} <= wm1 AS late FROM e, m)
SELECT event_type, make_timestamp(s * 1000) AS start, count(*)::BIGINT AS n, round(sum(value) / count(*), 6) AS mean FROM j WHERE NOT late AND s + {_HOURS} <= wm2 GROUP BY event_type, s
UNION ALL SELECT event_type, NULL, count(*), round(sum(event_id) / count(*), 6) FROM j WHERE late GROUP BY event_type""")
def windows_with_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows of two runs of a stream; and, with no start, late rows by type: their number and mean id."""
    base = work_folder(spark)
    for stream in _event_runs(spark, sf_dir, base, "event_id % 3 <> 0"):
        told = keyed_state.windows_and_late_rows(stream, "ts", "value", "event_type", _HOURS, "6 hours")
        keyed_state.write_windows(told, stream.schema, "event_type", base, f"{base}/state").awaitTermination()
    windows = spark.read.schema("event_type string, start timestamp, n long, mean double").parquet(f"{base}/windows/*")
    late = spark.read.schema("event_id long, event_type string").parquet(f"{base}/late/*")
    counted = late.groupBy("event_type").agg(F.lit(None).cast("timestamp").alias("start"), F.count("*").alias("n"), F.avg("event_id").alias("mean"))
    every = windows.union(counted)
    return every.select("event_type", F.col("start").cast("timestamp_ntz").alias("start"), "n", F.round("mean", 6).alias("mean"))


# ---- log source ----

_LOG_SQL = """SELECT doc_id % 10 AS kind, count(*)::BIGINT AS n, sum(length(coalesce(source, '')))::BIGINT AS chars, {}::BIGINT AS damaged
FROM documents WHERE doc_id % 10 <> 5 GROUP BY 1"""


def _log_lines(docs: DataFrame) -> DataFrame:
    """Lines of JSON with the document's id, of which some are cut short, blank or no object."""
    row = F.to_json(F.struct("doc_id", "source", "text"))
    line = F.when(F.col("doc_id") % 10 == 3, F.concat(F.lit("{"), row)).when(F.col("doc_id") % 10 == 5, F.lit(" \t"))
    return docs.select(line.when(F.col("doc_id") % 10 == 7, F.concat(F.lit("["), row, F.lit("]"))).otherwise(row).alias("value"))


def _log_counts(lines: DataFrame) -> DataFrame:
    """By kind of line: rows, characters of the source, lines reported as damaged."""
    rows, damaged = log_source.parsed(lines, "doc_id long, source string", "doc_id")
    id_of = F.regexp_extract("line", '"doc_id":([0-9]+)', 1).cast("long")
    source = F.regexp_extract("line", '"source":"([^"]*)"', 1)
    both = rows.select("doc_id", "source", F.lit(0).alias("damaged")).union(damaged.select(id_of, source, F.lit(1)))
    return both.groupBy((F.col("doc_id") % 10).alias("kind")).agg(F.count("*").alias("n"), F.sum(F.length("source")).alias("chars"), F.sum("damaged").alias("damaged"))


@query(_LOG_SQL.format("count(*) FILTER (doc_id % 10 IN (3, 7))"))
def log_source_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as log lines, read in byte ranges shorter than many of them; damaged lines are rows too."""
    base = work_folder(spark)
    _log_lines(load(spark, sf_dir, "documents")).write.text(f"{base}/log")
    return _log_counts(log_source.read_lines(spark, f"{base}/log", split=1 << 18))


@query(_LOG_SQL.format("count(*) FILTER (doc_id % 10 IN (3, 7))"))
def log_source_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from two runs of the source as a stream, the second of which goes on where the first ended."""
    base, docs = work_folder(spark), load(spark, sf_dir, "documents")
    for k in range(2):
        _log_lines(docs.where(F.col("doc_id") % 2 == k)).write.mode("append").text(f"{base}/log")
        lines = log_source.read_lines(spark, f"{base}/log", split=1 << 20, stream=True)
        out = lines.writeStream.format("parquet").option("path", f"{base}/lines").option("checkpointLocation", f"{base}/state")
        out.trigger(availableNow=True).start().awaitTermination()
    return _log_counts(spark.read.schema(log_source.SCHEMA).parquet(f"{base}/lines"))


# ---- order statistics and prefixes ----

_TIED = "CASE WHEN l_orderkey % 2 = 0 THEN 7.5 ELSE l_extendedprice END"
_AT = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99}


@query(f"""WITH v AS (SELECT l_returnflag, ({_TIED})::DOUBLE AS v FROM lineitem)
SELECT l_returnflag, count(*)::BIGINT AS n, round(avg(v), 6) AS avg, {', '.join(f'round(quantile_cont(v, {p}), 6) AS {k}' for k, p in _AT.items())} FROM v GROUP BY 1""")
def percentiles_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact percentiles where half of all values are equal, with windows of at most 64 distinct values."""
    rows = load(spark, sf_dir, "lineitem").select("l_returnflag", F.expr(_TIED).alias("v"))
    found = selection.percentiles(rows, "v", ["l_returnflag"], _AT, work_folder(spark), values=64)
    return found.select("l_returnflag", "n", *(F.round(c, 6).alias(c) for c in ("avg", *_AT)))


_SIDE = "o_orderkey % 2 AS side, CASE WHEN o_orderkey % 4 < 2 THEN 100.0 ELSE o_totalprice END"


@query(f"""WITH v AS (SELECT {_SIDE}::DOUBLE AS v FROM orders), r AS (SELECT side, v, row_number() OVER (PARTITION BY side ORDER BY v) AS rank FROM v)
SELECT x.rank::BIGINT AS rank, x.v AS a, y.v AS b FROM r x JOIN r y ON x.rank = y.rank AND x.side = 0 AND y.side = 1""")
def ranks_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sides paired by rank where half of all values are equal, in ranges of some 2,000 rows."""
    rows = load(spark, sf_dir, "orders").select(*(F.expr(x) for x in (_SIDE + " AS v").split(", ", 1))).withColumn("v", F.col("v").cast("double"))
    placed = selection.ranked(rows, "v", ["side"], work_folder(spark), range_rows=2000)
    left, right = (placed.where(F.col("side") == s).select("rank", F.col("v").alias(c)) for s, c in ((0, "a"), (1, "b")))
    return left.join(right, "rank").select("rank", "a", "b")


@query("""WITH p AS (SELECT substr(md5(p_partkey::VARCHAR), 1, 3 + p_partkey % 3) AS prefix FROM part), o AS (SELECT o_orderkey, md5(o_orderkey::VARCHAR) AS id FROM orders)
SELECT o_orderkey, id FROM o WHERE EXISTS (SELECT 1 FROM p WHERE starts_with(o.id, p.prefix))""")
def prefixes_of_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose id starts with one of as many prefixes as there are parts."""
    prefixes = load(spark, sf_dir, "part").select(F.expr("substring(md5(cast(p_partkey as string)), 1, cast(3 + p_partkey % 3 as int))").alias("prefix"))
    orders = load(spark, sf_dir, "orders").select("o_orderkey", F.md5(F.col("o_orderkey").cast("string")).alias("id"))
    return select.by_prefixes(orders, prefixes, "id")

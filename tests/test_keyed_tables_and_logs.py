"""Keyed tables in buckets, streams with state, the log source."""

from __future__ import annotations

import json

import duckdb
import pytest
from pyspark.sql import functions as F

from talkloom.plans import registry
from talkloom.sources import jsonl, log_source, snapshots
from talkloom.sources.keyed_table import KeyedTable
from talkloom.sources.snapshots import FANOUT, Snapshots, differing, part_of, tree_of
from talkloom.streaming import ingest, keyed_state

SCHEMA = "request_id string, pos long, v int"


def rows_of(table, version=None):
    return sorted(((r["request_id"], r["pos"], r["v"]) for r in table.read(version).collect()), key=str)


def test_a_batch_writes_touched_buckets_only(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, buckets=8)
    assert table.versions() == [] and table.read().count() == 0
    first = [(f"k{i}", i, i) for i in range(200)] + [("k3", 900, 33), (None, 7, 7)]
    assert table.apply(spark.createDataFrame(first, SCHEMA)) == list(range(8))
    want = {(k, p): v for k, p, v in first if (k, p) not in (("k3", 3), ("k3", 900))} | {("k3", 3): 33}
    assert rows_of(table) == sorted(((k, p, v) for (k, p), v in want.items()), key=str)
    touched = table.apply(spark.createDataFrame([("k5", 1000, 55), ("new", 1001, 1)], SCHEMA))
    assert 1 <= len(touched) <= 2
    held = table.manifest().buckets
    assert {b for b, v in held.items() if v == 1} == set(touched) and set(held) == set(range(8))
    now = {**want, ("k5", 5): 55, ("new", 1001): 1}
    assert rows_of(table) == sorted(((k, p, v) for (k, p), v in now.items()), key=str)
    # the version before is still there until it is removed
    assert rows_of(table, 0) == sorted(((k, p, v) for (k, p), v in want.items()), key=str)
    assert table.apply(spark.createDataFrame([], SCHEMA)) == []
    assert table.vacuum() == len(touched)
    assert table.versions() == [2] and rows_of(table) == sorted(((k, p, v) for (k, p), v in now.items()), key=str)
    with pytest.raises(ValueError):
        table.read(0)


def test_a_batch_that_comes_twice_is_applied_once(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, buckets=4)
    batch = spark.createDataFrame([("a", 0, 1)], SCHEMA)
    assert table.apply(batch, "s", 0) and table.apply(batch.withColumn("v", F.lit(9)), "s", 0) == []
    assert table.apply(batch.withColumn("v", F.lit(2)), "other", 0)
    assert rows_of(table) == [("a", 0, 2)] and table.manifest().batches == {"s": 0, "other": 0}


def test_a_version_without_a_manifest_does_not_count(spark, tmp_path):
    """A writer that fails before its manifest leaves the old version, and the next one writes over it."""
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, buckets=2)
    table.apply(spark.createDataFrame([("a", 0, 1), ("b", 1, 1)], SCHEMA))
    junk = spark.createDataFrame([("a", 0, 666, 0), ("a", 0, 666, 1)], SCHEMA + ", bucket int")
    junk.write.partitionBy("bucket").parquet(f"{table.base}/data/v=1")
    assert rows_of(table) == [("a", 0, 1), ("b", 1, 1)]
    table.apply(spark.createDataFrame([("a", 2, 5)], SCHEMA))
    assert rows_of(table) == [("a", 0, 5), ("b", 1, 1)]


def write_json(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in rows))


def test_state_goes_on_after_a_restart_and_forgets(spark, tmp_path):
    schema = "k string, pos long, v string, t timestamp"
    runs = [
        [{"k": "a", "pos": 5, "v": "x", "t": "2020-01-01T00:00:00"}, {"k": "a", "pos": 2, "v": "y", "t": "2020-01-01T00:00:00"}, {"k": "b", "pos": 9, "v": None, "t": "2020-01-01T00:00:10"}],
        [{"k": "a", "pos": 8, "v": "z", "t": "2020-01-01T00:00:20"}],
        [{"k": "b", "pos": 11, "v": "late key", "t": "2020-01-02T00:00:00"}],
        [{"k": "a", "pos": 12, "v": "again", "t": "2020-01-02T00:00:00"}],
    ]
    told = []
    for n, rows in enumerate(runs):
        write_json(tmp_path / "in", f"{n}.json", rows)
        stream = spark.readStream.schema(schema).json(str(tmp_path / "in"))
        kept = keyed_state.first_and_last(stream, "k", "pos", "t", "0 seconds", forget_ms=3_600_000)
        out = []
        query = kept.writeStream.foreachBatch(lambda b, _, out=out: out.extend(b.collect())).outputMode("update")
        query.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
        told.append(sorted((r["k"], r["pos"], r["v"]) for r in out))
    # after a day without it the key of the last run has been forgotten
    assert told == [[("a", 2, "x"), ("b", 9, None)], [("a", 2, "z")], [("b", 9, "late key")], [("a", 12, "again")]]


def test_late_rows_have_a_sink_of_their_own(spark, tmp_path):
    schema = "g string, t timestamp, v double"
    at = lambda m, g="g", v=1.0: {"g": g, "t": f"2020-01-01T00:{m:02d}:30", "v": v}
    for n, rows in enumerate(([at(1), at(3, v=3.0), at(25), at(25, "h")], [at(2), at(21, v=None), at(45)])):
        write_json(tmp_path / "in", f"{n}.json", rows)
        stream = spark.readStream.schema(schema).json(str(tmp_path / "in"))
        both = keyed_state.windows_and_late_rows(stream, "t", "v", "g", 600_000, "5 minutes")
        keyed_state.write_windows(both, stream.schema, "g", str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    windows = spark.read.parquet(str(tmp_path / "out/windows/*")).select("g", F.date_format("start", "HH:mm").alias("s"), "n", "mean")
    assert sorted(map(tuple, windows.collect())) == [("g", "00:00", 2, 2.0), ("g", "00:20", 2, 0.5), ("h", "00:20", 1, 1.0)]
    assert [(r["g"], r["v"]) for r in spark.read.parquet(str(tmp_path / "out/late/*")).collect()] == [("g", 1.0)]


LINES = [b'{"request_id": "a", "label": "1"}', b"", b"  ", b"{bad", b'{"x": 2}', b"[1]", b'{"request_id": "\xff"}', b'{"request_id": "b", "label": "' + b"long " * 5000 + b'"}\r', "{\"request_id\": \"é\", \"label\": \"é\"}".encode()]


@pytest.mark.parametrize("split", [1, 7, 100, 3000, 1 << 20])
def test_log_source_reads_every_line_once(spark, tmp_path, split):
    if split < 100:
        lines = [line for line in LINES if len(line) < 100]
    else:
        lines = LINES
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "1.jsonl").write_bytes(b"\n".join(lines))
    (tmp_path / "b" / "_hidden").write_bytes(b"no\n")
    (tmp_path / "a.jsonl").write_bytes(b"\n".join(lines) + b"\n")
    paths = [str(tmp_path / "b"), str(tmp_path / "a.jsonl")]
    got = log_source.read_lines(spark, paths, split)
    want, at = [], 0
    for line in lines:
        want.append((at, line.removesuffix(b"\r").decode(errors="replace")))
        at += len(line) + 1
    for number in (0, 1):
        found = sorted((r["start"], r["line"]) for r in got.where(F.col("file_number") == number).collect())
        assert found == want
    rows, damaged = log_source.parsed(got, "request_id string, label string", "request_id")
    lenient = jsonl.scan_lenient(spark, paths, "request_id string, label string", "request_id")
    plain = lambda d: sorted((r["request_id"], r["label"] or "") for r in d.collect())
    assert plain(rows) == plain(lenient.where("request_id <> '�'"))
    words = sorted(r["damage"] for r in damaged.collect())
    assert words == sorted(["no JSON object", "no JSON object", "no request_id", "not UTF-8 at byte 16"] * 2)
    # order is that of the list, then of the lines
    assert [r["request_id"] for r in rows.orderBy("pos").collect()] == ([r for r in ("a", "b", "é") if split >= 100 or r != "b"]) * 2


def test_log_source_streams_a_file_that_grows(spark, tmp_path):
    log = tmp_path / "log.jsonl"
    told = []
    for more in (b"one\ntw", b"", b"o\nthree\n", b"\nunfinished"):
        with log.open("ab") as f:
            f.write(more)
        lines = log_source.read_lines(spark, str(log), 3, stream=True)
        out = []
        query = lines.writeStream.foreachBatch(lambda b, _, out=out: out.extend(b.collect())).option("checkpointLocation", str(tmp_path / "state"))
        query.trigger(availableNow=True).start().awaitTermination()
        told.append(sorted((r["start"], r["line"]) for r in out))
    assert told == [[(0, "one")], [], [(4, "two"), (8, "three")], [(14, "")]]
    with pytest.raises(Exception, match="FileNotFound"):
        log_source.read_lines(spark, str(tmp_path / "none")).collect()


def test_a_stream_keeps_a_keyed_table_current(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "table"), SCHEMA, buckets=4)
    for k, rows in enumerate(([("a", 0, 1), ("b", 1, 1), ("a", 2, 2)], [("b", 3, 3), ("c", 4, 1)])):
        write_json(tmp_path / "in", f"{k}.json", [dict(zip(("request_id", "pos", "v"), r, strict=True)) for r in rows])
        stream = spark.readStream.schema(SCHEMA).json(str(tmp_path / "in"))
        ingest.keep_current(stream, table, str(tmp_path / "state")).awaitTermination()
    assert rows_of(table) == [("a", 0, 2), ("b", 1, 3), ("c", 4, 1)] and len(table.versions()) == 2


def test_snapshots_write_what_differs(spark, tmp_path):
    rows = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    shots = Snapshots(spark, str(tmp_path / "s"), "k", parts=40)
    first = shots.take(rows)
    assert len(first) > 30 and shots.take(rows.repartition(7)) == [] and shots.versions() == [0]
    later = rows.where("k <> 500").union(spark.createDataFrame([(-5, 1), (3, 3), (None, 2), (5000, 4)], "k long, v long"))
    changed = shots.take(later)
    assert 2 <= len(changed) <= 3 and 0 in changed and first[-1] in changed
    key = lambda d: sorted(map(tuple, d.collect()), key=str)
    assert key(shots.read(rows.schema)) == key(later) and key(shots.read(rows.schema, 0)) == key(rows)
    files = {p.parent.name for p in (tmp_path / "s/data/v=1").glob("*/part-*")}
    assert files == {f"_part={p}" for p in changed}
    empty = Snapshots(spark, str(tmp_path / "e"), "k")
    assert empty.take(rows.limit(0)) == [0] and empty.read(rows.schema).count() == 0 and empty.take(rows.limit(0)) == []


def test_snapshots_write_leaves_of_a_changed_range(spark, tmp_path):
    """A change in every range writes leaves, not ranges; what older snapshots hold is read but for dead leaves."""
    rows = spark.range(6000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    shots = Snapshots(spark, str(tmp_path / "s"), "k", parts=4)
    key = lambda d: sorted(map(tuple, d.collect()), key=str)
    everything = shots.take(rows)
    assert shots.written(0) == 6000
    v = F.col("v")
    states = [rows]
    states.append(rows.withColumn("v", F.when(F.col("k") % 211 == 5, -v).otherwise(v)))
    assert shots.take(states[1]) == everything and 0 < shots.written(1) < 4000
    assert sum(spark.read.parquet(str(p)).count() for p in (tmp_path / "s/data/v=1").glob("_part=*")) == shots.written(1)
    leaf = spark.read.parquet(str(tmp_path / "s/data/v=0/_part=2")).groupBy("_leaf").agg(F.collect_list("k").alias("ks")).orderBy("_leaf").first()["ks"]
    states.append(states[1].where(~F.col("k").isin(leaf)))  # all rows of a leaf go, none comes in their place
    assert shots.take(states[2]) == [2] and shots.written(2) == 0
    grown = spark.range(6000, 16000).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("v"))
    states.append(states[2].union(grown))  # keys beyond the last bound
    assert shots.take(states[3]) == [3] and max(m.n / m.leaves for m in shots.manifest(3).values()) <= 64
    states.append(states[3].where("k > 5"))
    assert shots.take(states[4].repartition(5)) == [0] and shots.take(states[4]) == []
    for version, state in enumerate(states):
        assert key(shots.read("k long, v long", version)) == key(state), version


@pytest.mark.parametrize("n", [0, 54_016])
def test_snapshot_query_where_every_range_has_changes(spark, tmp_path, n):
    """Ranges of 844 rows with four changes each; a changed document without characters stays as it was."""
    length = F.when(F.col("id") % 11 != 3, F.col("id") % 7).alias("n_chars")
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"), length)
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = duck.execute(registry.oracle_sql()["snapshot_by_parts"]).fetchall()
    assert [tuple(r) for r in registry.queries()["snapshot_by_parts"](spark, str(tmp_path)).collect()] == want


def test_a_range_held_by_many_snapshots_is_written_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "MOST_HELD", 2)
    rows = spark.range(1000).select(F.col("id").alias("k"), F.lit(0).alias("v"))
    shots = Snapshots(spark, str(tmp_path / "s"), "k", parts=1)
    wrote = []
    for n in range(4):
        rows = rows.withColumn("v", F.when(F.col("k") == n, n + 1).otherwise(F.col("v")))
        assert shots.take(rows) == [0]
        wrote.append(shots.written(n))
        assert sorted(map(tuple, shots.read(rows.schema).collect())) == sorted(map(tuple, rows.collect()))
    assert wrote[0] == wrote[2] == 1000 and max(wrote[1], wrote[3]) < 300
    assert [shots.manifest(n)[0].held for n in range(4)] == [[0], [0, 1], [2], [2, 3]]


def test_trees_tell_leaves_apart(spark):
    for n in (1, 2, FANOUT, FANOUT + 1, 1000):
        leaves = [str(i) for i in range(n)]
        assert differing(tree_of(leaves), tree_of(leaves)) == []
        other = [x + "!" if i in (0, n // 2, n - 1) else x for i, x in enumerate(leaves)]
        assert differing(tree_of(leaves), tree_of(other)) == sorted({0, n // 2, n - 1})
    bounds = list(range(0, 1000, 10))
    got = spark.range(-20, 1100).select("id", part_of(F.col("id"), bounds).alias("p")).collect()
    assert all(r["p"] == min(99, max(0, r["id"] // 10)) for r in got)

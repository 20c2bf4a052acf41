"""Snapshots of a table by parts: only what differs from the last snapshot is written.

Keys are cut into ranges once, when the first snapshot is made; each range is a
part, a leaf of a hash tree on the driver whose inner nodes hash their children.
Below it a part has leaves of some ``LEAF_ROWS`` rows, dealt by a hash of the key,
as many as its rows ask for; these stay in Spark.  Two snapshots are compared
from the root down: equal subtrees are passed over, and of the parts that are
left those leaves are written that differ.  So a changed row costs its leaf,
however large the table.  A leaf's hash sums those of its rows, a part's those of
its leaves, so no rows meet in one place; it is the same for equal multisets.

A snapshot is a manifest of its parts, of which each names the snapshot that has
its table of leaves, which name the snapshots whose files hold them.  It counts
once its manifest is whole.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .sinks import content_hash_columns
from .work import file_system, stored

#: Children of an inner node.
FANOUT = 16
#: Rows of a leaf below a part, on average; rows of one key are never apart.
LEAF_ROWS = 64
#: Snapshots whose files may hold leaves of one part; its next change writes it whole.
MOST_HELD = 16
_MANIFEST = "part int, hash string, n long, version int, leaves int, held array<int>, written long"
_LEAF = "_part int, _leaf int, hash string, n long, version int"


class Part(NamedTuple):
    """Hash and rows; the snapshot that changed it last, its leaves, the snapshots that hold them, rows written last."""

    hash: str
    n: int
    version: int
    leaves: int
    held: list[int]
    written: int


def leaves_for(n: int) -> int:
    return max(1, -(-n // LEAF_ROWS))


def tree_of(leaves: list[str]) -> list[list[str]]:
    """Levels of the tree, the leaves first, the root last."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([hashlib.sha256("".join(below[i : i + FANOUT]).encode()).hexdigest() for i in range(0, len(below), FANOUT)])
    return levels


def differing(old: list[list[str]], new: list[list[str]]) -> list[int]:
    """Leaves that differ, found from the root down; the trees have one shape."""
    open_ = [0] if old[-1] != new[-1] else []
    for level in range(len(new) - 2, -1, -1):
        below = (j for i in open_ for j in range(i * FANOUT, min((i + 1) * FANOUT, len(new[level]))))
        open_ = [j for j in below if old[level][j] != new[level][j]]
    return open_


def part_of(key: Column, bounds: list, group: int = 16) -> Column:
    """The range of a key, looked up by groups of bounds."""
    if not bounds:
        return F.lit(0)
    groups = [bounds[i : i + group] for i in range(0, len(bounds), group)]
    upto = lambda some: F.size(F.filter(some, lambda b: b <= key))
    outer = F.greatest(upto(F.array(*(F.lit(g[0]) for g in groups))), F.lit(1))
    inner = F.get(F.array(*(F.array(*map(F.lit, g)) for g in groups)), outer - 1)
    return F.when(key.isNull(), 0).otherwise(F.greatest((outer - 1) * group + upto(inner) - 1, F.lit(0)))


class Snapshots:
    """Snapshots of a table under ``base``, in ranges of a key; ``parts`` is fixed by the first one.

    Keys below the first bound are in range 0, null keys too.
    """

    def __init__(self, spark: SparkSession, base: str, key: str, parts: int = 256):
        self.spark, self.base, self.key, self.parts = spark, base.rstrip("/"), key, parts

    def versions(self) -> list[int]:
        files, where = file_system(self.spark, f"{self.base}/manifest")
        if not files.exists(where):
            return []
        Path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path  # noqa: N806
        found = [s.getPath() for s in files.listStatus(where)]
        return sorted(int(p.getName()[1:]) for p in found if p.getName().startswith("v") and files.exists(Path(p, "_SUCCESS")))

    def bounds(self, rows: DataFrame) -> tuple[list, list[int]]:
        """Lower bounds of the ranges, as many as parts at most, and their rows but null keys; made from the first snapshot."""
        kind = rows.schema[self.key].dataType.simpleString()
        if self.versions():
            lows = self.spark.read.schema(f"bound {kind}, n long").parquet(f"{self.base}/bounds")
        else:
            dealt = rows.where(F.col(self.key).isNotNull()).select(F.col(self.key).alias("bound")).repartitionByRange(self.parts, "bound")
            counted = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.min("bound").alias("bound"), F.count("*").alias("n"))
            lows = stored(counted.select("bound", "n"), f"{self.base}/bounds")
        found = lows.orderBy("bound").collect()
        return [r["bound"] for r in found], [r["n"] for r in found] or [0]

    def manifest(self, version: int) -> dict[int, Part]:
        """The parts of a snapshot."""
        rows = self.spark.read.schema(_MANIFEST).json(f"{self.base}/manifest/v{version:06d}").collect()
        return {r["part"]: Part(*r[1:]) for r in rows}

    def leaves(self, parts: dict[int, Part]) -> DataFrame:
        """Hash, rows and writing version of each leaf of the parts."""
        paths = [f"{self.base}/leaves/v={m.version}/_part={p}" for p, m in sorted(parts.items()) if m.n]
        if not paths:
            return self.spark.createDataFrame([], _LEAF)
        found = self.spark.read.schema(f"{_LEAF}, v int").option("basePath", f"{self.base}/leaves").parquet(*paths)
        return found.select("_part", "_leaf", "hash", "n", "version")

    def hashed(self, rows: DataFrame, bounds: list, leaves: list[int]) -> tuple[DataFrame, DataFrame, list[tuple[str, int]]]:
        """The rows with part and leaf; hash and rows by leaf, which Spark keeps; the same by part."""
        of_part = F.get(F.array(*map(F.lit, leaves)), F.col("_part"))
        placed = rows.withColumn("_part", part_of(F.col(self.key), bounds))
        placed = placed.withColumn("_leaf", F.pmod(F.xxhash64(F.col(self.key)), of_part).cast("int"))
        found = stored(placed.groupBy("_part", "_leaf").agg(*content_hash_columns(rows.columns)), f"{self.base}/found")
        total = F.sum(F.col("hash").cast("decimal(38,0)")).cast("string").alias("hash")
        by_part = {r["_part"]: (r["hash"], r["n"]) for r in found.groupBy("_part").agg(total, F.sum("n").alias("n")).collect()}
        return placed, found, [by_part.get(p, ("0", 0)) for p in range(len(leaves))]

    def take(self, rows: DataFrame) -> list[int]:
        """Write the leaves that differ from the last snapshot as a new one; gives their ranges, none if nothing has changed."""
        known = self.versions()
        last = self.manifest(known[-1]) if known else {}
        version = known[-1] + 1 if known else 0
        bounds, sizes = self.bounds(rows)
        leaves = [last[p].leaves if p in last else leaves_for(n) for p, n in enumerate(sizes)]
        placed, found, now = self.hashed(rows, bounds, leaves)
        if any(n > 2 * LEAF_ROWS * k for (_, n), k in zip(now, leaves)):  # parts that have grown get more leaves
            leaves = [leaves_for(n) if n > 2 * LEAF_ROWS * k else k for (_, n), k in zip(now, leaves)]
            placed, found, now = self.hashed(rows, bounds, leaves)
        trees = [tree_of([f"{h}:{k}" for h, k in level]) for level in ([last[p][:2] if p in last else ("", -1) for p in range(len(now))], now)]
        changed = differing(*trees)
        if not changed:
            return []
        compared = {p: last[p] for p in changed if p in last and leaves[p] == last[p].leaves and len(last[p].held) < MOST_HELD}
        table = found.where(F.col("_part").isin(changed)).join(self.leaves(compared), ["_part", "_leaf", "hash", "n"], "left")
        table = table.withColumn("version", F.coalesce("version", F.lit(version))).repartition(len(changed), "_part")
        table.write.mode("overwrite").partitionBy("_part").parquet(f"{self.base}/leaves/v={version}")
        parts = last | {p: Part(*now[p], version, leaves[p], [], 0) for p in changed}
        own, table = F.col("version") == version, self.leaves({p: parts[p] for p in changed})
        written = placed.where(F.col("_part").isin(changed))
        if compared:
            written = written.join(table.where(own).select("_part", "_leaf"), ["_part", "_leaf"], "left_semi")
        written.repartition(len(changed), "_part").write.mode("overwrite").partitionBy("_part").parquet(f"{self.base}/data/v={version}")
        held = F.sort_array(F.collect_set("version")).alias("held"), F.sum(F.when(own, F.col("n")).otherwise(0)).alias("written")
        parts |= {r["_part"]: parts[r["_part"]]._replace(held=r["held"], written=r["written"]) for r in table.groupBy("_part").agg(*held).collect()}
        entries = [(p, *m) for p, m in sorted(parts.items())]
        self.spark.createDataFrame(entries, _MANIFEST).coalesce(1).write.mode("overwrite").json(f"{self.base}/manifest/v{version:06d}")
        return changed

    def written(self, version: int) -> int:
        """The rows that a snapshot wrote itself."""
        return sum(m.written for m in self.manifest(version).values() if m.version == version)

    def read(self, schema, version: int | None = None) -> DataFrame:
        """The rows of a snapshot, by default the last."""
        parts = {p: m for p, m in self.manifest(self.versions()[-1] if version is None else version).items() if m.n}
        schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        # the files of a part that was written whole are read as they are, of others the leaves that still count
        whole = {p: m for p, m in parts.items() if m.held == [m.version]}
        mixed = {p: m for p, m in parts.items() if p not in whole}
        paths = [[f"{self.base}/data/v={v}/_part={p}" for p, m in sorted(some.items()) for v in m.held] for some in (whole, mixed)]
        out = [self.spark.read.schema(schema).parquet(*paths[0])] if whole else []
        if mixed:
            place = lambda k: F.regexp_extract("_metadata.file_path", "/v=([0-9]+)/_part=([0-9]+)/[^/]*$", k).cast("int")
            files = self.spark.read.schema(StructType([*schema.fields]).add("_leaf", "integer")).parquet(*paths[1])
            live = self.leaves(mixed).withColumnRenamed("version", "_version").select("_version", "_part", "_leaf")
            found = files.withColumns({"_version": place(1), "_part": place(2)}).join(live, live.columns, "left_semi")
            out.append(found.drop(*live.columns))
        return reduce(DataFrame.union, out) if out else self.spark.createDataFrame([], schema)

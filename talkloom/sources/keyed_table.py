"""A keyed table in hash buckets, of which a batch of changes rewrites only those it touches.

Rows of a key live in one bucket, by a hash of the key.  A version is a manifest
that names, for each bucket, the version whose files hold it; applying changes
writes the touched buckets anew and a manifest that refers to the old files of
all others.  A version counts once its manifest is complete, so readers see the
old version or the new one, and a batch that failed midway is simply applied
again.  Manifests also remember the last batch of each stream, so one that comes
twice is applied once.  ``vacuum`` removes what the last versions don't refer to.

One writer at a time.  Files are listed and removed through Hadoop's file
system, so any store that Spark writes to will do.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import md5_int
from ..operators.upsert import upsert
from .jsonl import last_per_key
from .work import file_system, stored

_MANIFEST = "kind string, name string, number long"


def bucket_of(key: Column, buckets: int) -> Column:
    """The bucket of a key, from 0; the same in other engines.  Null keys are in bucket 0."""
    return F.coalesce(F.pmod(md5_int(key.cast("string")), F.lit(buckets)), F.lit(0)).cast("int")


@dataclass
class Manifest:
    """What a version consists of: the version that wrote each bucket, and the last batch of each stream."""

    version: int
    buckets: dict[int, int]
    batches: dict[str, int]


class KeyedTable:
    """A table under ``base`` with one row per key: the last value, at the key's first position.

    ``buckets`` is fixed when the table is made; one should hold some hundred
    megabytes at most, as a touched bucket is rewritten whole by one task.
    """

    def __init__(self, spark: SparkSession, base: str, schema: str | T.StructType, key: str = "request_id", order: str = "pos", buckets: int = 64):
        self.spark, self.base, self.key, self.order, self.buckets = spark, base.rstrip("/"), key, order, buckets
        self.schema = spark.createDataFrame([], schema).schema

    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        files, where = file_system(self.spark, f"{self.base}/manifest")
        if not files.exists(where):
            return []
        Path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path  # noqa: N806
        found = [s.getPath() for s in files.listStatus(where)]
        return sorted(int(p.getName()[1:]) for p in found if p.getName().startswith("v") and files.exists(Path(p, "_SUCCESS")))

    def manifest(self, version: int | None = None) -> Manifest:
        """The manifest of a version, by default the last; as many rows as buckets and streams."""
        known = self.versions()
        version = version if version is not None else (known[-1] if known else -1)
        if version < 0:
            return Manifest(-1, {}, {})
        if version not in known:
            raise ValueError(f"there is no version {version}")
        rows = self.spark.read.schema(_MANIFEST).json(f"{self.base}/manifest/v{version:06d}").collect()
        of = lambda kind: {r["name"]: r["number"] for r in rows if r["kind"] == kind}
        return Manifest(version, {int(b): v for b, v in of("bucket").items()}, of("batch"))

    def read(self, version: int | None = None, only: list[int] | None = None) -> DataFrame:
        """The rows of a version, by default the last; of some buckets only if asked, whose files alone are read."""
        held = self.manifest(version).buckets
        paths = [f"{self.base}/data/v={v}/bucket={b}" for b, v in sorted(held.items()) if only is None or b in only]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def apply(self, changes: DataFrame, stream: str | None = None, batch: int | None = None) -> list[int]:
        """Upsert changes as a new version; gives the buckets that were written.

        A batch of a stream that has been applied already changes nothing.
        """
        last = self.manifest()
        if stream is not None and last.batches.get(stream, -1) >= batch:
            return []
        version = last.version + 1
        placed = last_per_key(changes, self.key, self.order).select(*self.schema.names).withColumn("bucket", bucket_of(F.col(self.key), self.buckets))
        staged = stored(placed, f"{self.base}/staged/v{version:06d}")
        touched = sorted(r["bucket"] for r in staged.select("bucket").distinct().collect())
        if touched:
            old = self.read(last.version if last.version >= 0 else None, touched)
            merged = upsert(old, staged.drop("bucket"), self.key, self.order).withColumn("bucket", bucket_of(F.col(self.key), self.buckets))
            written = merged.select(*self.schema.names, "bucket").repartition(len(touched), "bucket")
            written.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.base}/data/v={version}")
        rows = [("bucket", str(b), v) for b, v in ({**last.buckets} | dict.fromkeys(touched, version)).items()]
        rows += [("batch", s, n) for s, n in (last.batches | ({stream: batch} if stream is not None else {})).items()]
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").json(f"{self.base}/manifest/v{version:06d}")
        self.remove(f"staged/v{version:06d}")
        return touched

    def remove(self, path: str) -> None:
        files, where = file_system(self.spark, f"{self.base}/{path}")
        files.delete(where, True)

    def vacuum(self, keep: int = 1) -> int:
        """Remove versions but the last ``keep``, and the bucket files to which those don't refer; gives their number.

        What the last version's successor may have left behind goes too.
        """
        known = self.versions()
        kept = known[-keep:]
        referred = {(b, v) for k in kept for b, v in self.manifest(k).buckets.items()}
        files, where = file_system(self.spark, f"{self.base}/data")
        gone = 0
        for at in files.listStatus(where) if files.exists(where) else []:
            version = int(at.getPath().getName().removeprefix("v="))
            inside = [s.getPath() for s in files.listStatus(at.getPath()) if s.getPath().getName().startswith("bucket=")]
            old = [p for p in inside if (int(p.getName().removeprefix("bucket=")), version) not in referred]
            for p in old:
                files.delete(p, True)
            gone += len(old)
            if len(old) == len(inside):
                files.delete(at.getPath(), True)
        for k in known[:-keep]:
            self.remove(f"manifest/v{k:06d}")
        return gone

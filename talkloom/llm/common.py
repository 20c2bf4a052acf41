"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a counted side of a join may be broadcast.
BROADCAST_ROWS = 200_000

#: Bytes that separate words: ASCII other than digits and lower-case letters
#: (A-Z are lower-cased first); bytes of multi-byte characters belong to words.
_WORD_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)
#: A-Z lower-cased; white space (tab to carriage return, space) made one kind.
_SPACE_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256)
)


def words_of(raw: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a UTF-8 text, A-Z lower-cased."""
    return raw.translate(_WORD_TABLE).split() if raw else []


def space_words_of(raw: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text, A-Z lower-cased."""
    if not raw:
        return []
    return [w for w in raw.translate(_SPACE_TABLE).split(b" ") if w]


def raw_texts(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding them."""
    return column.cast(pa.binary()).to_pylist()


def give_back() -> None:
    """Return freed memory to the system: workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """A function for mapInArrow that gives freed memory back when it ends."""

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return wrapped


def shared_folder(spark: SparkSession) -> str:
    """A new folder name under the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names that folder.  Where it is unset, a local
    session gets a folder under /tmp; a cluster is refused, as executors would
    not see one another's files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "/tmp/checkpoints"
    return f"{base.rstrip('/')}/talkloom-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and read it again: cuts lineage durably."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int, bound: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when the counted rows are within the bound."""
    return F.broadcast(df) if rows <= bound else df


#: Hot keys that ``split_hot`` may tell, and rows of a key below which it isn't hot.
HOT_KEYS = 4096
HOT_ROWS = 256


def split_hot(rows: DataFrame, key: str, sizes: DataFrame, total: int, by: Column) -> DataFrame:
    """The rows with ``part`` and ``parts``: rows of a hot key are dealt into parts by ``by``.

    ``sizes`` has (key, size), ``total`` is the sum of its sizes.  A key is hot
    with more rows than both HOT_ROWS and total / HOT_KEYS, so there are at
    most HOT_KEYS of them and the broadcast has that bound; no part is much
    larger than that many rows.
    """
    limit = max(HOT_ROWS, total // HOT_KEYS)
    hot = sizes.where(F.col("size") > limit).select(key, F.ceil(F.col("size") / limit).cast("int").alias("parts"))
    dealt = rows.join(F.broadcast(hot), key, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    return dealt.withColumn("part", F.pmod(by, F.col("parts")).cast("int"))


def for_all_parts(table_: DataFrame) -> DataFrame:
    """Rows with ``parts``, once for every part of it."""
    return table_.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")


def free_names(taken: list[str], names: list[str]) -> list[str]:
    """The names, each with as many trailing underscores as it takes to differ
    from those taken; Spark's names don't tell case apart."""
    used = {t.lower() for t in taken}
    out = []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

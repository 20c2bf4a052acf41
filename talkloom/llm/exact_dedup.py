"""Exact deduplication by two-pass Bloom filtering.

Texts are equal if they are identical once A-Z are lower-cased, which their
SHA-256 tells.  One pass over the digests fills a Bloom filter that counts to
two: each task fills one of its own, tasks' filters are added up by segment.
The second pass tests every digest: where some place of it was counted once
only, no other row has the text, and the row passes straight through as a group
of its own.  Only the other rows, which possibly repeat, are shuffled and
grouped by their digests.  A filter never misses a repeated digest; what it
takes for one wrongly is a group of one.

The filter's size follows the number of rows, BITS a row.  It is broadcast, so
it has a bound of ``max_bits``: digests beyond it are dealt into slices by their
bits, stored slice by slice, and each slice has a filter of its own.  A group
that holds much of all rows is counted on the map side, and dealt into parts
where its rows meet its result.

Defined cases: null text equals the empty text; of rows with equal text and
equal largest id one stays, the others have its id as ``keep_id``; null ids are
smaller than all others, and of rows with null ids alone one stays; texts of
any length are read whole; an empty table gives an empty result; clashing names
of kept columns leave the result columns with an underscore.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import for_all_parts, free_names, lean, shared_folder, split_hot, stored

#: Places of the filter for every row, and places that a digest takes.
BITS, PLACES = 16, 4
#: Places of a segment; a place in it has 16 bits, four of which fill a long.
SEGMENT = 1 << 16
#: Places of one filter: 128 MB to broadcast, 67 million rows.
MAX_BITS = 1 << 30
RESULTS = ["keep_id", "group_size", "kept", "text_sha256"]
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normalised(text: Column) -> Column:
    """The text with A-Z lower-cased, other letters as they are; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


class Planes:
    """Places of segments that were counted once at least, and twice at least, as bits."""

    def __init__(self):
        self.row: dict[int, int] = {}
        self.once = np.zeros((16, SEGMENT // 64), np.uint64)
        self.twice = np.zeros_like(self.once)

    def rows_of(self, segments: np.ndarray) -> np.ndarray:
        """Rows of the planes for distinct segments, made where they are new."""
        rows = np.fromiter((self.row.setdefault(s, len(self.row)) for s in segments.tolist()), np.int64, len(segments))
        while len(self.row) > len(self.once):
            self.once, self.twice = (np.concatenate([p, np.zeros_like(p)]) for p in (self.once, self.twice))
        return rows

    def add(self, segments: np.ndarray, digests: np.ndarray) -> None:
        """Count the places of digests."""
        which, inverse = np.unique(segments, return_inverse=True)
        rows = self.rows_of(which)[inverse]
        bits = digests.view(np.uint64)
        places = np.concatenate([(rows * SEGMENT) + ((bits >> np.uint64(16 * k)) & np.uint64(SEGMENT - 1)).astype(np.int64) for k in range(PLACES)])
        places, counts = np.unique(places, return_counts=True)
        word, bit = places >> 6, np.uint64(1) << (places & 63).astype(np.uint64)
        once, twice = self.once.reshape(-1), self.twice.reshape(-1)
        again = (counts > 1) | ((once[word] & bit) > 0)
        np.bitwise_or.at(twice, word[again], bit[again])
        np.bitwise_or.at(once, word, bit)

    def merge(self, segment: int, once: np.ndarray, twice: np.ndarray) -> None:
        at = self.rows_of(np.array([segment]))[0]
        self.twice[at] |= twice | (self.once[at] & once)
        self.once[at] |= once

    def in_blocks(self, size: int = 64) -> Iterator[list[tuple[int, int]]]:
        """Segments and their rows, some at a time."""
        known = list(self.row.items())
        return (known[i : i + size] for i in range(0, len(known), size))


def partial_filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(segment, places) of the segments that a task's rows touch; the planes are mostly zeros, so deflated."""
    planes = Planes()
    for batch in batches:
        if batch.num_rows:
            planes.add(batch.column("segment").to_numpy(), batch.column("digest").to_numpy())
    for some in planes.in_blocks():
        packed = [zlib.compress(planes.once[at].tobytes() + planes.twice[at].tobytes(), 1) for _, at in some]
        yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in some], pa.int64()), pa.array(packed, pa.binary())], ["segment", "places"])


def whole_filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(segment, words) of places counted twice at least, from all tasks' filters of the segments."""
    planes = Planes()
    for batch in batches:
        for segment, packed in zip(batch.column("segment").to_pylist(), batch.column("places").to_pylist()):
            both = np.frombuffer(zlib.decompress(packed), np.uint64)
            planes.merge(segment, both[: SEGMENT // 64], both[SEGMENT // 64 :])
    for some in planes.in_blocks():
        words = pa.array([planes.twice[at].view(np.int64) for _, at in some], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in some], pa.int64()), words], ["segment", "words"])


def possibly_repeated(digests: DataFrame, folder: str) -> Column:
    """Fill a filter with (segment, digest) rows and store it; the test of a row that meets its segment."""
    parts = digests.mapInArrow(lean(partial_filters), "segment long, places binary")
    whole = parts.repartition("segment").mapInArrow(lean(whole_filters), "segment long, words array<long>")
    whole.write.parquet(folder)
    tests = []
    for k in range(PLACES):
        place = F.shiftrightunsigned("digest", 16 * k).bitwiseAND(SEGMENT - 1)
        word = F.get("words", F.shiftright(place, 6).cast("int"))
        tests.append(F.getbit(word, F.pmod(place, F.lit(64)).cast("int")) == 1)
    every = tests[0]
    for test in tests[1:]:
        every = every & test
    return F.coalesce(every, F.lit(False))


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per document: the kept columns (the id by default), keep_id, group_size, kept, text_sha256."""
    spark, folder = docs.sparkSession, shared_folder(docs.sparkSession)
    kept = [id_col] if keep is None else keep
    names = free_names(kept, RESULTS)
    n_rows = docs.count()
    slices = max(1, -(-n_rows * BITS // max_bits))
    segments = max(1, -(-n_rows * BITS // (slices * SEGMENT)))
    # columns of the operator's own come first, kept ones inside a struct, where no names clash
    digest = F.xxhash64("sha")
    other = F.xxhash64("sha", F.lit(1))
    rows = (
        docs.select(F.struct(*kept).alias("own"), F.col(id_col).alias("id"), F.sha2(normalised(F.col(text_col)), 256).alias("sha"))
        .withColumns({"row": F.monotonically_increasing_id(), "digest": digest, "segment": F.pmod(other, F.lit(segments))})
        .withColumn("slice", F.pmod(F.shiftright(other, 32), F.lit(slices)).cast("int"))
    )
    rows.write.partitionBy("slice").parquet(f"{folder}/rows")
    narrow = spark.read.schema(rows.schema).parquet(f"{folder}/rows")
    for s in range(slices):
        one = narrow.where(F.col("slice") == s)
        test = possibly_repeated(one.select("segment", "digest"), f"{folder}/filter{s}")
        # its bound is max_bits / 8 bytes
        places = F.broadcast(spark.read.schema("segment long, words array<long>").parquet(f"{folder}/filter{s}"))
        tested = one.join(places, "segment", "left").withColumn("maybe", test)
        tested.select("own", "id", "sha", "row", "maybe").write.mode("append").parquet(f"{folder}/tested")
    tested = spark.read.schema(rows.select("own", "id", "sha", "row").schema.add("maybe", "boolean")).parquet(f"{folder}/tested")
    single = tested.where("not maybe").select("own", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("size"), F.lit(True).alias("kept"), "sha")
    maybe = tested.where("maybe")
    best = F.max(F.struct(F.col("id"), F.col("row"))).alias("best")
    groups = stored(maybe.groupBy("sha").agg(best, F.count("*").alias("size")), f"{folder}/groups")
    total = groups.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    dealt = split_hot(maybe, "sha", groups.select("sha", "size"), total, F.xxhash64("row"))
    met = for_all_parts(split_hot(groups, "sha", groups.select("sha", "size"), total, F.lit(0)).drop("part"))
    repeated = dealt.drop("parts").join(met, ["sha", "part"]).select(
        "own", F.col("best.id").alias("keep_id"), "size", (F.col("row") == F.col("best.row")).alias("kept"), "sha"
    )
    made = dict(zip(names, ("keep_id", "size", "kept", "sha")))
    every = single.unionByName(repeated)
    return every.select(*(F.col("own")[c].alias(c) for c in kept), *(F.col(c).alias(n) for n, c in made.items()))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """The documents that stay, with all their columns."""
    kept = free_names(docs.columns, RESULTS)[2]
    return exact_groups(docs, id_col, text_col, docs.columns, max_bits).where(F.col(kept)).select(*docs.columns)

"""Document fingerprints by a randomised edit embedding.

A random walk reads a text: at step j it stands on a character and moves on if
the shared random bit of (j, character) says so.  The characters it stands on
spell the embedding; texts that differ by few edits walk together again soon
after each edit, so edit distance becomes Hamming distance.  A walk goes on to
the end of its text, and the embedding is as long as the walk.  The fingerprint
samples the embedding at shared places and keeps one random bit of each
character found there.  Places are drawn so that texts of like length share
them: the k-th place of a text is the last record of a random sequence before
the embedding's length.

Many texts walk in step, so that each step is one array operation.

Near documents are found by banding on sampled bits and verified by the whole
fingerprint.  Bands are as wide as the number of different fingerprints asks
for, so that strangers seldom share one, and as many as find a pair at the
least likeness with chance ``RECALL``; likelier pairs are found more surely.

Defined cases: null text counts as empty, empty texts are alike with likeness
1; equal texts have equal fingerprints; texts of any length are walked to their
end; rows that repeat an id follow one another by a hash of their texts, and count as one
document, near to another if any of its rows is; null ids come last, and are in
no class; the document after the last is the first, so a lone document is
followed by itself; an empty table gives an empty result.  Only the id and text
columns are read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, broadcast_if_small, for_all_parts, shared_folder, split_hot, stored
from .hubs import connected, fetched

BITS = 256
SEED = 20_240_229
#: Steps after which the walk's random bits repeat.
PERIOD = 1 << 14
#: Steps between looks at which texts have ended.
STRIDE = 64
#: Characters in one batch of walks, edited texts included.
BATCH_CHARS = 16 << 20
#: Least likeness of near documents, and chance that banding finds a pair of just that.
NEAR = 0.8
RECALL = 0.9
#: Documents of a bucket that are compared in one block.
BLOCK = 1024
#: Class of the mark at the end of a text.
END = 256


def _walk_bits() -> np.ndarray:
    bits = np.random.default_rng(SEED).integers(0, 2, (PERIOD, END + 1), dtype=np.int64)
    bits[:, END] = 0
    return bits


def _symbol_bits() -> np.ndarray:
    return np.random.default_rng(SEED + 1).integers(0, 2, (BITS, END + 1), dtype=np.uint8)


def records(limit: int) -> list[np.ndarray]:
    """For every bit the record places of a random sequence, up to ``limit``.

    After a record at p no other comes before place m with chance (p+1)/(m+1).
    """
    rng = np.random.default_rng(SEED + 2)
    draws = 1 - rng.random((BITS, 96))
    out = []
    for row in draws:
        places, p = [0], 0
        for u in row:
            p = int((p + 1) / u)
            if p <= places[-1]:
                p = places[-1] + 1
            if p >= limit:
                break
            places.append(p)
        out.append(np.array(places, np.int64))
    return out


@cache
def all_records() -> list[np.ndarray]:
    """Records up to a limit that no walk reaches."""
    return records(1 << 40)


_TABLES: dict[str, np.ndarray] = {}


def tables() -> dict[str, np.ndarray]:
    if not _TABLES:
        _TABLES.update(walk=_walk_bits(), symbol=_symbol_bits())
    return _TABLES


def classes(text: str) -> np.ndarray:
    """Every code point as one of 256 classes."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return ((points ^ (points >> 8)) & 255).astype(np.uint16)


def fingerprints(texts: list[str]) -> np.ndarray:
    """Fingerprint bits (texts x BITS) of whole texts, which walk in step."""
    t = tables()
    if not texts:
        return np.zeros((0, BITS), np.uint8)
    lengths = np.array([len(x) for x in texts])
    order = np.argsort(-lengths, kind="stable")
    flat = np.full(int(lengths.sum()) + len(texts), END, np.uint16)
    pos = np.zeros(len(texts), np.int64)
    at = 0
    for i, o in enumerate(order):
        pos[i] = at
        flat[at : at + lengths[o]] = classes(texts[o])
        at += lengths[o] + 1
    places = all_records()
    marks = np.unique(np.concatenate(places))
    seen: list[np.ndarray] = []  # characters at the marks passed so far
    walk, mask = t["walk"], PERIOD - 1
    steps = np.zeros(len(texts), np.int64)  # embedding lengths
    under_way, here, lo = np.arange(len(texts)), pos, 0
    while len(under_way):
        start = here.copy()
        for j in range(lo, lo + STRIDE):
            c = flat[here]
            if j == marks[len(seen)]:
                row = np.full(len(texts), END, np.uint16)
                row[under_way] = c
                seen.append(row)
            here += walk[j & mask][c]
        done = flat[here] == END
        if done.any():
            # these texts walk the stride again, to see where in it they ended
            at, n = start[done], np.zeros(int(done.sum()), np.int64)
            for j in range(lo, lo + STRIDE):
                c = flat[at]
                n += c != END
                at += walk[j & mask][c]
            steps[under_way[done]] = lo + n
            under_way, here = under_way[~done], here[~done]
        lo += STRIDE
    steps = np.maximum(1, steps)
    at_marks = np.stack(seen)
    out = np.zeros((len(texts), BITS), np.uint8)
    column = np.arange(len(texts))
    for k in range(BITS):
        place = places[k][np.searchsorted(places[k], steps, "left") - 1]
        out[order, k] = t["symbol"][k][at_marks[np.searchsorted(marks, place), column]]
    return out


def to_hex(bits: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in np.packbits(bits, axis=1)]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated share of equal embedding characters, from equal bits: 0 to 1."""
    return np.maximum(0.0, 1 - 2 * (a != b).sum(axis=1) / BITS)


def edited(text: str, following: str) -> str:
    """The last third replaced by as much of the start of the following text."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


_RESULT = (
    "id {id}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_KINDS = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
_NAMES = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def compare(ids: list, texts: list[str]) -> tuple[list, list[tuple]]:
    """Result rows of all texts but the last, each next to the one after it."""
    m = len(texts) - 1
    changed = [edited(texts[i], texts[i + 1]) for i in range(m)]
    bits = fingerprints(texts + changed)
    own, other = bits[: m + 1], bits[m + 1 :]
    near_edited, near_next = likeness(own[:m], other), likeness(own[:m], own[1:])
    names, changed_names = to_hex(own[:m]), to_hex(other)
    rows = [
        (len(texts[i]), hashlib.sha256(changed[i].encode("utf-8", "surrogatepass")).hexdigest(),
         names[i], changed_names[i], float(near_edited[i]), float(near_next[i]))
        for i in range(m)
    ]
    return ids[:m], rows


def packed_texts(rows: DataFrame, kind: str) -> DataFrame:
    """Texts deflated, as they are moved between tasks whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [zlib.compress(t, 6) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(packed, pa.binary())], names=["id", "packed"])

    return rows.mapInArrow(run, f"id {kind}, packed binary")


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of all texts, of their edited texts, and likenesses.

    The document after another by falling id comes from a range partitioning:
    each task compares neighbours of its sorted range and hands on its first
    and last text, and those few are compared at the end.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    # texts of one id follow one another by a hash, so that ranges can cut between them too
    order = [F.col("id").desc_nulls_last(), F.col("turn")]
    turned = packed_texts(rows, kind).withColumn("turn", F.xxhash64("packed"))
    ranged = turned.repartitionByRange(*order).sortWithinPartitions(*order)

    def batch_of(kind_: str, part: int, ids: list, out: list[tuple], texts: list[str] | None, id_type) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [()] * len(_KINDS)
        n = len(ids)
        return pa.RecordBatch.from_arrays(
            [pa.array([kind_] * n, pa.string()), pa.array([part] * n, pa.int32()), pa.array(texts or [None] * n, pa.string()),
             pa.array(ids, id_type), *(pa.array(c or [None] * n, k) for c, k in zip(columns, _KINDS, strict=True))],
            names=["kind", "part", "text", *_NAMES],
        )

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        ids, texts, size, first, id_type = [], [], 0, None, pa.int64()

        def ordered() -> Iterator[tuple]:
            nonlocal id_type
            for batch in batches:
                id_type = batch.schema.field("id").type
                for lo in range(0, batch.num_rows, 512):
                    piece = batch.slice(lo, 512)
                    for i, packed in zip(piece.column("id").to_pylist(), piece.column("packed").to_pylist(), strict=True):
                        yield i, zlib.decompress(packed).decode("utf-8", "surrogatepass")

        for i, text in ordered():
            if first is None:
                first = (i, text)
            ids.append(i)
            texts.append(text)
            size += 2 * len(text)
            if size > BATCH_CHARS and len(ids) > 1:
                yield batch_of("row", part, *compare(ids, texts), None, id_type)
                ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])
        if len(ids) > 1:
            yield batch_of("row", part, *compare(ids, texts), None, id_type)
        if first is not None:
            yield batch_of("head", part, [first[0]], [], [first[1]], id_type)
            yield batch_of("tail", part, ids[-1:], [], texts[-1:], id_type)

    schema = _RESULT.format(id=kind)
    parts = stored(ranged.mapInArrow(neighbours, f"kind string, part int, text string, {schema}"), f"{folder}/parts")
    # numbers of the partitions that have rows: a few integers, none of them a document's
    numbers = sorted(r["part"] for r in parts.where("kind = 'head'").select("part").collect())
    following = list(zip(numbers, numbers[1:] + numbers[:1], strict=True))
    links = spark.createDataFrame(following, "part int, after int") if following else None
    result = parts.where("kind = 'row'").select(*_NAMES)
    if links is not None:
        tails = parts.where("kind = 'tail'").select("part", "id", "text").join(links, "part")
        heads = parts.where("kind = 'head'").select(F.col("part").alias("after"), F.col("text").alias("next_text"))

        def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, text, after in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    ids, out = compare([i, None], [text, after])
                    yield batch_of("row", 0, ids, out, None, batch.schema.field("id").type).select(_NAMES)

        result = result.union(tails.join(heads, "after").select("id", "text", "next_text").mapInArrow(stitch, schema))
    return result.withColumnRenamed("id", id_col)


def band_shape(n: int, least: float = NEAR, recall: float = RECALL) -> tuple[int, int]:
    """Number and width of bands for n different fingerprints.

    Bits of a pair at the least likeness agree with chance (1 + least) / 2.
    Bits of strangers agree with chance 0.54 or so, as some characters are
    frequent; bands are so wide that about one stranger in ten shares one.
    """
    width = min(BITS // 2, max(16, math.ceil(1.125 * math.log2(max(2, n))) + 3))
    found = ((1 + least) / 2) ** width
    return math.ceil(math.log(1 - recall) / math.log(1 - found)), width


def band_places(bands: int, width: int) -> np.ndarray:
    """The bits of each band (bands x width)."""
    return np.random.default_rng(SEED + 3).permuted(np.tile(np.arange(BITS), (bands, 1)), axis=1)[:, :width]


def band_keys(fingerprint: str, bands: int, width: int) -> list[int]:
    """Sampled bits of a fingerprint, one key for each band."""
    bits = np.unpackbits(np.frombuffer(bytes.fromhex(fingerprint), np.uint8))
    return [int("".join(map(str, bits[p])), 2) for p in band_places(bands, width)]


def banded(prints: DataFrame, bands: int, width: int) -> DataFrame:
    """(key, doc) of (doc, fingerprint): a hash of band and sampled bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = band_places(bands, width)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                piece = batch.slice(lo, 1024)
                raw = bytes.fromhex("".join(piece.column("fingerprint").to_pylist()))
                bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, BITS // 8), axis=1)
                keys = np.zeros((piece.num_rows, bands), np.uint64)
                for b in range(bands):
                    key = np.full(piece.num_rows, b + 1, np.uint64)
                    for p in places[b]:
                        key = (key ^ bits[:, p]) * np.uint64(0x9E3779B97F4A7C15)
                        key ^= key >> np.uint64(29)
                    keys[:, b] = key
                docs = np.repeat(piece.column("doc").to_numpy(), bands)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(docs)], names=["key", "doc"])

    return prints.mapInArrow(run, "key long, doc long")


_BIT_COUNTS = np.array([bin(i).count("1") for i in range(256)], np.uint16)


def block_links(rest: DataFrame, prints: DataFrame, least: float) -> DataFrame:
    """Links (a, b) of documents outside their list's main component, ``rest``
    being the rows (key, doc, label, main, list_size) of lists.

    A list is cut into blocks of about BLOCK documents with their fingerprints;
    each block's outside documents meet every block of the list, so rows of the
    join are pairs of blocks, and only links leave it.
    """
    placed = rest.withColumn("n_blocks", F.ceil(F.col("list_size") / BLOCK)).withColumn("block", F.pmod(F.xxhash64("doc", F.lit(7)), F.col("n_blocks")))
    placed = placed.join(prints, "doc").select("key", "block", "n_blocks", "main", F.struct("doc", "label", "fingerprint").alias("x"))
    every = placed.groupBy("key", F.col("block").alias("other")).agg(F.collect_list("x").alias("ys"))
    outside = placed.where("x.label <> main").groupBy("key", "block", "n_blocks").agg(F.collect_list("x").alias("xs"))
    outside = outside.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
    apart = int((1 - least) / 2 * BITS + 1e-9)

    def parts(items: pa.ListScalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = items.values
        raw = bytes.fromhex("".join(rows.field("fingerprint").to_pylist()))
        return rows.field("doc").to_numpy(), rows.field("label").to_numpy(), np.frombuffer(raw, np.uint8).reshape(-1, BITS // 8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links: set[tuple[int, int]] = set()
            for i in range(batch.num_rows):
                docs, labels, bits = parts(batch.column("xs")[i])
                docs2, labels2, bits2 = parts(batch.column("ys")[i])
                for doc, label, own in zip(docs.tolist(), labels.tolist(), bits, strict=True):
                    differing = _BIT_COUNTS[bits2 ^ own].sum(axis=1)
                    near = np.flatnonzero((differing <= apart) & (labels2 != label))
                    # one link to each component is enough
                    _, first = np.unique(labels2[near], return_index=True)
                    links.update((doc, int(d)) for d in docs2[near[first]])
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], names=["a", "b"]
            )

    return outside.join(every, ["key", "other"]).select("xs", "ys").mapInArrow(run, "a long, b long").distinct()


def near_classes(prints: DataFrame, id_col: str = "doc_id", least: float = NEAR, folder: str | None = None) -> DataFrame:
    """(id, near_class) of documents that near fingerprints connect with another.

    Equal fingerprints form a class, whose smallest id stands for it; rows
    without id are left out.  Classes that share a band's sampled bits are
    compared by ``hubs.connected``, in the last round as blocks of packed
    fingerprints; pairs of at least ``least`` likeness link.  ``near_class`` is
    the smallest id that links reach.
    """
    folder = folder or shared_folder(prints.sparkSession)
    rows = prints.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), "fingerprint")
    classes_ = rows.groupBy("fingerprint").agg(F.min("id").alias("doc"), F.count("*").alias("size"))
    classes_ = stored(classes_, f"{folder}/classes")
    shape = band_shape(classes_.count(), least)
    firsts = classes_.select("doc", "fingerprint")
    differing = sum(
        F.bit_count(F.conv(F.substring("fingerprint1", s, 8), 16, 10).cast("long").bitwiseXOR(F.conv(F.substring("fingerprint2", s, 8), 16, 10).cast("long")))
        for s in range(1, BITS // 4 + 1, 8)
    )
    alike = F.greatest(F.lit(0.0), 1 - 2 * differing / BITS)

    def verify(pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.col("a").alias("doc")).union(pairs.select("b")).distinct()
        n_ids = ids.limit(BROADCAST_ROWS + 1).count()
        met = fetched(pairs, firsts.join(broadcast_if_small(ids, n_ids), "doc", "left_semi"), ["fingerprint"])
        return met.where(alike >= least).select("a", "b").distinct()

    def blocks(rest: DataFrame) -> DataFrame:
        return block_links(rest, firsts, least)

    labels = connected(banded(firsts, *shape), "key", folder, verify, [], lambda k: F.xxhash64("doc", F.lit(k)), F.lit(True), last=blocks)
    # members of a class follow its first, those of a large one in parts
    large = classes_.where("size > 1")
    n_members = large.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    first_of = for_all_parts(split_hot(large, "fingerprint", large, n_members, F.lit(0)).drop("part", "size"))
    members = split_hot(rows, "fingerprint", large, n_members, F.xxhash64("id")).join(first_of, ["fingerprint", "part"]).select("id", "doc")
    if labels is None:
        labels = rows.select(F.col("id").alias("doc"), F.col("id").alias("component")).limit(0)
    follow = members.where("id <> doc").join(labels, "doc", "left").select("id", F.coalesce("component", "doc").alias("near_class"))
    every = labels.select(F.col("doc").alias("id"), F.col("component").alias("near_class")).union(follow)
    # an id with several texts may be in several classes
    return every.groupBy("id").agg(F.min("near_class").alias("near_class"))


def with_near_class(result: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows with ``near_class``: the smallest id that near fingerprints connect with theirs."""
    folder = shared_folder(result.sparkSession)
    found = stored(near_classes(result, id_col, folder=folder), f"{folder}/near")
    n = found.limit(BROADCAST_ROWS + 1).count()
    joined = result.join(broadcast_if_small(found, n), result[id_col] == found["id"], "left").drop("id")
    return joined.withColumn("near_class", F.coalesce(F.col("near_class"), F.col(id_col)))

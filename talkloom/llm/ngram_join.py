"""N-gram Jaccard join: near-duplicate documents by rare-first prefix filtering.

Documents are sets of distinct word shingles; two link when ``100 * |A n B| >=
80 * |A u B|``, that is ``9 * |A n B| >= 4 * (|A| + |B|)``.

1. Each document's shingles are hashed and dealt by hash with packed blocks of
   (document, hash): one exchange gives every shingle's document frequency.
   Shingles of a single document go no further; a second exchange brings the
   others, with their frequencies, back together by document.  Both are dealt
   into as many groups and partitions as the bytes of text ask for, so a group
   keeps its size as the input grows.  Shingles that a bounded sample shows in
   a large share of documents are known to be frequent: they are ordered last
   without being counted, and only travel with their document.
2. Shingles are ordered rarest first.  A document whose own shingles fill its
   prefix can link with nothing and is done.
3. Equal sets are one class.  Class representatives meet on prefix n-grams,
   under length and positional filters; a pair is verified once, behind a
   suffix filter that bounds the overlap by ranges of hashes.
4. Within an n-gram's list of documents, all are first compared with one hub,
   in a few rounds with other hubs.  Then lists with one component left are
   done, and in the others each document outside the list's main component is
   compared with all documents of other components, block by block.  So a list
   of n like documents takes about n comparisons, not n squared, yet no link
   between components is missed.

Long lists, and documents that meet many others, are split into parts for every
join; what is joined to them is repeated for each part.

Hashes have 56 bits: two different shingles of one pair of documents count as
equal with a chance below 1e-11.

Defined cases: null or word-less text has an empty set, links with nothing and
is its own component; texts of fewer than five words are one shingle; texts of
any length are read whole; rows that repeat an id are one document that has the
shingles of all its rows, and each of them gets a row of the result; a row with
a null id has the size of its set, is compared with nothing and has no
component; an empty table gives an empty result.  Only the id and text columns
are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, _SPACE_TABLE, broadcast_if_small, for_all_parts, give_back, lean, raw_texts, shared_folder, split_hot, stored
from .hubs import connected, fetched

SHINGLE = 5
#: Shingles in one packed block, and bytes of text hashed at once.
BLOCK_SHINGLES = 1 << 19
CHUNK_BYTES = 1 << 20
HASH_BITS = 56
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_FACTORS = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]
#: Shingles that one group of the first exchange is to have, and bytes of one partition.
GROUP_SHINGLES = 1 << 21
PARTITION_BYTES = 96 << 20
#: Documents of the sample for frequent shingles, and the share of it that makes one.
SAMPLE_DOCS = 20_000
FREQUENT = 1 / 256
#: Documents of one piece of the sample.
SAMPLE_PIECE = 1024


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Shingler:
    """Distinct shingle hashes of texts, computed on flat arrays of bytes."""

    def __init__(self):
        self.up, self.down = _powers(CHUNK_BYTES, _BASE), _powers(CHUNK_BYTES, _INVERSE)

    def hashes(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """Sorted distinct hashes of each text, CHUNK_BYTES of text at a time."""
        out: list[np.ndarray] = []
        part: list[bytes] = []
        size = 0
        for raw in texts:
            raw = raw or b""
            if part and size + len(raw) >= CHUNK_BYTES - len(part) - 1:
                out.extend(self._chunk(part))
                part, size = [], 0
            part.append(raw)
            size += len(raw)
        return out + self._chunk(part) if part else out

    def _chunk(self, texts: list[bytes]) -> list[np.ndarray]:
        flat = np.frombuffer(b" ".join(texts).translate(_SPACE_TABLE) + b" ", np.uint8)
        n = len(flat)
        up, down = (self.up, self.down) if n <= CHUNK_BYTES else (_powers(n, _BASE), _powers(n, _INVERSE))
        inside = flat != 32
        edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(flat.astype(np.uint64) * up[:n], dtype=np.uint64)])
        word = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        cut = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        first = np.searchsorted(starts, cut)
        m = max(0, len(word) - SHINGLE + 1)
        wide = np.zeros(m, np.uint64)
        for k in range(SHINGLE):
            wide += word[k : k + m] * _FACTORS[k]
        wide = mix(wide) >> np.uint64(64 - HASH_BITS)
        out = []
        for a, b in zip(first[:-1], first[1:], strict=True):
            if b - a >= SHINGLE:
                out.append(np.unique(wide[a : b - SHINGLE + 1]))
            elif b > a:
                short = int(b - a)
                for k in range(b - a):
                    short = (short * int(_FACTORS[4]) + int(word[a + k])) % (1 << 64)
                out.append(mix(np.array([short], np.uint64)) >> np.uint64(64 - HASH_BITS))
            else:
                out.append(np.zeros(0, np.uint64))
        return out


def pack(*columns: tuple[np.ndarray, int]) -> bytes:
    """Columns of numbers, each with its kept low bytes, as planes of bytes."""
    parts = []
    for values, width in columns:
        values = np.ascontiguousarray(values).astype(np.uint64, copy=False)
        parts.append(np.array([len(values), width], np.uint32).tobytes())
        parts.append(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes())
    return b"".join(parts)


def unpack(blob: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(blob):
        n, width = np.frombuffer(blob, np.uint32, 2, at).tolist()
        planes = np.frombuffer(blob, np.uint8, n * width, at + 8).reshape(width, n)
        values = np.zeros((n, 8), np.uint8)
        values[:, :width] = planes.T
        out.append(values.reshape(-1).view(np.uint64))
        at += 8 + n * width
    return out


def pack_docs(docs: np.ndarray, more: tuple[tuple[np.ndarray, int], ...]) -> bytes:
    """Entries of ascending runs of documents: run ids, run lengths, other columns."""
    heads = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]])) if len(docs) else np.zeros(0, np.int64)
    ids = docs[heads].astype(np.int64)
    steps = np.diff(ids, prepend=0).view(np.uint64)
    return pack((steps, 8), (np.diff(np.append(heads, len(docs))), 4), *more)


def unpack_docs(blob: bytes) -> tuple[np.ndarray, list[np.ndarray]]:
    steps, runs, *more = unpack(blob)
    return np.repeat(np.cumsum(steps.view(np.int64)), runs.astype(np.int64)), more


#: The order of shingles known to be frequent, beyond all counted ones.
MOST = (1 << 32) - 1


def power_of_two(n: int) -> int:
    return 1 << max(0, n - 1).bit_length()


def doc_bucket(ids: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(ids.view(np.uint64)) & np.uint64(buckets - 1)).astype(np.int32)


def grouped_runs(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(key, places of it in their first order) for every distinct key."""
    order = np.argsort(keys, kind="stable")
    bounds = np.flatnonzero(np.diff(keys[order])) + 1
    for places in np.split(order, bounds) if len(order) else []:
        yield int(keys[places[0]]), places


def frequent_shingles(source: DataFrame, n_docs: int) -> np.ndarray:
    """Sorted hashes of shingles in a large share of a bounded sample of the documents.

    Each piece of the sample reports what is frequent in it: what is frequent in
    all of it is so in some piece.  Reports are at most 1 / FREQUENT times a
    text's shingles for each of SAMPLE_DOCS / SAMPLE_PIECE pieces.
    """
    chance = min(1.0, SAMPLE_DOCS / max(1, n_docs))
    drawn = source.where(F.pmod(F.xxhash64("doc"), F.lit(1_000_000)) < int(chance * 1_000_000) + 1)
    drawn = drawn.repartition(SAMPLE_DOCS // SAMPLE_PIECE)  # the whole table is scanned by as many tasks as it has

    @lean
    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            for lo in range(0, batch.num_rows, SAMPLE_PIECE):
                piece = batch.slice(lo, SAMPLE_PIECE)
                sets = shingler.hashes(raw_texts(piece.column("text")))
                if len(sets) < SAMPLE_PIECE // 4:  # too few to tell
                    continue
                values, counts = np.unique(np.concatenate(sets), return_counts=True)
                often = counts >= len(sets) * FREQUENT
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[often].view(np.int64), pa.int64()), pa.array(counts[often], pa.int64())], names=["hash", "n"]
                )

    reports = drawn.mapInArrow(report, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    least = int(min(n_docs, SAMPLE_DOCS) * FREQUENT)
    found = reports.where(F.col("n") >= max(2, least)).select("hash").toArrow().column("hash").to_numpy()
    return np.sort(found.astype(np.int64).view(np.uint64))


def shared_shingles(docs: DataFrame, id_col: str, text_col: str, folder: str) -> DataFrame:
    """Per document: n (set size), rows (that have its id), own (shingles of no
    other document) and, if a link is possible, the other shingles rarest
    first, with their prefix part.

    Columns doc, rows, n, own, tokens (packed, null if no link is possible),
    prefix, sig (digest of an equal set).
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).where("doc is not null")
    size = source.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    # a shingle takes some six bytes of text, and some ten in an exchange
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, 2 * size["bytes"] // PARTITION_BYTES)
    buckets = max(256, power_of_two(parts), power_of_two(size["bytes"] // 6 // GROUP_SHINGLES))
    doc_buckets = power_of_two(max(parts, size["bytes"] // 6 // GROUP_SHINGLES))
    shift = np.uint64(HASH_BITS - buckets.bit_length() + 1)
    low_bytes = (int(shift) + 7) // 8
    frequent = frequent_shingles(source, size["n"])

    @lean
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        ids: list[int] = []
        sets: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            lengths = np.array([len(s) for s in sets], np.int64)
            owners = np.array(ids, np.int64)
            hashes = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            entry_docs = np.repeat(owners, lengths)
            often = np.zeros(len(hashes), bool)
            if len(frequent):
                often = frequent[np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)] == hashes
            common, common_docs = hashes[often], entry_docs[often]
            hashes, entry_docs = hashes[~often], entry_docs[~often]
            keys, blobs = [], []
            for b, at in grouped_runs((hashes >> shift).astype(np.int32)):
                low = hashes[at] & np.uint64((1 << int(shift)) - 1)
                keys.append(b)
                blobs.append(pack_docs(entry_docs[at], ((low, low_bytes),)))
            # set sizes, and shingles known to be frequent, go by document
            common_at = dict(grouped_runs(doc_bucket(common_docs, doc_buckets)))
            for b, at in grouped_runs(doc_bucket(owners, doc_buckets)):
                keys.append(-1 - b)
                blobs.append(pack_docs(owners[at], ((lengths[at], 4),)))
                if b in common_at:
                    keys.append(-1 - b)
                    blobs.append(pack_docs(common_docs[common_at[b]], ((common[common_at[b]], HASH_BITS // 8), (np.full(len(common_at[b]), MOST), 4))))
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                piece = batch.slice(lo, 256)
                found = shingler.hashes(raw_texts(piece.column("text")))
                ids.extend(piece.column("doc").to_pylist())
                sets.extend(found)
                size += sum(map(len, found))
                del found
                if size >= BLOCK_SHINGLES:
                    yield flush()
                    ids, sets, size = [], [], 0
        if ids:
            yield flush()

    def count(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        blobs = table.column("blob").to_pylist()
        if bucket < 0:  # passes through
            return pa.table({"part": pa.array([-1 - bucket] * len(blobs), pa.int32()), "blob": pa.array(blobs, pa.binary())})
        owners, hashes = [], []
        for blob in blobs:
            d, (h,) = unpack_docs(blob)
            owners.append(d)
            hashes.append(h)
        d, h = np.concatenate(owners), np.concatenate(hashes)
        order = np.argsort(h, kind="stable")
        heads = np.flatnonzero(np.concatenate([[True], np.diff(h[order]) != 0]))
        runs = np.diff(np.append(heads, len(order)))
        frequency = np.empty(len(order), np.int64)
        frequency[order] = np.repeat(runs, runs)
        keep = np.flatnonzero(frequency > 1)
        keep = keep[np.argsort(d[keep], kind="stable")]
        d, h, f = d[keep], h[keep] | np.uint64(bucket << int(shift)), frequency[keep]
        keys, out = [], []
        for b, at in grouped_runs(doc_bucket(d, doc_buckets)):
            keys.append(b)
            out.append(pack_docs(d[at], ((h[at], HASH_BITS // 8), (np.minimum(f[at], MOST - 1), 4))))
        give_back()
        return pa.table({"part": pa.array(keys, pa.int32()), "blob": pa.array(out, pa.binary())})

    def gather(table: pa.Table) -> pa.Table:
        ids, sizes, owners, hashes, frequencies = [], [], [], [], []
        for blob in table.column("blob").to_pylist():
            d, more = unpack_docs(blob)
            if len(more) == 1:
                ids.append(d)
                sizes.append(more[0].astype(np.int64))
            else:
                owners.append(d)
                hashes.append(more[0])
                frequencies.append(more[1])
        rows: dict[str, list] = {k: [] for k in ("doc", "rows", "n", "own", "tokens", "prefix", "sig")}
        everyone, places, copies = np.unique(np.concatenate(ids), return_inverse=True, return_counts=True)
        n_of = np.zeros(len(everyone), np.int64)
        np.add.at(n_of, places, np.concatenate(sizes))
        if owners:
            d, h, f = np.concatenate(owners), np.concatenate(hashes), np.concatenate(frequencies)
            order = np.lexsort((h, f, d))
            d, h = d[order], h[order]
            lo, hi = np.searchsorted(d, everyone, "left"), np.searchsorted(d, everyone, "right")
        else:
            h, lo, hi = np.zeros(0, np.uint64), np.zeros(len(everyone), int), np.zeros(len(everyone), int)
        for i, doc in enumerate(everyone.tolist()):
            tokens = h[lo[i] : hi[i]]
            n = int(n_of[i])
            if copies[i] > 1 and len(tokens):  # a repeated id: what its rows share counts once
                distinct = tokens[np.concatenate([[True], tokens[1:] != tokens[:-1]])]
                n -= len(tokens) - len(distinct)
                tokens = distinct
            own, prefix = n - len(tokens), n - (4 * n + 4) // 5 + 1
            live = n > 0 and own < prefix
            rows["doc"].append(doc)
            rows["rows"].append(int(copies[i]))
            rows["n"].append(n)
            rows["own"].append(own)
            rows["tokens"].append(tokens.tobytes() if live else None)
            rows["prefix"].append(tokens[: prefix - own].view(np.int64).tolist() if live else None)
            rows["sig"].append(_digest(tokens) if live and not own else (f"{doc}" if live else None))
        del ids, sizes, owners, hashes, frequencies
        give_back()
        kinds = {"doc": pa.int64(), "rows": pa.int64(), "n": pa.int64(), "own": pa.int64(), "tokens": pa.binary(), "prefix": pa.list_(pa.int64()), "sig": pa.string()}
        return pa.table({k: pa.array(rows[k], t) for k, t in kinds.items()})

    dealt = source.mapInArrow(deal, "bucket int, blob binary").repartition(parts, "bucket")
    counted = dealt.groupBy("bucket").applyInArrow(count, "part int, blob binary").repartition(parts, "part")
    gathered = counted.groupBy("part").applyInArrow(
        gather, "doc long, rows long, n long, own long, tokens binary, prefix array<long>, sig string"
    )
    return stored(gathered, f"{folder}/sets")


def _digest(tokens: np.ndarray) -> str:
    return "=" + hashlib.md5(np.sort(tokens).tobytes()).hexdigest()


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link, each looked at once; pairs are ids until here."""
    ids = pairs.select(F.col("a").alias("doc")).union(pairs.select("b")).distinct()
    n_ids = ids.limit(BROADCAST_ROWS + 1).count()
    full = sets.where("tokens is not null").select("doc", "n", "tokens")
    full = full.join(broadcast_if_small(ids, n_ids), "doc", "left_semi")
    @lean
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = np.uint64(HASH_BITS - 5)
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                na, ta, nb, tb = (batch.column(c)[i].as_py() for c in ("n1", "tokens1", "n2", "tokens2"))
                x, y, need = np.frombuffer(ta, np.uint64), np.frombuffer(tb, np.uint64), 4 * (na + nb)
                # suffix filter: no range of hashes can hold more common tokens than either side has
                ranges = np.minimum(np.bincount((x >> shift).astype(np.intp), minlength=32), np.bincount((y >> shift).astype(np.intp), minlength=32))
                keep.append(9 * int(ranges.sum()) >= need and 9 * len(np.intersect1d(x, y, assume_unique=True)) >= need)
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])

    met = fetched(pairs, full, ["n", "tokens"])
    return met.select("a", "b", "n1", "tokens1", "n2", "tokens2").mapInArrow(check, "a long, b long")


def may_link(n1: str, i1: str, n2: str, i2: str) -> F.Column:
    """Length and positional filters at a common n-gram, given the places of it."""
    a, b = F.col(n1), F.col(n2)
    rest = F.least(a - F.col(i1), b - F.col(i2))
    return (5 * F.least(a, b) >= 4 * F.greatest(a, b)) & (9 * rest >= 4 * (a + b))


def link_classes(sets: DataFrame, folder: str) -> DataFrame:
    """(id, component) of every document that links, or equals one, with another.

    Rounds work on what is left: links become edges between the components so
    far, so no round looks at the links of an earlier one again.
    """
    live = sets.where("tokens is not null")
    classes = stored(live.groupBy("sig").agg(F.min("doc").alias("doc"), F.count("*").alias("copies")), f"{folder}/classes")
    own_class = live.where("own = 0").select(F.col("doc").alias("id"), "sig")
    shared = classes.where("copies > 1").select("sig", "doc", F.col("copies").alias("size"))
    n_copies = shared.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    dealt = split_hot(own_class, "sig", shared, n_copies, F.xxhash64("id"))
    firsts = for_all_parts(split_hot(shared, "sig", shared, n_copies, F.lit(0)).drop("part", "size"))
    copies = stored(dealt.join(firsts, ["sig", "part"]).where("id <> doc").select("id", "doc"), f"{folder}/copies")
    kept = live.select("doc", "n", "own", "prefix").join(classes.select("doc"), "doc", "left_semi")
    grams = kept.select("doc", "n", "own", F.posexplode("prefix").alias("k", "gram"))
    grams = grams.select("gram", "doc", "n", "own", (F.col("own") + F.col("k")).alias("i"))

    def turn(k: int) -> F.Column:
        # a document with few shingles of its own is near the middle of its group
        return F.struct(F.floor(F.col("own") / (1 + 4 * k)), F.xxhash64("doc", F.lit(k)))

    may_meet = may_link("n", "i", "n2", "i2")
    labels = connected(grams, "gram", folder, lambda pairs: verified(pairs, sets), ["n", "i"], turn, may_meet)
    if labels is None:
        return copies.select("id", F.col("doc").alias("component"))
    like = copies.join(labels, "doc", "left").select("id", F.coalesce("component", "doc").alias("component"))
    return labels.select(F.col("doc").alias("id"), "component").union(like)


def set_sizes(docs: DataFrame, text_col: str) -> DataFrame:
    """Set sizes of texts that are compared with nothing: a map."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            sizes = [len(s) for s in shingler.hashes(raw_texts(batch.column("text")))]
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], names=["n_shingles"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "n_shingles long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """(id, n_shingles, component_id) of every row of the documents."""
    folder = folder or shared_folder(docs.sparkSession)
    sets = shared_shingles(docs, id_col, text_col, folder)
    labels = link_classes(sets, folder)
    result = sets.select("doc", "rows", "n").join(labels, sets["doc"] == labels["id"], "left")
    result = result.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    kind = docs.schema[id_col].dataType
    known = result.select(
        F.col("doc").cast(kind).alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").cast(kind).alias("component_id")
    )
    none = F.lit(None).cast(kind)
    nameless = set_sizes(docs.where(F.col(id_col).isNull()), text_col).select(none.alias(id_col), "n_shingles", none.alias("component_id"))
    return known.union(nameless)

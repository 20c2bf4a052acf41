"""Ranked lexical search by Fagin's threshold algorithm.

``build_index`` deals documents into shards and stores three tables: shards,
terms with the number of documents that hold them, and totals.  A shard has the
forward index of its documents (terms and their impacts) and, for every term,
the list of its postings sorted by impact; it is a file of its own, goes to
Python by itself and is bounded by DOCS documents or BYTES bytes of text, so a
task holds one shard however many it reads or writes.  Impacts need the totals,
so words are counted first, in a pass of its own.

``search`` sends the items' weighted terms to all shards.  In each of them an
item's lists are read round-robin, some entries of each at a time; a document
that is met for the first time is looked up in the forward index and gets its
whole score.  What an unseen document can reach at most is the weighted sum of
the impacts at which the lists stand; once this threshold is strictly below the
k-th best score, no unseen document can be among the best, nor tie with the
last of them, and reading stops.  The shards' best meet by item, shards' parts
first, for the best of all.

The impact of a term in a document is (1e9 * tf) div (1000 * tf + 20 * m) with
m = 50 + (50 * n * N) div L, its weight floor(1000 * ln((2N + 2) / (2df + 1))).

Defined cases: null and word-less texts have no terms, aren't counted and never
found; texts of any length are read whole, one with more bytes than a shard may
hold being a shard of its own; every row of a table is a document or
an item of its own, so repeated item rows give their results twice; equal
scores rank by ascending id, null ids last; items without known terms, or that
only hold terms of no weight, give no rows; empty tables give no rows.  Only
the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import _WORD_TABLE, broadcast_if_small, lean, raw_texts, shared_folder, stored, words_of

#: Bounds of a shard.
DOCS, BYTES = 1 << 13, 16 << 20
#: Bytes of texts whose words are told apart at once.
PIECE = 4 << 20
#: Entries of a list that are read before the others get their turn; half as many more each turn.
STEP = 64
#: Terms of items that are searched in one pass over the index.
BLOCK_TERMS = 500_000
#: Parts that shards are dealt into where their best first meet.
PARTS = 64
#: Ends each text among the words; no UTF-8 text has this byte.
END = b"\xff "

_SHARD = (
    "doc_ids array<long>, starts array<int>, terms array<int>, impacts array<int>, "
    "vocabulary array<string>, counts array<int>, lists array<int>"
)


def word_bytes(texts: list[bytes | None]) -> np.ndarray:
    """Bytes of all words in order, each with one space after it, END after the words of each text."""
    ended = b" " + END
    raw = np.frombuffer(b"".join([(t or b"").translate(_WORD_TABLE) + ended for t in texts]), np.uint8)
    space = raw == 32
    # of a run of spaces the first one stays, unless it stands at the very start
    return raw[~space | np.concatenate([[False], ~space[:-1]])]


def coded_words(texts: list[bytes | None]) -> pa.DictionaryArray:
    """The words of texts, each as its bytes and a space, with END after each text."""
    data = word_bytes(texts)
    offsets = np.concatenate([[0], np.flatnonzero(data == 32) + 1]).astype(np.int32)
    words = pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return words.dictionary_encode()


def pieces_of(texts: list[bytes | None], size: int) -> Iterator[list[bytes | None]]:
    """Runs of texts with about ``size`` bytes, a longer one by itself."""
    held, n = [], 0
    for t in texts:
        if held and n + len(t or b"") > size:
            yield held
            held, n = [], 0
        held.append(t)
        n += len(t or b"")
    if held:
        yield held


def totals_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(n_docs, total, bytes) of a task: documents with words, their words, bytes of all texts."""
    n_docs = total = size = 0
    for batch in batches:
        for texts in pieces_of(raw_texts(batch.column("text")), PIECE):
            data = word_bytes(texts)
            ends = np.cumsum(data == 32)[data == END[0]]  # words so far where a text ends, with the ends before
            words = np.diff(ends, prepend=-1) - 1
            n_docs += int((words > 0).sum())
            total += int(words.sum())
            size += sum(len(t or b"") for t in texts)
    yield pa.RecordBatch.from_pydict({"n_docs": [n_docs], "total": [total], "bytes": [size]})


def impacts_of(tf: np.ndarray, n: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """Impacts of postings by occurrences and length of the document."""
    if len(n) and 50 * int(n.max()) * n_docs >= 1 << 63:  # beyond 64 bits only products are
        n = n.astype(object)
    m = (50 + (50 * n * n_docs) // total).astype(np.int64)
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def shard_row(ids: pa.Array, texts: list[bytes | None], n_docs: int, total: int) -> pa.RecordBatch | None:
    """A shard as one row of arrays; None if no document has a word."""
    words = pa.chunked_array([coded_words(some) for some in pieces_of(texts, PIECE)]).unify_dictionaries()
    dictionary = words.chunk(0).dictionary
    codes = np.concatenate([c.indices.to_numpy() for c in words.chunks])
    end = dictionary.index(pa.scalar(END, dictionary.type)).as_py()
    ends = codes == end
    owner = np.cumsum(ends)[~ends]
    codes = codes[~ends]
    if not len(codes):
        return None
    # postings by document and term; a word's repeats stand side by side
    keys = owner.astype(np.int64) * len(dictionary) + codes
    keys.sort()
    first = np.concatenate([[True], keys[1:] != keys[:-1]])
    places = np.flatnonzero(first)
    tf = np.diff(places, append=len(keys))
    doc, term = np.divmod(keys[places], len(dictionary))
    held, doc, lengths = np.unique(doc, return_inverse=True, return_counts=True)
    n = np.bincount(doc, tf).astype(np.int64)
    impacts = impacts_of(tf, n[doc], n_docs, total)
    # lists by term, then falling impact, then document: one number for all three
    bits = max(1, int(len(held) - 1).bit_length())
    order = ((term * (1 << 20) + ((1 << 20) - 1 - impacts)) << bits) | doc
    order.sort()
    vocabulary = pa.array([w[:-1] for w in dictionary.to_pylist()[:end] + dictionary.to_pylist()[end + 1 :]], pa.binary()).cast(pa.string())
    term = term - (term > end)
    columns = {
        "doc_ids": ids.take(pa.array(held)), "starts": running(lengths), "terms": term, "impacts": impacts, "vocabulary": vocabulary,
        "counts": np.bincount(term, minlength=len(vocabulary)), "lists": order & ((1 << bits) - 1),
    }
    flat = [c if isinstance(c, pa.Array) else pa.array(c.astype(np.int32)) for c in columns.values()]
    return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in flat], list(columns))


def running(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)


def shard_rows(n_docs: int, total: int, docs: int, size: int):
    """A function that makes shards of the documents of a task as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held = [], [], 0

        def cut() -> Iterator[pa.RecordBatch]:
            made = shard_row(pa.array(ids, pa.int64()), texts, n_docs, total)
            if made is not None:
                yield made

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), raw_texts(batch.column("text")), strict=True):
                n = len(text or b"")
                if ids and (len(ids) == docs or held + n > size):
                    yield from cut()
                    ids, texts, held = [], [], 0
                ids.append(doc)
                texts.append(text)
                held += n
        if ids:
            yield from cut()

    return lean(run)


class Index:
    """Stored tables: ``shards``, ``vocabulary`` (term, df), ``totals`` (one row: n_docs, total)."""

    def __init__(self, spark: SparkSession, folder: str):
        # a session of its own, as others' batches may have many rows
        alone = spark.newSession()
        alone.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
        self.shards = alone.read.schema(_SHARD).parquet(f"{folder}/shards")
        self.vocabulary = spark.read.schema("term string, df long").parquet(f"{folder}/vocabulary")
        totals = spark.read.schema("n_docs long, total long").parquet(f"{folder}/totals").first()
        self.n_docs: int = totals["n_docs"]
        self.total: int = totals["total"]


def build_index(
    docs: DataFrame, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", docs_of_shard: int = DOCS, bytes_of_shard: int = BYTES
) -> Index:
    """Index all documents into a new folder; any number of searches can be made of it."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark)
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    counted = read.select("text").mapInArrow(lean(totals_rows), "n_docs long, total long, bytes long")
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("n_docs", "total", "bytes")]
    row = stored(counted.agg(*sums), f"{folder}/totals").first()
    # many small partitions would make many small shards; they are read together, without a shuffle
    tasks = max(-(-row["bytes"] // bytes_of_shard), -(-row["n_docs"] // docs_of_shard), spark.sparkContext.defaultParallelism)
    shards = read.coalesce(tasks).mapInArrow(shard_rows(row["n_docs"], row["total"], docs_of_shard, bytes_of_shard), _SHARD)
    # Parquet's writers and readers hold many rows of a file at once, so each shard has its own
    shards.write.mode("overwrite").option("maxRecordsPerFile", 1).parquet(f"{folder}/shards")
    held = spark.read.schema(_SHARD).parquet(f"{folder}/shards").select(F.explode(F.arrays_zip("vocabulary", "counts")).alias("x"))
    stored(held.groupBy(F.col("x.vocabulary").alias("term")).agg(F.sum("x.counts").alias("df")), f"{folder}/vocabulary")
    return Index(spark, folder)


def weighted_terms(index: Index, items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(query, item_id, term, w): terms of items that documents hold, with their weights."""
    spread = items.select(F.monotonically_increasing_id().alias("query"), F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
    read = spread.mapInArrow(_item_terms, f"query long, item_id {items.schema[id_col].dataType.simpleString()}, term string")
    n_docs = F.lit(float(index.n_docs))
    w = F.floor(1000 * F.log((2 * n_docs + 2) / (2 * F.col("df").cast("double") + 1))).cast("long")
    return read.join(index.vocabulary, "term").select("query", "item_id", "term", w.alias("w"))


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms = [sorted(set(words_of(raw))) for raw in raw_texts(batch.column("text"))]
        at = pa.array(np.repeat(np.arange(len(terms)), [len(t) for t in terms]))
        flat = pa.array([t for ts in terms for t in ts], pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("query").take(at), batch.column("item_id").take(at), flat], ["query", "item_id", "term"])


class Reader:
    """A shard that answers queries, whose terms are known by their places in ``names``."""

    def __init__(self, batch: pa.RecordBatch, row: int, names: pa.Array):
        one = {name: batch.column(name).slice(row, 1).flatten() for name in batch.schema.names}
        ids = one["doc_ids"]
        #: ids to order by and their absence, as null ids come last
        self.absent = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy()
        starts, terms, impacts, counts, self.lists = (one[c].to_numpy() for c in ("starts", "terms", "impacts", "counts", "lists"))
        place = pc.index_in(names, one["vocabulary"]).fill_null(-1).to_numpy()
        list_ends = np.cumsum(counts, dtype=np.int64)
        #: for each name its list
        held = place >= 0
        self.low = np.where(held, (list_ends - counts)[place], 0)
        self.high = np.where(held, list_ends[place], 0)
        # of the forward index, what the names ask for: postings by document
        number = np.full(len(counts), -1, np.int32)
        number[place[held]] = np.flatnonzero(held)
        named = number[terms]
        asked = named >= 0
        self.terms, self.impacts = named[asked], impacts[asked]
        upto = np.cumsum(asked, dtype=np.int32)
        self.starts = np.where(starts > 0, upto[starts - 1], 0)
        self.weight = np.zeros(len(names), np.int64)

    def scores(self, docs: np.ndarray) -> np.ndarray:
        """Whole scores of documents from the forward index, by the weights set now."""
        starts, sizes = self.starts[docs], self.starts[docs + 1] - self.starts[docs]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)
        return np.add.reduceat(self.weight[self.terms[at]] * self.impacts[at], ends - sizes)

    def impact_at(self, name: int, place: int) -> int:
        """The impact of the entry at a place of a list, from its document's forward entries."""
        doc = self.lists[place]
        lo, hi = self.starts[doc], self.starts[doc + 1]
        return int(self.impacts[lo + np.flatnonzero(self.terms[lo:hi] == name)[0]])

    def best(self, names: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents of the shard with the k best scores above 0, their scores, and the entries read."""
        held = (self.high[names] > self.low[names]) & (weights > 0)
        names, weights = names[held], weights[held]
        self.weight[names] = weights
        at, ends, step = self.low[names], self.high[names], STEP
        seen = np.zeros(len(self.ids), bool)
        docs, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        while (at < ends).any():
            upto = np.minimum(at + step, ends)
            met = np.zeros(len(self.ids), bool)
            for a, b in zip(at.tolist(), upto.tolist(), strict=True):
                met[self.lists[a:b]] = True
            new = np.flatnonzero(met & ~seen)
            seen |= met
            at, step = upto, step + step // 2
            if len(new):
                docs, scores = np.concatenate([docs, new]), np.concatenate([scores, self.scores(new)])
                order = np.lexsort((self.ids[docs], self.absent[docs], -scores))[:k]
                docs, scores = docs[order], scores[order]
            going = np.flatnonzero(at < ends)
            threshold = sum(int(weights[i]) * self.impact_at(names[i], at[i] - 1) for i in going)
            if len(docs) == k and threshold < scores[-1]:
                break
        read = int((at - self.low[names]).sum())
        self.weight[names] = 0
        found = scores > 0
        return docs[found], scores[found], read


def searcher(queries: list[tuple[int, list[str], list[int]]], k: int):
    """A function over shard rows that gives (query, part, doc_id, score) of each shard's best."""
    names = sorted({t for _, terms, _ in queries for t in terms})
    number = {t: i for i, t in enumerate(names)}
    asked = [(q, np.array([number[t] for t in terms]), np.array(weights, np.int64)) for q, terms, weights in queries]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(names, pa.string())
        for batch in batches:
            for row in range(batch.num_rows):
                shard, out = Reader(batch, row, known), []
                for q, terms, weights in asked:
                    docs, scores, _ = shard.best(terms, weights, k)
                    ids = pa.array(shard.ids[docs], pa.int64(), mask=shard.absent[docs])
                    one, part = np.full(len(docs), q), np.full(len(docs), int(shard.ids[0]) % PARTS)
                    out.append(pa.RecordBatch.from_arrays([pa.array(one), pa.array(part), ids, pa.array(scores, pa.int64())], ["query", "part", "doc_id", "score"]))
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()

    return lean(run)


def search(index: Index, items: DataFrame, k: int = 50, id_col: str = "item_id", text_col: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item."""
    spark, folder = items.sparkSession, shared_folder(items.sparkSession)
    terms = stored(weighted_terms(index, items, id_col, text_col), f"{folder}/terms")
    asked = stored(terms.groupBy("query").agg(F.first("item_id").alias("item_id"), F.count("*").alias("n")), f"{folder}/asked")
    size = asked.agg(F.count("*").alias("queries"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    schema = "query long, part long, doc_id long, score long"
    spark.createDataFrame([], schema).write.parquet(f"{folder}/found")
    n_blocks = -(-size["terms"] // block_terms)
    for b in range(n_blocks):
        some = terms.where(F.pmod(F.xxhash64("query"), F.lit(n_blocks)) == b)
        rows = some.groupBy("query").agg(F.collect_list("term").alias("terms"), F.collect_list("w").alias("weights"))
        queries = [(r["query"], r["terms"], r["weights"]) for r in rows.collect()]  # about block_terms terms
        if queries:
            index.shards.mapInArrow(searcher(queries, k), schema).write.mode("append").parquet(f"{folder}/found")
    found = spark.read.schema(schema).parquet(f"{folder}/found")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # the best of parts of the shards come first, so that no task gets all shards' of an item
    some = found.withColumn("rank", F.row_number().over(Window.partitionBy("query", "part").orderBy(*order))).where(F.col("rank") <= k)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= k)
    return best.join(broadcast_if_small(asked, size["queries"]), "query").select(F.col("item_id").alias(id_col), "rank", "doc_id", "score")

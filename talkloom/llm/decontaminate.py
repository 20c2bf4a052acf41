"""Benchmark decontamination by a distributed positional inverted index.

The index holds a posting (term, document, position) for every place of a
training token that test items use, next to each document's length.  A test
phrase is found by intersecting posting lists, each moved back by its term's
offset in the item: lists that agree on an alignment of item and document are
one occurrence.  Intersection starts from the two rarest terms of each window,
whose lists are short; only alignments on which both agree meet the lists of
the other terms.

All steps are DataFrame operations.  Postings are keyed by document and place
before they are shuffled, and tokens that meet a large vocabulary by term and a
salt, so no frequent term gathers in one task.

Defined cases: null or word-less text has no words and no hits; texts of any
length are indexed whole; an item without words is ignored; items are told
apart by row, hits by item_id (null ids don't count); among terms that are
equally rare the first place in the window is the anchor, which changes no
result; document rows that repeat get one result row each, with equal results
for equal id and text; empty tables give no hits or no rows.  Only the id and
text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import BROADCAST_ROWS, broadcast_if_small, shared_folder, stored

#: ASCII that separates words once A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Columns that tell documents apart; ``copy`` keeps repeated ids with other texts apart.
KEY = ["doc_id", "copy"]


#: Terms up to which the vocabulary is broadcast, and salts of each term beyond that.
VOCABULARY_ROWS = BROADCAST_ROWS
SALTS = 64


def words(text: Column) -> Column:
    """Array of words; only A-Z are lower-cased, also in texts with other letters."""
    low = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _UPPER.lower())
    )
    return F.array_remove(F.split(F.coalesce(low, F.lit("")), SEPARATORS), "")


def same_doc(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["copy"] == b["copy"])


class Phrases:
    """Test items as terms with offsets; stored, as keys must not change."""

    def __init__(self, items: DataFrame, folder: str, width: int, id_col: str = "item_id", text_col: str = "text"):
        rows = items.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("terms"))
        rows = rows.where(F.size("terms") > 0).withColumn("item", F.monotonically_increasing_id())
        rows = rows.withColumn("n", F.size("terms"))
        self.items = stored(rows, f"{folder}/items")
        self.width = width
        #: (item, q, term) for every word of every item
        self.terms = self.items.select("item", "n", F.posexplode("terms").alias("q", "term"))
        # the empty term, which is no word, stands for document lengths
        vocabulary = self.terms.select("term").union(self.items.sparkSession.sql("select '' as term")).distinct()
        self.vocabulary = stored(
            vocabulary.select("term", F.monotonically_increasing_id().alias("term_id")), f"{folder}/vocabulary"
        )
        self.n_terms = self.vocabulary.count()
        self.length_id = self.vocabulary.where("term = ''").first()["term_id"]
        self.n_places = self.terms.count()


def build_index(docs: DataFrame, phrases: Phrases, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store the postings (term_id, doc_id, copy, pos) of all documents.

    One pass over the corpus, without a shuffle while the vocabulary has no more
    than VOCABULARY_ROWS terms, else with one by term and salt.  The length of a document is a posting of its own.
    """
    text = F.col(text_col)
    tokens = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(text, F.col(id_col).isNull()).alias("copy"),
        F.posexplode(F.array_append(words(text), F.lit(""))).alias("pos", "term"),
    )
    if phrases.n_terms <= VOCABULARY_ROWS:
        known = tokens.join(F.broadcast(phrases.vocabulary), "term")
    else:
        salted = tokens.withColumn("salt", F.pmod(F.xxhash64("copy", "pos"), F.lit(SALTS)))
        every_salt = phrases.vocabulary.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        known = salted.join(every_salt, ["term", "salt"])
    return stored(known.select("term_id", "doc_id", "copy", "pos"), f"{folder}/index")


def anchor_pairs(index: DataFrame, phrases: Phrases) -> DataFrame:
    """Per window of an item, the offsets of its two rarest terms.

    Windows with a term that the corpus lacks are left out: nothing can match.
    """
    frequency = index.groupBy("term_id").agg(F.count("*").alias("f"))
    vocabulary = phrases.vocabulary.join(frequency, "term_id", "left")
    rated = phrases.terms.join(vocabulary, "term")
    last_start = F.greatest(F.col("n") - phrases.width, F.lit(0))
    starts = F.sequence(F.greatest(F.col("q") - (phrases.width - 1), F.lit(0)), F.least(F.col("q"), last_start))
    placed = rated.select("item", "q", "term_id", "f", F.explode(starts).alias("start"))
    return (
        placed.groupBy("item", "start")
        .agg(
            F.count_if(F.col("f").isNull()).alias("absent"),
            F.array_sort(F.collect_list(F.struct("f", "q", "term_id"))).alias("by_rarity"),
        )
        .where("absent = 0")
        .select(
            "item",
            F.col("by_rarity")[0]["q"].alias("q1"),
            F.col("by_rarity")[0]["term_id"].alias("t1"),
            F.try_element_at("by_rarity", F.lit(2))["q"].alias("q2"),
            F.try_element_at("by_rarity", F.lit(2))["term_id"].alias("t2"),
        )
        .select("item", "q1", "t1", F.coalesce("q2", "q1").alias("q2"), F.coalesce("t2", "t1").alias("t2"))
        .distinct()
    )


def around(place: Column, slop: int) -> Column:
    """The place itself, or a row for each place within ``slop`` of it."""
    return F.explode(F.sequence(place - slop, place + slop)) if slop else place


def occurrences(index: DataFrame, phrases: Phrases, folder: str, slop: int = 0) -> DataFrame:
    """Maximal matched stretches: (doc_id, copy, item, align, lo, hi).

    ``lo`` to ``hi`` are item places, each inside an occurrence of a window;
    the document places are these plus ``align``, give or take ``slop`` for each.
    """
    small = phrases.n_places
    pairs = stored(anchor_pairs(index, phrases), f"{folder}/pairs")
    anchors = pairs.select("item", F.col("q1").alias("q"), F.col("t1").alias("term_id")).union(
        pairs.select("item", "q2", "t2")
    )
    seen = (
        index.join(broadcast_if_small(anchors.distinct(), 2 * small), "term_id")
        .select(*KEY, "item", around(F.col("pos") - F.col("q"), slop).alias("align"), "q")
        .groupBy(*KEY, "item", "align")
        .agg(F.collect_set("q").alias("found"))
    )
    wanted = pairs.groupBy("item").agg(F.collect_list(F.struct("q1", "q2")).alias("pairs"))
    both = F.exists(
        "pairs", lambda p: F.array_contains("found", p["q1"]) & F.array_contains("found", p["q2"])
    )
    candidates = stored(
        seen.join(broadcast_if_small(wanted, small), "item").where(both).select(*KEY, "item", "align"),
        f"{folder}/candidates",
    )
    n_docs = candidates.select(*KEY).distinct().count()
    candidate_docs = broadcast_if_small(candidates.select(*KEY).distinct(), n_docs)
    near = index.join(candidate_docs, same_doc(index, candidate_docs), "left_semi")
    numbered = phrases.terms.join(phrases.vocabulary, "term").select("item", "q", "term_id")
    expected = candidates.join(broadcast_if_small(numbered, small), "item").withColumn("pos", around(F.col("align") + F.col("q"), slop))
    matched = (
        expected.join(
            near, same_doc(expected, near) & (expected["pos"] == near["pos"]) & (expected["term_id"] == near["term_id"]), "left_semi"
        )
        .select(*KEY, "item", "align", "q")
        .distinct()
    )
    run = Window.partitionBy(*KEY, "item", "align").orderBy("q")
    stretches = (
        matched.withColumn("island", F.col("q") - F.row_number().over(run))
        .groupBy(*KEY, "item", "align", "island")
        .agg(F.min("q").alias("lo"), F.max("q").alias("hi"))
    )
    sizes = phrases.items.select("item", "n", "item_id")
    return stretches.join(broadcast_if_small(sizes, small), "item").where(
        F.col("hi") - F.col("lo") + 1 >= F.least(F.col("n"), F.lit(phrases.width))
    )


def contamination(
    docs: DataFrame, items: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    folder = shared_folder(docs.sparkSession)
    phrases = Phrases(items, folder, width)
    index = build_index(docs, phrases, folder, id_col, text_col)
    found = stored(occurrences(index, phrases, folder), f"{folder}/found")
    covered = F.sequence(F.col("align") + F.col("lo"), F.col("align") + F.col("hi"))
    places = found.select(*KEY, F.col("item_id").cast("string").alias("item_id"), F.explode(covered).alias("pos"))
    hits = places.groupBy(*KEY).agg(
        F.count_distinct("pos").alias("n_hit"), F.sort_array(F.collect_set("item_id")).alias("ids")
    )
    lengths = index.where(F.col("term_id") == phrases.length_id)
    joined = lengths.join(hits, same_doc(lengths, hits), "left")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select(
        lengths["doc_id"].alias(id_col),
        F.col("pos").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def proximity(index: DataFrame, phrases: Phrases, slop: int) -> DataFrame:
    """Windows whose terms all stand within ``slop`` places of one alignment.

    Gives maximal stretches (doc_id, copy, item_id, align, lo, hi).  With slop 0
    these are exact phrases; each posting proposes 2 * slop + 1 alignments.
    """
    found = occurrences(index, phrases, shared_folder(index.sparkSession), slop)
    return found.select(*KEY, "item_id", "align", "lo", "hi")


def near_items(
    docs: DataFrame, items: DataFrame, slop: int = 1, width: int = 10, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: n_near_items, near_items_sha256 of the items with windows in proximity."""
    folder = shared_folder(docs.sparkSession)
    phrases = Phrases(items, folder, width)
    index = build_index(docs, phrases, folder, id_col, text_col)
    near = proximity(index, phrases, slop).groupBy(*KEY).agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))
    lengths = index.where(F.col("term_id") == phrases.length_id)
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return lengths.join(near, same_doc(lengths, near), "left").select(
        lengths["doc_id"].alias(id_col),
        F.size(ids).cast("long").alias("n_near_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("near_items_sha256"),
    )

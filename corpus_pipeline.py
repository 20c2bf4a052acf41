"""The corpus pipeline: five stages over documents.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept,
and returns the columns of documents, also such as this module doesn't know; the
last returns the encodings.

Defined cases, each stage deciding by row: a null or letterless text goes at
the first stage; null ids are documents as any other, and of linked rows they
come last; of rows that repeat one another, or link, one stays; rows of one id
with different texts are judged by themselves; texts of any length are read
whole; an empty table gives an empty result at every stage, and so does an empty
table of labels (nothing is rejected) or of benchmark items (nothing is hit).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.llm import bpe, decontaminate, langid, ngram_join, quality, queries
from talkloom.llm.common import free_names, shared_folder, stored, table
from talkloom.session import share_package


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or in no known language, go; others keep their row.

    Foreign is a text whose letters cost more than the limits that held-out
    texts of its length set; shorter texts than 16 letters are never foreign.
    """
    trees = langid.fit(docs, limits=True)
    keep = {c: F.col(c) for c in docs.columns if c not in ("doc_id", "text")}
    known = free_names(docs.columns, langid.RESULTS)[-1]
    return langid.predict(docs, trees, keep=keep, keep_text=True).where(F.col(known)).select(*docs.columns)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    accepted = free_names(docs.columns, quality.RESULTS)[-1]
    return quality.score(docs, model).where(F.col(accepted)).select(*docs.columns)


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a row number, stored so that it stays the same, and its name."""
    row = free_names(docs.columns, ["row"])[0]
    return stored(docs.withColumn(row, F.monotonically_increasing_id()), f"{shared_folder(docs.sparkSession)}/rows"), row


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked rows, the first one with the smallest id stays; null ids come last.

    Texts without words are linked with none; of those only repeated rows go.
    """
    rows, row = numbered(docs)
    linked = ngram_join.near_duplicates(rows, row).select(F.col(row).alias("row"), "component_id").where("component_id <> row")
    members = linked.union(linked.select("component_id", "component_id").distinct())
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")
    ids = rows.select(F.col(row).alias("row"), "doc_id")
    first = members.join(ids, "row").groupBy("component_id").agg(F.min(place)["row"].alias("row"))
    blank = rows.where(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", "") == "")
    one = blank.groupBy("doc_id", "text").agg(F.min(row).alias("row"))
    repeated = blank.select(F.col(row).alias("row")).join(one, "row", "left_anti")
    gone = members.join(first, "row", "left_anti").select("row").union(repeated)
    return rows.join(gone, rows[row] == gone["row"], "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a passage of the benchmark go."""
    rows, row = numbered(docs)
    found = decontaminate.contamination(rows, table(spark, sf_dir, "benchmark"), id_col=row)
    gone = found.where("contaminated").select(F.col(row).alias("row"))
    return rows.join(gone, rows[row] == gone["row"], "left_anti").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(docs, f"{queries.TOKENIZERS}/word_bpe_49k.json")


STAGES = [
    ("language ID", language_id),
    ("quality classifier", quality_filter),
    ("n-gram Jaccard join", deduplicate),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", encode),
]
#: SQL can't express the trained stages; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages, each written as Parquet and read again as the next one's docs."""
    share_package(spark)
    folder = shared_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/stage{k}")
    return STAGES[-1][1](spark, docs, sf_dir)

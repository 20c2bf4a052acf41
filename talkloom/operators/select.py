"""Selection: pending rows, id prefixes, longest, shuffled, first rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import md5_int
from .selection import numbered


def pending(rows: DataFrame, done: DataFrame, key: str = "request_id", force: bool = False) -> DataFrame:
    """Rows not done yet; repeated rows stay repeated."""
    return rows if force else rows.join(done.select(key), key, "left_anti")


def by_prefixes(rows: DataFrame, prefixes: list[str] | DataFrame, key: str = "request_id") -> DataFrame:
    """Rows whose id starts with any prefix, of a list or of a table's first column.

    An empty list means all rows, an empty table none.  Prefixes that have a
    shorter one in the set add nothing; without them at most one prefix fits an
    id, so an equi-join of the id's heads, of the lengths that occur, keeps every
    row once.  Null ids and null prefixes fit nothing.
    """
    if isinstance(prefixes, list):
        if not prefixes:
            return rows
        prefixes = rows.sparkSession.createDataFrame([(p,) for p in prefixes], "prefix string")
    known = prefixes.select(F.col(prefixes.columns[0]).cast("string").alias("_prefix")).where("_prefix is not null").distinct()
    # at most as many lengths as the longest prefix has characters
    lengths = sorted(r["n"] for r in known.select(F.length("_prefix").alias("n")).distinct().collect())
    if not lengths:
        return rows.limit(0)
    heads = lambda c, upto: F.transform(F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= upto), lambda n: F.substring(c, F.lit(1), n))
    longer = known.select("_prefix", F.explode(heads(F.col("_prefix"), F.length("_prefix") - 1)).alias("_head"))
    shorter = known.select(F.col("_prefix").alias("_head"))
    covered = longer.join(shorter, "_head").select("_prefix").distinct()
    free = known.join(covered, "_prefix", "left_anti")
    given = F.col(key).cast("string")
    return rows.withColumn("_prefix", F.explode(heads(given, F.length(given)))).join(free, "_prefix").select(*rows.columns)


def longest(rows: DataFrame, n: int, text: str = "response_text", order: str = "pos") -> DataFrame:
    """The n rows of the longest text, earlier rows first among equals: a top-k, not a sort."""
    return rows.orderBy(F.length(text).desc(), order).limit(n)


def head(rows: DataFrame, n: int, order: str = "pos") -> DataFrame:
    """The first n rows by position; 0 means all."""
    return rows.orderBy(order).limit(n) if n else rows


def shuffled(rows: DataFrame, seed: int | None = None, key: str = "request_id") -> DataFrame:
    return rows.orderBy(F.rand() if seed is None else F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))))


def select_for_labelling(log: DataFrame, done: DataFrame, prefixes: list[str], force: bool, shuffle: bool, top: int, limit: int) -> DataFrame:
    """The fixed order of the original: ids or pending, shuffle, longest, limit.

    ``force`` counts only together with ids.
    """
    rows = by_prefixes(pending(log, done, force=force), prefixes) if prefixes else pending(log, done)
    order = "pos"
    if shuffle:
        rows, order = rows.withColumn("turn", F.rand()), "turn"
    if top:
        rows = longest(rows, top, order=order)
    return head(rows, limit, order) if limit else rows


def needs_validation(rows: DataFrame) -> DataFrame:
    return rows.where("validation is null and not coalesce(manually_reviewed, false)")


def open_failures(rows: DataFrame) -> DataFrame:
    return rows.where("validation.status = 'fail' and not coalesce(manually_reviewed, false)")


def all_failures(rows: DataFrame) -> DataFrame:
    return rows.where("validation.status = 'fail'")


def ranked_by_hash(rows: DataFrame, key: str, seed: int = 42, folder: str | None = None) -> DataFrame:
    """Rows with ``rank``, 0-based, in a seeded order that no partitioning changes.

    Ranks come from ranges sized by rows; no task sees all rows.
    """
    turn = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return numbered(rows.withColumn("turn", turn), ["turn", key], "rank", folder).drop("turn")


def split(rows: DataFrame, key: str, share: float = 0.1, seed: int = 42) -> DataFrame:
    """Rows marked ``eval`` (exactly int(n * share) of them) or ``train``."""
    counted = rows.agg(F.floor(F.count("*") * F.lit(share)).alias("n_eval"))
    ranked = ranked_by_hash(rows, key, seed).crossJoin(F.broadcast(counted))
    return ranked.withColumn("part", F.when(F.col("rank") < F.col("n_eval"), "eval").otherwise("train")).drop("rank", "n_eval")


def coin(key: str, seed: int = 42) -> F.Column:
    """A seeded coin per row that other engines reproduce."""
    return md5_int(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))) % 2 == 0


def assignments(count_rows: DataFrame, dims: dict[str, list], index: str = "i") -> DataFrame:
    """Row i gets entry i mod length of every dimension."""
    picks = {k: F.element_at(F.array(*map(F.lit, v)), (F.pmod(F.col(index), F.lit(len(v))) + 1).cast("int")) for k, v in dims.items()}
    return count_rows.withColumns(picks)

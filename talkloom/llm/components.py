"""Connected components of links by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Rounds settle in about log2 of a component's size; more than these are an error.
MAX_ROUNDS = 60


def components(links: DataFrame, folder: str) -> DataFrame:
    """(id, component) of every linked id; component is the smallest id reached.

    ``links`` has columns a and b.  Every round is written to ``folder``, so a
    lost executor costs no more than the round under way; rows stay narrow and
    are as many as the links at most.
    """
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        f"{folder}/edges0",
    )
    mark = None
    for k in range(1, MAX_ROUNDS):
        # large star: larger neighbours move to the smallest neighbour
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(least, "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        # small star: smaller neighbours and the node itself move to the smallest
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small_least, "u")
        small = (
            moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(small_least.select("u", "m"))
            .distinct()
        )
        edges = stored(small, f"{folder}/edges{k}")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == tuple(now):
            break
        mark = tuple(now)
    else:
        raise RuntimeError(f"components didn't settle in {MAX_ROUNDS} rounds")
    ids = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ids.union(edges.select("v", "v").distinct())

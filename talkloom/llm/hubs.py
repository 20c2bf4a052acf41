"""Components of documents that share list keys, without all pairs of a list.

Documents are rows (key, doc, further columns); those of one key form its list.
In a few rounds each document of a list is compared with one hub.  Lists with
one component left are then done; in the others each document outside the
list's main component is compared with all documents of other components, block
by block.  So a list of n like documents takes about n comparisons, yet no link
between components is missed.

Long lists, and hubs that meet many, are split into parts for every join; what
is joined to them is repeated for each part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import for_all_parts, split_hot, stored
from .components import components

ROUNDS = 2


def with_lists(rows: DataFrame, key: str, folder: str) -> DataFrame:
    """Rows of lists longer than one, dealt into parts; stored."""
    lists = stored(rows.groupBy(key).agg(F.count("*").alias("size")).where("size > 1"), f"{folder}/lists")
    total = lists.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    dealt = split_hot(rows, key, lists, total, F.xxhash64("doc"))
    kept = for_all_parts(split_hot(lists, key, lists, total, F.lit(0)).drop("part", "size"))
    return stored(dealt.join(kept, [key, "part"], "left_semi"), f"{folder}/listed")


def connected(
    rows: DataFrame,
    key: str,
    folder: str,
    verify: Callable[[DataFrame], DataFrame],
    further: list[str],
    turn: Callable[[int], Column],
    may_meet: Column,
    last: Callable[[DataFrame], DataFrame] | None = None,
    rounds: int | None = None,
) -> DataFrame | None:
    """(doc, component) of the documents that verified links connect, None without any list.

    ``rows`` has key, doc and the further columns; ``turn(k)`` orders a list's
    documents, the first being round k's hub; ``may_meet`` is a cheap test on
    the further columns of one side and those of the other, named with a 2.
    ``verify`` keeps the pairs (a, b) that link.  Each round goes on from the
    components so far, and no pair is looked at twice.  ``last`` may take the
    last round's place: it gets the rows of the lists left, with main (the
    label of the largest component) and list_size, and gives links.
    """
    rounds = ROUNDS if rounds is None else rounds
    listed = with_lists(rows, key, folder)
    sides = ["doc", *further, "label"]
    tried = labels = None
    for k in range(rounds + 1):
        if labels is None:
            labelled = listed.withColumn("label", F.col("doc"))
        else:
            labelled = listed.join(labels, "doc", "left").withColumn("label", F.coalesce("component", "doc")).drop("component")
            ends = labelled.groupBy(key).agg(F.min("label").alias("x"), F.max("label").alias("y"), F.max("parts").alias("parts"), F.count("*").alias("n"))
            # both documents of a list of two have met
            open_lists = for_all_parts(ends.where("x <> y and n > 2").select(key, "parts"))
            labelled = stored(labelled.join(open_lists, [key, "part"], "left_semi"), f"{folder}/open{k}")
        if labelled.isEmpty():
            break
        if k < rounds:
            hub = F.min(F.struct(turn(k).alias("turn"), *sides)).alias("hub")
            hubs = for_all_parts(labelled.groupBy(key).agg(hub, F.max("parts").alias("parts")))
            met = labelled.join(hubs, [key, "part"]).select(*sides, *(F.col(f"hub.{c}").alias(f"{c}2") for c in sides))
        else:
            sizes = labelled.groupBy(key, "label").agg(F.count("*").alias("size"), F.max("parts").alias("parts"))
            main = sizes.groupBy(key).agg(
                F.max_by("label", F.struct("size", "label")).alias("main"), F.max("parts").alias("parts"), F.sum("size").alias("list_size")
            )
            marked = labelled.join(for_all_parts(main), [key, "part"])
            if last is not None:
                found = stored(last(marked), f"{folder}/links{k}")
                labels = merge_components(labels, found, f"{folder}/cc{k}")
                break
            outside = marked.where("label <> main").drop("main", "list_size")
            others = labelled.select(key, "parts", F.col("part").alias("part2"), *(F.col(c).alias(f"{c}2") for c in sides))
            # one block for every two parts of a list
            blocks = outside.withColumn("part2", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
            met = blocks.join(for_all_parts(others), [key, "part", "part2"])
        # the hub stands first, as it meets many
        pairs = met.where((F.col("label") != F.col("label2")) & may_meet).select(F.col("doc2").alias("a"), F.col("doc").alias("b")).distinct()
        if tried is not None:
            either = tried.union(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
            pairs = pairs.join(either, ["a", "b"], "left_anti")
        pairs = stored(pairs, f"{folder}/pairs{k}")
        found = stored(verify(pairs), f"{folder}/links{k}")
        tried = pairs if tried is None else tried.union(pairs)
        labels = merge_components(labels, found, f"{folder}/cc{k}")
    return labels


def fetched(pairs: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs (a, b) with the columns of both documents, named with 1 and 2.

    ``table`` has doc and the columns.  Those of ``b`` go to its pairs; pairs
    then meet those of ``a``, which are sent once to each part of its pairs.
    """
    left = table.select(F.col("doc").alias("a"), *(F.col(c).alias(f"{c}1") for c in columns))
    right = table.select(F.col("doc").alias("b"), *(F.col(c).alias(f"{c}2") for c in columns))
    sizes = pairs.groupBy("a").agg(F.count("*").alias("size"))
    dealt = split_hot(pairs, "a", sizes, pairs.count(), F.xxhash64("b"))
    hubs = for_all_parts(left.join(dealt.groupBy("a").agg(F.max("parts").alias("parts")), "a"))
    return dealt.join(right, "b").join(hubs, ["a", "part"])


def merge_components(labels: DataFrame | None, links: DataFrame, folder: str) -> DataFrame:
    """Components (doc, component) after further links between documents."""
    if labels is None:
        return stored(components(links, folder).select(F.col("id").alias("doc"), "component"), f"{folder}/labels")
    a = labels.select(F.col("doc").alias("a"), F.col("component").alias("ca"))
    b = labels.select(F.col("doc").alias("b"), F.col("component").alias("cb"))
    edges = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    merged = components(edges, folder).select("id", F.col("component").alias("to"))
    new = merged.select(F.col("id").alias("doc"), F.col("id").alias("component")).join(labels.select("doc"), "doc", "left_anti")
    every = labels.union(new).join(merged, F.col("component") == F.col("id"), "left")
    return stored(every.select("doc", F.coalesce("to", "component").alias("component")), f"{folder}/labels")

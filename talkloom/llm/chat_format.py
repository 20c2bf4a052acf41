"""Chat formatting: reply trees to conversations with a loss mask.

Messages form trees by their parents.  Iterated self-joins double the reach of
every message's ancestor pointer, so a tree of depth d takes about log2 d
rounds; they also sum scores from the root.  Branches are ranked by the score
of their root-to-leaf path; the messages of each chosen path are gathered with
the same pointers, and each path is formatted as one conversation.

Defined cases: null roles and texts count as empty; a message whose parent is
missing is a root; ties between branches go to the longer, then to the
smaller leaf id; messages on a cycle, or under one, have no root and are left out; null tree ids
form a tree of their own; an empty table gives no conversations.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import shared_folder, stored

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"


def escape(text: str) -> str:
    """Make control strings impossible: ``\\`` is doubled, ``<|`` becomes ``<\\|``."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def format_turns(turns: list[tuple[str, str]], trained: tuple[str, ...] = ("assistant",)) -> tuple[str, list[tuple[int, int]]]:
    """The conversation as one text, and the spans of it that loss is taken on."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = TURN + escape(role) + TEXT, escape(text)
        if role in trained:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation; the inverse of ``format_turns``."""
    turns = []
    for piece in formatted.split(END)[:-1]:
        role, _, text = piece.removeprefix(TURN).partition(TEXT)
        turns.append((unescape(role), unescape(text)))
    return turns


def masked_text(formatted: str, spans: list[tuple[int, int]]) -> str:
    """All text under the loss mask, unescaped."""
    return "".join(unescape(formatted[a:b]) for a, b in spans)


def best_paths(messages: DataFrame, folder: str, branches: int = 1) -> DataFrame:
    """Messages of the chosen paths: (leaf, root, node, depth).

    ``messages`` has node (unique long), parent (long or null) and score.
    """
    known = messages.select(F.col("node").alias("parent"))
    linked = messages.select("node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    rooted = linked.join(known, "parent", "left_semi").unionByName(
        linked.join(known, "parent", "left_anti").withColumn("parent", F.lit(None).cast("long"))
    )
    rooted = stored(rooted, f"{folder}/rooted")
    start = ("node", F.lit(1).cast("long").alias("depth"), F.col("score").alias("total"))
    # rows whose path to the root is known, and rows whose pointer has not met it
    settled = rooted.where("parent is null").select(*start, F.col("node").alias("root"))
    active = rooted.where("parent is not null").select(*start, F.col("parent").alias("up"))
    parents = rooted.where("parent is not null").select(F.col("parent").alias("node")).distinct()
    n, jumps = rooted.count(), []
    while not active.isEmpty() and 1 << len(jumps) <= n:
        jumps.append(active)
        none = F.lit(None).cast("long")
        above = settled.select("node", "depth", "total", "root", none.alias("up")).unionByName(active.withColumn("root", none))
        above = above.toDF(*(f"{c}_2" for c in above.columns))
        step = stored(
            active.join(above, F.col("up") == F.col("node_2")).select(
                "node", (F.col("depth") + F.col("depth_2")).alias("depth"), (F.col("total") + F.col("total_2")).alias("total"),
                F.col("root_2").alias("root"), F.col("up_2").alias("up"),
            ),
            f"{folder}/up{len(jumps)}",
        )
        settled = settled.union(step.where("root is not null").drop("up"))
        active = step.where("root is null").drop("root")
    leaves = settled.join(parents, "node", "left_anti")
    order = F.struct("total", "depth", (-F.col("node")).alias("first"))
    if branches == 1:
        chosen = leaves.groupBy("root").agg(F.max_by("node", order).alias("leaf"))
    else:
        rank = F.row_number().over(Window.partitionBy("root").orderBy(order.desc()))
        chosen = leaves.withColumn("rank", rank).where(F.col("rank") <= branches).select("root", F.col("node").alias("leaf"))
    path = chosen.select("leaf", "root", F.col("leaf").alias("node"))
    for k, jump in enumerate(jumps):
        higher = path.join(jump.select("node", "up"), "node").select("leaf", "root", F.col("up").alias("node"))
        path = stored(path.union(higher), f"{folder}/path{k}")
    return path.join(settled.select("node", "depth"), "node")


def format_chats(
    messages: DataFrame,
    branches: int = 1,
    trained: tuple[str, ...] = ("assistant",),
    folder: str | None = None,
) -> DataFrame:
    """Format the best branches of every tree.

    ``messages``: tree, node (unique long), parent, role, text, score.  Gives
    (tree, leaf, formatted, mask), mask being an array of (start, end) in code
    points.
    """
    folder = folder or shared_folder(messages.sparkSession)
    paths = best_paths(messages, folder, branches)
    texts = messages.select("tree", "node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = (
        paths.join(texts, "node")
        .groupBy("leaf")
        .agg(F.first("tree").alias("tree"), F.array_sort(F.collect_list(F.struct("depth", "node", "role", "text"))).alias("turns"))
    )
    tree_type = messages.schema["tree"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            out = [format_turns([(t["role"], t["text"]) for t in turns], trained) for turns in batch.column("turns").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("tree"), batch.column("leaf"), pa.array([f for f, _ in out], pa.string()),
                 pa.array([[{"start": a, "end": b} for a, b in m] for _, m in out], pa.list_(span))],
                names=["tree", "leaf", "formatted", "mask"],
            )

    return turns.mapInArrow(run, f"tree {tree_type}, leaf long, formatted string, mask array<struct<start:long,end:long>>")


def chain_messages(turns: DataFrame, folder: str, id_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Rows of linear conversations as messages whose parent is the row before.

    Rows with the same turn follow one another by role and text; a
    conversation is one formatted text in the end, so its rows meet in one
    sorted group here too.
    """
    rows = stored(
        turns.select(
            F.col(id_col).alias("tree"), F.col(turn_col).alias("turn"), "role", "text",
            F.monotonically_increasing_id().alias("node"),
        ),
        f"{folder}/rows",
    )
    before = F.lag("node").over(Window.partitionBy("tree").orderBy("turn", "role", "text", "node"))
    return stored(rows.withColumn("parent", before).withColumn("score", F.lit(0.0)), f"{folder}/chain")


def digests(chats: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Counts and digests read back from formatted conversations and their masks."""
    tree_type = chats.schema["tree"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for formatted, mask in zip(batch.column("formatted").to_pylist(), batch.column("mask").to_pylist(), strict=True):
                turns = parse_turns(formatted)
                loss = masked_text(formatted, [(m["start"], m["end"]) for m in mask])
                whole = "".join(f"{role}\n{text}\n" for role, text in turns)
                rows.append((
                    len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
                    hashlib.sha256(loss.encode()).hexdigest(), len(formatted),
                ))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("tree"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=[id_col, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    return chats.select("tree", "formatted", "mask").mapInArrow(
        run,
        f"`{id_col}` {tree_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )

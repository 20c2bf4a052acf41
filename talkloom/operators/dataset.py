"""Training sets: eligibility, chat samples, leakage, length distribution, synthetic rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import chat
from ..functions.text import has_tag, strip, tag, text_of

#: Length buckets in words, lower bound inclusive, upper exclusive.
BUCKETS = [(0, 50, "0-50 words"), (50, 100, "50-100 words"), (100, 200, "100-200 words"), (200, 500, "200-500 words"), (500, None, "500+ words")]
SYNTHETIC_PREFIX = "syn-"
#: Window titles of synthetic rows; any list can take its place.
WINDOWS = ["Editor - notes", "Terminal - shell", "Browser - mail", "Chat - team", "Player - review"]


def eligible(rows: DataFrame, exclude_failed: bool = False) -> DataFrame:
    """Reviewed or synthetic rows; validation counts only if asked for."""
    kept = rows.where(F.coalesce("manually_reviewed", F.lit(False)) | F.startswith("request_id", F.lit(SYNTHETIC_PREFIX)))
    return kept.where("coalesce(validation.status, '') <> 'fail'") if exclude_failed else kept


def chat_samples(rows: DataFrame, system_prompt: str) -> DataFrame:
    """(messages) of rows that have both a label and a transcript."""
    parts = chat.components("raw_request_json")
    label = strip("label")
    user = chat.user_message(parts["window_context"], parts["clipboard_context"], parts["custom_vocabulary"], parts["transcript"])
    usable = rows.where((label != "") & (parts["transcript"] != ""))
    return usable.select(chat.chat_messages(F.lit(system_prompt), user, label).alias("messages"))


def leakage(parts: DataFrame, text: str) -> DataFrame:
    """One row (leaked): texts that are in both splits."""
    both = parts.groupBy(F.md5(text_of(text)).alias("t")).agg(F.count_distinct("part").alias("n"))
    return both.agg(F.count_if(F.col("n") > 1).alias("leaked"))


def bucket(count: Column) -> Column:
    out = F
    for _, high, label in BUCKETS[:-1]:
        out = out.when(count < high, F.lit(label))
    return out.otherwise(F.lit(BUCKETS[-1][2]))


def bucket_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, b[2]) for i, b in enumerate(BUCKETS)], "position int, bucket string")


def length_distribution(spark: SparkSession, counts: DataFrame, flags: dict[str, Column] | None = None) -> DataFrame:
    """Counts and shares of all length buckets, empty ones too, one pair of columns
    for each population; ``counts`` has the column words."""
    flags = flags or {"n": F.lit(True)}
    found = counts.groupBy(bucket(F.col("words")).alias("bucket")).agg(*(F.count_if(c).alias(k) for k, c in flags.items()))
    joined = bucket_table(spark).join(found, "bucket", "left")
    full = joined.select("position", "bucket", *(F.coalesce(k, F.lit(0)).cast("long").alias(k) for k in flags))
    totals = full.agg(*(F.sum(k).alias(f"total_{k}") for k in flags))
    share = lambda k: F.coalesce(F.try_divide(F.col(k) * 100.0, F.col(f"total_{k}")), F.lit(0.0)).alias(f"pct_{k}")
    return full.crossJoin(F.broadcast(totals)).select("bucket", *flags, *(share(k) for k in flags))


def synthetic_rows(assigned: DataFrame, reply: str, prompt: str, vocabulary: str, model: str) -> DataFrame:
    """Synthetic labelled rows of replies that hold a raw and a clean transcript."""
    whole = assigned.where(has_tag(reply, "RAW_TRANSCRIPT") & has_tag(reply, "CLEAN_TRANSCRIPT"))
    window = F.element_at(F.array(*map(F.lit, WINDOWS)), (F.pmod(F.col("index"), F.lit(len(WINDOWS))) + 1).cast("int"))
    system = chat.system_text(F.lit(prompt), window, F.lit(vocabulary))
    return whole.select(
        synthetic_id(F.col("index")).alias("request_id"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.lit(model).alias("model_used_for_label"),
        F.lit("synthetic").alias("original_model"),
        chat.envelope(system, chat.transcript_text(tag(reply, "RAW_TRANSCRIPT")), model).alias("raw_request_json"),
        F.lit("").alias("original_response"),
        tag(reply, "CLEAN_TRANSCRIPT").alias("label"),
    )


def synthetic_id(index: Column) -> Column:
    return F.format_string("syn-%03d", index)

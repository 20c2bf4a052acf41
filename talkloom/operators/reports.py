"""Reports as rows of text, in order of ``line``; raw request columns stay out of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import chat, verdicts
from ..functions.text import or_else
from .selection import meet, numbered


def distribution_report(distribution: DataFrame, populations: list[str]) -> DataFrame:
    """(bucket, text) of a length distribution: count and share for each population."""
    cells = [F.format_string("%10s (%5.1f%%)", F.format_number(p, 0), F.col(f"pct_{p}")) for p in populations]
    return distribution.select("bucket", F.concat_ws("  ", F.rpad("bucket", 14, " "), *cells).alias("text"))


def failure_listing(rows: DataFrame, order: str | None = None) -> DataFrame:
    """(type, n, request_id, reason) of open failures; n counts the type.

    With an ``order`` column also ``line``, which numbers them from 0 by type and
    then in that order.
    """
    kind = F.coalesce("validation.type", F.lit("UNKNOWN")).alias("type")
    told = rows.select(kind, "request_id", F.col("validation.reason").alias("reason"), *([F.col(order).alias("_order")] if order else []))
    counted = meet(told, told.groupBy("type").agg(F.count("*").alias("n")), ["type"])
    if order is None:
        return counted.select("type", "n", "request_id", "reason")
    return numbered(counted, ["type", "_order"], "line").select("line", "type", "n", "request_id", "reason")


def inspection(rows: DataFrame) -> DataFrame:
    """Transcript, label and verdict of records, with words where one is missing."""
    status = F.when(F.col("validation").isNull(), "not validated").otherwise(
        F.concat_ws(" ", F.upper("validation.status"), "validation.type", "validation.reason")
    )
    return rows.select(
        "request_id",
        or_else(chat.components("raw_request_json")["transcript"], "(failed to extract)").alias("transcript"),
        or_else("label", "(no label)").alias("label"),
        status.alias("verdict"),
    )


def dimension_report(means: DataFrame, p_values: DataFrame | None = None) -> DataFrame:
    """(line, text) of the per-dimension table."""
    order = F.create_map(*(x for i, d in enumerate(verdicts.WEIGHTS) for x in (F.lit(d), F.lit(i))))
    rows = means.join(p_values, "dimension", "left") if p_values is not None else means.withColumn("p", F.lit(None).cast("double"))
    gap = F.col("candidate_avg") - F.col("baseline_avg")
    body = F.format_string(
        "%-26s %2d  %8.2f  %9.2f  %+5.2f  %s", F.regexp_replace("dimension", "_", " "), "weight", "baseline_avg", "candidate_avg", gap, verdicts.p_text(F.col("p"))
    )
    return rows.select(order[F.col("dimension")].alias("line"), body.alias("text"))


def fixed(c: Column | str, digits: int, sign: bool = False) -> Column:
    """A number with so many decimals, halves up; other engines get the same text from the same steps."""
    c = F.col(c) if isinstance(c, str) else c
    scale = 10.0**digits
    return F.format_string(f"%{'+' if sign else ''}.{digits}f", F.floor(c * scale + 0.5).cast("double") / scale)


def evaluation_report(summary: DataFrame, baseline: str, candidate: str) -> DataFrame:
    """(line, text) of a row of ``whole_summary``: each dimension, the overall score with interval and p, wins, latency, decision.

    Lines about what the row lacks (no decided samples, no durations) say so.
    """
    decided = F.col("wins_baseline") + F.col("wins_candidate")
    both = lambda b, c, n: [fixed(b, n), F.lit(" -> "), fixed(c, n), F.lit(" ("), fixed(F.col(c) - F.col(b), n, True), F.lit(")")]
    p = lambda name: F.concat(F.lit(", p "), F.trim(verdicts.p_text(F.col(name))))
    lines = [[F.format_string("%s against %s, samples: %d", F.lit(baseline), F.lit(candidate), "n_samples")]]
    for d, w in verdicts.WEIGHTS.items():
        lines.append([F.lit(f"{d} (weight {w}): "), *both(f"baseline_{d}", f"candidate_{d}", 2), p(f"p_{d}")])
    lines.append([F.lit("overall: "), *both("baseline_avg_score", "candidate_avg_score", 1), p("overall_p_value")])
    lines.append([F.lit("gap, 95% of resamples: "), fixed("gap_low", 2, True), F.lit(" to "), fixed("gap_high", 2, True)])
    share = fixed(F.try_divide(F.col("wins_candidate") * 100.0, decided), 0)
    won = F.concat(share, F.lit("% of "), decided.cast("string"), F.lit(", 95% interval "), fixed(F.col("win_low") * 100, 0), F.lit("% to "), fixed(F.col("win_high") * 100, 0), F.lit("%"))
    lines.append([F.lit("candidate wins: "), F.when(decided > 0, won).otherwise("none decided"), F.lit(", ties: "), F.col("wins_tie").cast("string")])
    timed = (F.col("baseline_latency_avg") != 0) & (F.col("candidate_latency_avg") != 0)
    for k in ("avg", "p50", "p90", "p99"):
        b, c = f"baseline_latency_{k}", f"candidate_latency_{k}"
        times = F.concat(fixed(b, 0), F.lit(" ms -> "), fixed(c, 0), F.lit(" ms, "), fixed(F.try_divide(b, c), 1), F.lit("x"))
        lines.append([F.lit(f"latency {k}: "), F.when(timed, F.coalesce(times, F.lit("-"))).otherwise("not measured")])
    lines.append([F.lit("latency"), p("latency_p_value"), F.lit(", speed ratio "), fixed("speed_ratio", 2)])
    lines.append([F.lit("decision: "), F.col("winner"), F.lit("; "), F.col("winner_reason")])
    texts = F.array(*(F.concat(*(F.coalesce(x, F.lit("-")) for x in line)) for line in lines))
    return summary.select(F.posexplode(texts).alias("line", "text"))


def latency_report(stats: DataFrame) -> DataFrame:
    """(stat, text): baseline, candidate and speed-up, from a row (side, avg, p50, p90, p99) per side."""
    names = ("avg", "p50", "p90", "p99")
    rows = stats.select("side", F.explode(F.array(*(F.struct(F.lit(n).alias("stat"), F.col(n).alias("v")) for n in names))).alias("x")).select("side", "x.*")
    sides = rows.groupBy("stat").agg(*(F.max(F.when(F.col("side") == s, F.col("v"))).alias(s) for s in ("baseline", "candidate")))
    ratio = F.when(F.col("candidate") > 0, F.format_string("%.1fx", F.try_divide(F.col("baseline"), F.col("candidate")))).otherwise("")
    return sides.select("stat", F.format_string("%-20s  %10.0f  %10.0f  %7s", "stat", "baseline", "candidate", ratio).alias("text"))

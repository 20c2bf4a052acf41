"""Review verdicts, judge replies, scores and closed-form statistics."""

from __future__ import annotations

import functools
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import JUDGE_REPLY
from .text import strip, strip_fence

#: Dimensions in report order and their weights; a missing score counts 3 of 5.
WEIGHTS = {
    "meaning_preservation": 3,
    "instruction_following": 3,
    "filler_removal": 2,
    "grammar_fluency": 2,
    "technical_accuracy": 2,
    "conciseness": 1,
}
MAX_SCORE, MISSING = 5, 3
#: Fixed values of the decision: dimensions with a veto, its limit, the margin of a tie.
CRITICAL, VETO, MARGIN = ("meaning_preservation", "instruction_following"), 3.0, 2.0


def verdict(reply: Column | str) -> Column:
    """A review as struct(status, type, reason).

    PASS passes, FAIL fails with ``type: reason`` or as UNKNOWN; any other reply
    passes too.
    """
    text = strip(reply)
    rest = strip(F.substring(text, 5, F.length(text)))
    colon = F.instr(rest, ":")
    kind = F.when(colon == 0, F.lit("UNKNOWN")).otherwise(strip(F.substring(rest, 1, colon - 1)))
    reason = F.when(colon == 0, rest).otherwise(strip(F.substring(rest, colon + 1, F.length(rest))))
    failed = F.startswith(F.upper(text), F.lit("FAIL"))
    none = F.lit(None).cast("string")
    return F.struct(
        F.when(failed, "fail").otherwise("pass").alias("status"),
        F.when(failed, kind).otherwise(none).alias("type"),
        F.when(failed, reason).otherwise(none).alias("reason"),
    )


def judge_reply(reply: Column | str) -> Column:
    """A judge's JSON as struct(output_a, output_b), null unless both are there."""
    # bound by a lambda, so that it is parsed once
    parsed = F.array(F.from_json(strip_fence(reply), JUDGE_REPLY))
    return F.transform(parsed, lambda p: F.when(p["output_a"].isNotNull() & p["output_b"].isNotNull(), p))[0]


def first_reply(replies: Column) -> Column:
    """The first of several attempts that parses, else null."""
    return F.try_element_at(F.filter(F.transform(replies, judge_reply), lambda r: r.isNotNull()), F.lit(1))


def map_back(a_is_baseline: Column, reply: Column) -> dict[str, Column]:
    """Undo the blind order of outputs a and b."""
    a, b = reply["output_a"], reply["output_b"]
    return {
        "baseline_scores": F.when(a_is_baseline, a).otherwise(b),
        "candidate_scores": F.when(a_is_baseline, b).otherwise(a),
    }


def dimension(scores: Column, name: str) -> Column:
    return F.coalesce(F.try_element_at(scores, F.lit(name)), F.lit(float(MISSING)))


def weighted(scores: Column) -> Column:
    """Weighted score of 0 to 100, one decimal."""
    total = sum(dimension(scores, d) * w for d, w in WEIGHTS.items())
    return F.round(total / F.lit(MAX_SCORE * sum(WEIGHTS.values())) * 100, 1)


def wilson(wins: Column, total: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Bounds of Wilson's score interval, 0 and 0 without trials; not rounded."""
    n = F.nullif(total, F.lit(0)).cast("double")
    p = wins / n
    centre, denominator = p + z * z / (2 * n), 1 + z * z / n
    spread = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    zero = F.lit(0.0)
    return F.coalesce((centre - spread) / denominator, zero), F.coalesce((centre + spread) / denominator, zero)


def winner(baseline: Column, candidate: Column, baseline_dims: dict[str, Column], candidate_dims: dict[str, Column]) -> Column:
    """baseline, candidate or tie: critical dimensions first, then the margin."""
    out = F
    for d in CRITICAL:
        b, c = baseline_dims[d], candidate_dims[d]
        out = out.when((c < VETO) & (b >= VETO), F.lit("baseline")).when((b < VETO) & (c >= VETO), F.lit("candidate"))
    out = out.when(F.abs(baseline - candidate) < MARGIN, F.lit("tie"))
    return out.when(candidate > baseline, F.lit("candidate")).otherwise(F.lit("baseline"))


#: Fixed values of winner_reason: the sentences of the original's summaries.
def winner_reason(decided: Column, baseline: Column, candidate: Column, baseline_dims: dict[str, Column], candidate_dims: dict[str, Column]) -> Column:
    out = F
    for d in CRITICAL:
        b, c = baseline_dims[d], candidate_dims[d]
        out = out.when((c < VETO) & (b >= VETO), F.lit(f"Candidate fails critical dimension: {d}"))
        out = out.when((b < VETO) & (c >= VETO), F.lit(f"Baseline fails critical dimension: {d}"))
    gap = F.round(F.abs(candidate - baseline), 1)
    return (
        out.when(decided == "tie", F.format_string("Scores within margin (baseline=%s, candidate=%s)", baseline, candidate))
        .when(decided == "candidate", F.format_string("Candidate wins %s vs %s (+%s)", candidate, baseline, gap))
        .otherwise(F.format_string("Baseline wins %s vs %s (+%s)", baseline, candidate, gap))
    )


def p_text(p: Column) -> Column:
    return F.when(p.isNull(), "n/a   ").when(p < 0.0001, "<.0001").otherwise(F.format_string("%.4f", p))


@functools.cache
def _nearest() -> Callable[[Column, Column], Column]:
    """One function for all calls: an array of numbers, each rounded to its own digits."""

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def nearest(values: pa.Array, digits: pa.Array) -> pa.Array:
        flat = values.flatten().to_pylist()
        out = [None if v is None or v != v else round(v, n) for v, n in zip(flat, digits.flatten().to_pylist(), strict=True)]
        return pa.ListArray.from_arrays(values.offsets, pa.array(out, pa.float64()))

    return nearest


def rounded(c: Column | str, digits: int) -> Column:
    """A float rounded as the original's reports do: the exact binary value to the
    nearest, ties to even."""
    return _nearest()(F.array((F.col(c) if isinstance(c, str) else c).cast("double")), F.array(F.lit(digits)))[0]


def rounded_all(rows: DataFrame, digits: dict[str, int]) -> DataFrame:
    """The rows with some columns rounded, each to its own digits, in one call."""
    values = rows.withColumn("_r", _nearest()(F.array(*(F.col(c).cast("double") for c in digits)), F.array(*map(F.lit, digits.values()))))
    return values.withColumns({c: F.col("_r")[i] for i, c in enumerate(digits)}).drop("_r")

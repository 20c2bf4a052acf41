"""Blind A/B evaluation: pairing, aggregates, significance, decision."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import verdicts
from ..sources.work import stored, work_folder
from . import resampling, selection
from .responders import signed_rank_p
from .select import ranked_by_hash


def cached_samples(samples: DataFrame, cache: DataFrame) -> DataFrame:
    """Samples with cached outputs and scores, and whether they have any; texts meet by their digest."""
    prefilled = cache.select(
        F.sha2("raw_transcript", 256).alias("_key"), F.lit(True).alias("hit"), "baseline_output", "candidate_output", "baseline_scores", "candidate_scores",
        F.coalesce("baseline_duration_ms", F.lit(0.0)).alias("baseline_duration_ms"),
        F.coalesce("candidate_duration_ms", F.lit(0.0)).alias("candidate_duration_ms"),
    )
    keyed = samples.withColumn("_key", F.sha2("raw_transcript", 256))
    return keyed.join(prefilled, "_key", "left").withColumn("cached", F.coalesce("hit", F.lit(False))).drop("hit", "_key")


def detail(samples: DataFrame, baseline: DataFrame, candidate: DataFrame, judgments: DataFrame) -> DataFrame:
    """Rows of judged samples, joined by index; indexes are then counted anew, in their order."""
    rows = (
        samples.join(judgments, "sample_index")
        .join(baseline.select("sample_index", F.col("text").alias("baseline_output"), F.col("duration_ms").alias("baseline_duration_ms")), "sample_index")
        .join(candidate.select("sample_index", F.col("text").alias("candidate_output"), F.col("duration_ms").alias("candidate_duration_ms")), "sample_index")
    )
    # indexes are counted by themselves, so no task numbers whole rows; rows of one index follow one another
    ids = reduce(lambda a, b: a.join(b, "sample_index"), (x.select("sample_index") for x in (samples, judgments, baseline, candidate)))
    starts = selection.numbered(ids, ["sample_index"], "_pos").groupBy("sample_index").agg(F.min("_pos").alias("_start"))
    place = F.row_number().over(Window.partitionBy("sample_index").orderBy("sample_index"))
    rows = rows.join(starts, "sample_index")
    return rows.select(
        (F.col("_start") + place - 1).alias("sample_index"), "raw_transcript", "gold_label", "baseline_output", "candidate_output",
        "baseline_duration_ms", "candidate_duration_ms", "baseline_scores", "candidate_scores",
        verdicts.weighted(F.col("baseline_scores")).alias("baseline_weighted"),
        verdicts.weighted(F.col("candidate_scores")).alias("candidate_weighted"),
    )


def wins(scored: DataFrame) -> DataFrame:
    """One row (baseline, candidate, tie) from rounded weighted scores."""
    b, c = F.col("baseline_weighted"), F.col("candidate_weighted")
    return scored.agg(F.count_if(b > c).alias("baseline"), F.count_if(c > b).alias("candidate"), F.count_if(b == c).alias("tie"))


def dimension_means(judged: DataFrame) -> DataFrame:
    """(dimension, weight, baseline_avg, candidate_avg), missing scores as 3; not rounded."""
    b, c = F.col("baseline_scores"), F.col("candidate_scores")
    one = [
        F.struct(F.lit(d).alias("dimension"), F.lit(w).alias("weight"), verdicts.dimension(b, d).alias("b"), verdicts.dimension(c, d).alias("c"))
        for d, w in verdicts.WEIGHTS.items()
    ]
    rows = judged.select(F.explode(F.array(*one)).alias("x")).select("x.*")
    return rows.groupBy("dimension", "weight").agg(F.avg("b").alias("baseline_avg"), F.avg("c").alias("candidate_avg"))


#: Percentiles that latency tells.
PERCENTILES = {"p50": 0.5, "p90": 0.9, "p99": 0.99}


def mean_latency(rows: DataFrame, duration: str, by: list[str] | None = None) -> DataFrame:
    """avg of non-zero durations, 0 where there are none."""
    return rows.groupBy(*(by or [])).agg(F.coalesce(F.avg(F.when(F.col(duration) != 0, F.col(duration))), F.lit(0.0)).alias("avg"))


def latency(rows: DataFrame, duration: str, by: list[str] | None = None, accuracy: int | None = None, folder: str | None = None) -> DataFrame:
    """avg, p50, p90, p99 of non-zero durations, 0 where there are none.

    Percentiles are exact, found by selection, so no task holds a group's values;
    with an ``accuracy`` they come from a sketch, off by at most 1 / accuracy of the ranks.
    """
    by = by or []
    if accuracy is not None:
        d = F.when(F.col(duration) != 0, F.col(duration))
        stats = {"avg": F.avg(d)} | {k: F.percentile_approx(d, p, accuracy) for k, p in PERCENTILES.items()}
        return rows.groupBy(*by).agg(*(F.coalesce(c, F.lit(0.0)).alias(k) for k, c in stats.items()))
    found = selection.percentiles(rows.where(F.col(duration) != 0), duration, by, PERCENTILES, folder)
    every = rows.groupBy(*by).agg(F.count("*").alias("_n"))
    return selection.meet(every, found, by, "left").select(*by, *(F.coalesce(k, F.lit(0.0)).alias(k) for k in ("avg", *PERCENTILES)))


def speed_ratio(baseline_avg: Column, candidate_avg: Column) -> Column:
    """Ratio of the averages as reported, with one decimal; two decimals, 0 where there is none."""
    ratio = F.try_divide(verdicts.rounded(baseline_avg, 1), verdicts.rounded(candidate_avg, 1))
    return verdicts.rounded(F.coalesce(ratio, F.lit(0.0)), 2)


def rank_paired(a: DataFrame, b: DataFrame, value: str, folder: str | None = None) -> DataFrame:
    """(rank, a, b): values of both sides, each sorted by itself, to the shorter length.

    This is how the original pairs latencies; ``detail`` has the proper pairs.
    """
    sides = a.select(F.lit("a").alias("side"), value).union(b.select(F.lit("b").alias("side"), value))
    placed = selection.ranked(sides, value, ["side"], folder)
    left, right = (placed.where(F.col("side") == x).select("rank", F.col(value).alias(x)) for x in "ab")
    return left.join(right, "rank")


def wilcoxon(diffs: DataFrame, diff: str = "d", by: list[str] | None = None) -> DataFrame:
    """Signed-rank statistics of non-zero differences: n, w_plus, w_minus, tie_term, z; by group.

    Equal sizes are counted first, so ranks need one sort of distinct sizes only.
    """
    by = by or []
    rows = diffs.where(F.col(diff) != 0).groupBy(*by, F.abs(diff).alias("a")).agg(F.count("*").alias("t"), F.count_if(F.col(diff) > 0).alias("plus"))
    order = (Window.partitionBy(*by) if by else Window).orderBy("a").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("t").over(order), F.lit(0))
    ranks = rows.withColumn("rank", before + (F.col("t") + 1) / 2)
    stats = ranks.groupBy(*by).agg(
        F.coalesce(F.sum("t"), F.lit(0)).cast("long").alias("n"),
        F.coalesce(F.sum(F.col("rank") * F.col("plus")), F.lit(0.0)).alias("w_plus"),
        F.coalesce(F.sum(F.col("rank") * (F.col("t") - F.col("plus"))), F.lit(0.0)).alias("w_minus"),
        F.coalesce(F.sum(F.col("t") * F.col("t") * F.col("t") - F.col("t")), F.lit(0)).cast("long").alias("tie_term"),
    )
    n = F.col("n").cast("double")
    spread = F.sqrt(n * (n + 1) * (2 * n + 1) / 24 - F.col("tie_term") / 48)
    z = F.try_divide(F.least("w_plus", "w_minus") - n * (n + 1) / 4, spread)
    return stats.withColumn("z", F.when(n >= 10, z))


def with_p(stats: DataFrame) -> DataFrame:
    return stats.withColumn("p", signed_rank_p("n", F.least("w_plus", "w_minus"), "tie_term", "z"))


def differences(scored: DataFrame, key: str) -> DataFrame:
    """(pos, d) of scored rows: candidate less baseline, numbered in a seeded order."""
    d = (F.col("candidate_weighted") - F.col("baseline_weighted")).alias("d")
    return ranked_by_hash(scored.select(key, d), key).select(F.col("rank").alias("pos"), "d")


def dimension_differences(judged: DataFrame) -> DataFrame:
    """(dimension, d): candidate less baseline for each dimension of each sample."""
    b, c = F.col("baseline_scores"), F.col("candidate_scores")
    one = [F.struct(F.lit(d).alias("dimension"), (verdicts.dimension(c, d) - verdicts.dimension(b, d)).alias("d")) for d in verdicts.WEIGHTS]
    return judged.select(F.explode(F.array(*one)).alias("x")).select("x.*")


def dimension_p(judged: DataFrame) -> DataFrame:
    """(dimension, p) of each dimension's paired scores, no row where too few differ."""
    return with_p(wilcoxon(dimension_differences(judged), by=["dimension"])).select("dimension", "p")


def summary(judged: DataFrame) -> DataFrame:
    """One flat row: counts, means, wins with interval, per-dimension means, decision; ``whole_summary`` has all."""
    b, c = F.col("baseline_scores"), F.col("candidate_scores")
    scored = judged.withColumn("baseline_weighted", verdicts.weighted(b)).withColumn("candidate_weighted", verdicts.weighted(c))
    bw, cw = F.col("baseline_weighted"), F.col("candidate_weighted")
    aggregates = [
        F.count("*").alias("n_samples"), F.avg(bw).alias("baseline_avg_score"), F.avg(cw).alias("candidate_avg_score"),
        F.count_if(bw > cw).alias("wins_baseline"), F.count_if(cw > bw).alias("wins_candidate"), F.count_if(bw == cw).alias("wins_tie"),
    ]
    for d in verdicts.WEIGHTS:
        aggregates += [F.avg(verdicts.dimension(b, d)).alias(f"baseline_{d}"), F.avg(verdicts.dimension(c, d)).alias(f"candidate_{d}")]
    row = scored.agg(*aggregates)
    low, high = verdicts.wilson(F.col("wins_candidate"), F.col("wins_candidate") + F.col("wins_baseline"))
    dims = [{d: F.col(f"{side}_{d}") for d in verdicts.WEIGHTS} for side in ("baseline", "candidate")]
    # decided on means with one decimal, as reported
    means = F.round("baseline_avg_score", 1), F.round("candidate_avg_score", 1)
    decided = verdicts.winner(*means, *dims)
    return row.select("*", low.alias("win_low"), high.alias("win_high"), decided.alias("winner"), verdicts.winner_reason(decided, *means, *dims).alias("winner_reason"))


def whole_summary(
    spark: SparkSession, judged: DataFrame, baseline: DataFrame, candidate: DataFrame, key: str, duration: str = "duration_ms",
    n_draws: int = 10_000, as_reported: bool = True, folder: str | None = None,
) -> DataFrame:
    """The row of ``summary``, rounded as reported unless asked otherwise, with interval and p of the gap, p of each
    dimension, latency of both sides' outputs, their ratio and p.

    Scores and durations are stored once, narrow; then there is one pass for counts, means and wins, one for
    all p values by name, one for the interval, and those that select both sides' percentiles.
    """
    folder = folder or work_folder(spark)
    judged = stored(judged.select(key, "baseline_scores", "candidate_scores"), f"{folder}/judged")
    b, c = F.col("baseline_scores"), F.col("candidate_scores")
    scored = judged.select(key, verdicts.weighted(b).alias("baseline_weighted"), verdicts.weighted(c).alias("candidate_weighted"))
    diffs = stored(differences(scored, key), f"{folder}/diffs")
    side = lambda rows, name: rows.select(F.lit(name).alias("side"), F.col(duration).cast("double").alias("v"))
    times = stored(side(baseline, "baseline").union(side(candidate, "candidate")), f"{folder}/times")
    # differences have one decimal; so sizes that are equal are counted as such
    named = [diffs.select(F.lit("overall_p_value").alias("name"), F.round("d", 1).alias("d")), dimension_differences(judged).select(F.concat(F.lit("p_"), "dimension"), "d")]
    timed = times.where("v <> 0")
    paired = rank_paired(timed.where("side = 'baseline'"), timed.where("side = 'candidate'"), "v", f"{folder}/ranks")
    named.append(paired.select(F.lit("latency_p_value"), (F.col("b") - F.col("a")).alias("d")))
    p_names = ["overall_p_value", "latency_p_value", *(f"p_{d}" for d in verdicts.WEIGHTS)]
    tests = with_p(wilcoxon(reduce(DataFrame.union, named), by=["name"])).agg(*(F.max(F.when(F.col("name") == n, F.col("p"))).alias(n) for n in p_names))
    gap = resampling.bootstrap_ci(diffs, n_draws).select(F.col("low").alias("gap_low"), F.col("high").alias("gap_high"))
    sides, stats = ("baseline", "candidate"), ("avg", *PERCENTILES)
    of_sides = latency(times, "v", ["side"], folder=f"{folder}/latency")
    latencies = of_sides.agg(*(F.coalesce(F.max(F.when(F.col("side") == s, F.col(k))), F.lit(0.0)).alias(f"{s}_latency_{k}") for s in sides for k in stats))
    row = summary(judged)
    for one in (gap, tests, latencies):
        row = row.crossJoin(F.broadcast(one))  # each is one row
    if not as_reported:
        return row.withColumn("speed_ratio", speed_ratio(F.col("baseline_latency_avg"), F.col("candidate_latency_avg")))
    digits = {"baseline_avg_score": 1, "candidate_avg_score": 1, "win_low": 3, "win_high": 3, "gap_low": 2, "gap_high": 2}
    digits |= {f"{s}_{d}": 2 for s in sides for d in verdicts.WEIGHTS} | {f"{s}_latency_{k}": 1 for s in sides for k in stats}
    reported = verdicts.rounded_all(row, digits)
    ratio = F.try_divide("baseline_latency_avg", "candidate_latency_avg")
    return verdicts.rounded_all(reported.withColumn("speed_ratio", F.coalesce(ratio, F.lit(0.0))), {"speed_ratio": 2})

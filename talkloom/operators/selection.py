"""Order statistics of groups of any size: numbering, ranks, exact percentiles.

No task holds a group.  Numbering sorts into ranges sized by rows, equal values
being told apart by a hash, so that one value can fill many ranges.  Percentiles
don't sort: a sketch gives each of them an interval, the values inside are
counted, and an interval with too many of them is cut by a histogram of its own,
until few enough are left to be looked at; all groups and percentiles go through
these passes together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.work import stored, work_folder

#: Rows of a range; rows may be wide, and a task sorts a range whole.
RANGE = 1 << 15
#: Bits of a row's place within its range, as Spark's own ids have them.
PLACE_BITS = 33
#: Cuts of a sketch and its accuracy; distinct values that one window may hold.
CUTS, ACCURACY, VALUES = 200, 10_000, 100_000


def meet(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join on keys, of which nulls are equal, with the left side's keys."""
    names = {k: f"_right_{i}" for i, k in enumerate(keys)}
    renamed = right.select(*(F.col(c).alias(names.get(c, c)) for c in right.columns))
    on = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()), F.lit(True))
    met = left.join(renamed, on, how)
    return met if how in ("left_semi", "left_anti") else met.drop(*names.values())


def numbered(rows: DataFrame, order: list[str | Column], name: str = "pos", folder: str | None = None, range_rows: int = RANGE) -> DataFrame:
    """Rows with their number from 0 in an order; rows that are equal in it stand in any order.

    Rows go into ranges of about ``range_rows``; a row's number is its place in
    the range and the sizes of the ranges before.  The order ends with a hash of
    the row and its place in the input, which deals equal rows over ranges.
    """
    folder = folder or work_folder(rows.sparkSession)
    n_ranges = max(1, -(-rows.count() // range_rows))
    salt = F.xxhash64(F.monotonically_increasing_id())
    keys = [*(F.col(c) if isinstance(c, str) else c for c in order), F.col("_salt")]
    dealt = rows.withColumn("_salt", salt).repartitionByRange(n_ranges, *keys).sortWithinPartitions(*keys)
    placed = stored(dealt.drop("_salt").withColumn("_id", F.monotonically_increasing_id()), f"{folder}/placed")
    number = F.shiftright("_id", PLACE_BITS)
    sizes = placed.groupBy(number.alias("_range")).agg(F.count("*").alias("_size"))
    before = sizes.select("_range", (F.sum("_size").over(Window.orderBy("_range")) - F.col("_size")).alias("_before"))
    met = placed.withColumn("_range", number).join(F.broadcast(before), "_range")  # as many rows as ranges
    place = F.col("_id").bitwiseAND((1 << PLACE_BITS) - 1)
    return met.select(*rows.columns, (F.col("_before") + place).alias(name))


def ranked(rows: DataFrame, value: str, by: list[str], folder: str | None = None, range_rows: int = RANGE) -> DataFrame:
    """Rows with ``rank``, from 1, by value within each group; equal values get different ranks."""
    placed = numbered(rows, [*by, value], "_pos", folder, range_rows)
    if not by:
        return placed.withColumn("rank", F.col("_pos") + 1).drop("_pos")
    starts = placed.groupBy(*by).agg(F.min("_pos").alias("_start"))
    return meet(placed, starts, by).select(*rows.columns, (F.col("_pos") - F.col("_start") + 1).alias("rank"))


def percentiles(
    rows: DataFrame, value: str, by: list[str], at: dict[str, float], folder: str | None = None, values: int = VALUES
) -> DataFrame:
    """Group columns, n, avg, and each percentile of ``at`` (name to share), interpolated between neighbours; nulls don't count.

    ``values`` bounds the distinct values of a percentile that one window holds.
    """
    folder = folder or work_folder(rows.sparkSession)
    groups, names, n_targets = [*by, "_g"], list(at), len(at)
    base = rows.where(F.col(value).isNotNull()).select(*by, F.lit(0).alias("_g"), F.col(value).cast("double").alias("_v"))
    grid = [k / CUTS for k in range(CUTS + 1)]
    sketch = base.groupBy(*groups).agg(
        F.count("*").alias("n"), F.avg("_v").alias("avg"), F.min("_v").alias("_min"), F.max("_v").alias("_max"),
        F.percentile_approx("_v", grid, ACCURACY).alias("_cuts"),
    )
    # two cuts on either side are further away than the sketch errs; small groups are looked at whole
    small = F.col("n") <= values
    low = [F.when(small | F.lit(int(p * CUTS) < 2), F.col("_min")).otherwise(F.get("_cuts", F.lit(max(0, int(p * CUTS) - 2)))) for p in at.values()]
    high = [F.when(small | F.lit(int(p * CUTS) + 3 > CUTS), F.col("_max")).otherwise(F.get("_cuts", F.lit(min(CUTS, int(p * CUTS) + 3)))) for p in at.values()]
    bounds = stored(sketch.select(*groups, "n", "avg", "_min", "_max", F.array(*low).alias("_low"), F.array(*high).alias("_high")), f"{folder}/bounds0")
    found = targets = None
    for attempt in range(2):
        met = meet(base, bounds, groups).select(*groups, "_v", "_low", "_high")
        below = [F.count_if(F.col("_v") < F.col("_low")[i]) for i in range(n_targets)]
        counted = met.groupBy(*groups).agg(F.array(*below).alias("_below"))
        inside = F.filter(F.sequence(F.lit(0), F.lit(n_targets - 1)), lambda i: F.col("_v").between(F.col("_low")[i], F.col("_high")[i]))
        spread = met.select(*groups, "_v", F.explode(inside).alias("_t"))
        found = stored(spread.groupBy(*groups, "_t", "_v").agg(F.count("*").alias("_c")), f"{folder}/found{attempt}")
        share = F.array(*(F.lit(float(p)) for p in at.values()))
        both = meet(bounds, counted, groups).select(*groups, "n", "_below", F.posexplode(share).alias("_t", "_p"))
        k = (F.col("n") - 1) * F.col("_p")
        targets = both.select(
            *groups, "_t", F.floor(k).alias("_lo"), F.least(F.floor(k) + 1, F.col("n") - 1).alias("_hi"), (k - F.floor(k)).alias("_frac"), F.get("_below", F.col("_t")).alias("_below")
        )
        targets = stored(targets, f"{folder}/targets{attempt}")
        sizes = found.groupBy(*groups, "_t").agg(F.sum("_c").alias("_in"))
        checked = meet(targets, sizes, [*groups, "_t"], "left")
        missed = checked.where((F.col("_lo") < F.col("_below")) | (F.col("_hi") >= F.col("_below") + F.coalesce("_in", F.lit(0))))
        if attempt or missed.isEmpty():
            break
        # a sketch erred by more than it may: whole groups are looked at
        whole = lambda c: F.array(*(F.col(c) for _ in names))
        bounds = stored(bounds.withColumns({"_low": whole("_min"), "_high": whole("_max")}), f"{folder}/bounds1")
    done = narrowed(found, targets, [*groups, "_t"], folder, values)
    wide = done.groupBy(*groups).agg(*(F.max(F.when(F.col("_t") == i, F.col("_x"))).alias(c) for i, c in enumerate(names)))
    return meet(bounds, wide, groups).select(*by, "n", "avg", *names)


def narrowed(found: DataFrame, targets: DataFrame, keys: list[str], folder: str, values: int) -> DataFrame:
    """(keys, _x): each target's interpolated value from the counted values of its interval.

    While an interval has more than ``values`` distinct values, cuts of these
    split it, and the bins that hold the target's two neighbours are kept.
    """
    done, k = [], 0
    while True:
        sizes = found.groupBy(*keys).agg(F.count("*").alias("_d"))
        wide = sizes.where(F.col("_d") > values)
        few = sizes.where(F.col("_d") <= values)
        done.append(picked(meet(found, few, keys, "left_semi"), targets, keys))
        if wide.isEmpty():
            return reduce(DataFrame.unionAll, done)
        many = meet(found, wide, keys, "left_semi")
        # the middle between the ends always splits an interval, however the sketch errs
        middle = F.array(F.min("_v") / 2 + F.max("_v") / 2)
        cuts = many.groupBy(*keys).agg(F.concat(F.percentile_approx("_v", [i / CUTS for i in range(1, CUTS)], ACCURACY), middle).alias("_cuts"))
        placed = meet(many, cuts, keys).select(*keys, "_v", "_c", F.size(F.filter("_cuts", lambda c: c < F.col("_v"))).alias("_bin"))
        placed = stored(placed, f"{folder}/cut{k}")
        bins = placed.groupBy(*keys, "_bin").agg(F.sum("_c").alias("_n"))
        upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_bin"))  # CUTS + 1 rows at most
        bins = bins.select(*keys, "_bin", "_n", (upto - F.col("_n")).alias("_skipped"))
        met = meet(bins, targets, keys).select(*keys, "_bin", "_n", "_skipped", "_lo", "_hi", "_frac", "_below")
        start = F.col("_below") + F.col("_skipped")
        holds = lambda i: (start <= F.col(i)) & (F.col(i) < start + F.col("_n"))
        kept = met.where(holds("_lo") | holds("_hi"))
        targets = stored(kept.groupBy(*keys, "_lo", "_hi", "_frac").agg(F.min(start).alias("_below")), f"{folder}/narrowed{k}")
        found = stored(meet(placed, kept, [*keys, "_bin"], "left_semi").select(*keys, "_v", "_c"), f"{folder}/inside{k}")
        k += 1


def picked(found: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """The two neighbours of each target by running counts, and the value between them."""
    upto = F.sum("_c").over(Window.partitionBy(*keys).orderBy("_v"))
    counted = found.withColumn("_upto", upto)
    met = meet(counted, targets, keys).select(*keys, "_v", "_upto", "_lo", "_hi", "_frac", "_below")
    at = lambda i: F.min(F.when(F.col("_below") + F.col("_upto") > F.col(i), F.col("_v")))
    both = met.groupBy(*keys, "_frac").agg(at("_lo").alias("_a"), at("_hi").alias("_b"))
    return both.select(*keys, (F.col("_a") + F.col("_frac") * (F.col("_b") - F.col("_a"))).alias("_x"))

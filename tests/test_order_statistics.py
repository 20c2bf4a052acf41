"""Resampling, percentiles, ranks and prefixes against plain versions."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkloom.operators import evaluation, resampling, select, selection


def plain_picks(n, size, n_draws, seed):
    """Picks of every block by splitting the whole tree from its root."""
    out = {}

    def split(low, high, node, picks):
        if high - low == 1:
            out[low] = picks
            return
        middle = (low + high) // 2
        rows, left = min(high * size, n) - low * size, (middle - low) * size
        of_left = np.random.Generator(np.random.Philox(key=[seed, node])).binomial(picks, left / rows)
        split(low, middle, 2 * node, of_left)
        split(middle, high, 2 * node + 1, picks - of_left)

    split(0, -(-n // size), 1, np.full(n_draws, n, np.int64))
    return out


def plain_hash(x):
    x ^= x >> 16
    x = x * resampling.MIX_1 & 0xFFFFFFFF
    x ^= x >> 15
    x = x * resampling.MIX_2 & 0xFFFFFFFF
    return x ^ (x >> 16)


def plain_key(seed, block, number):
    return plain_hash(number ^ plain_hash((seed * resampling.GOLDEN + block) & 0xFFFFFFFF))


@pytest.mark.parametrize(("n", "size"), [(1, 8), (8, 8), (61, 8), (200, 16)])
def test_bootstrap_splits_counts_down_the_tree(spark, n, size):
    values = [random.Random(i).gauss(1, 3) for i in range(n)]
    diffs = spark.createDataFrame(list(enumerate(values)), "pos long, d double").repartition(5)
    got = {r["draw"]: r["mean"] for r in resampling.bootstrap_means(diffs, 300, 5, size).collect()}
    picks = plain_picks(n, size, 300, 5)
    assert all(sum(int(p[b]) for p in picks.values()) == n for b in range(300))
    assert len(got) == 300
    for draw in range(300):
        total = 0.0
        for block, k in picks.items():
            rows = values[block * size : (block + 1) * size]
            for j in range(int(k[draw])):
                total += rows[plain_hash((plain_key(5, block, draw) + j * resampling.GOLDEN) & 0xFFFFFFFF) % len(rows)]
        assert got[draw] == pytest.approx(total / n)


def test_bootstrap_means_spread_as_they_should(spark):
    """Mean and standard error over many blocks are those of resampling."""
    values = np.random.default_rng(3).normal(2, 5, 3000)
    diffs = spark.createDataFrame(list(enumerate(values.tolist())), "pos long, d double")
    means = np.array([r["mean"] for r in resampling.bootstrap_means(diffs, 4000, 1, 256).collect()])
    error = values.std() / np.sqrt(len(values))
    assert abs(means.mean() - values.mean()) < 5 * error / np.sqrt(4000)
    assert means.std() == pytest.approx(error, rel=0.05)
    ci = resampling.bootstrap_ci(diffs, 4000, 1, 256).first()
    assert (ci["low"], ci["high"]) == (np.sort(means)[100], np.sort(means)[3899])


def test_permutation_flips_every_draw(spark):
    values = [random.Random(i).randint(-9, 10) for i in range(70)]
    diffs = spark.createDataFrame(list(enumerate(values)), "pos long, d long")
    row = resampling.permutation_p(diffs, 1000, 7, 16).first()
    hits = 0
    for draw in range(1000):
        total = 0
        for pos, d in enumerate(values):
            word = plain_hash((plain_key(7, pos // 16, draw // 32) + pos % 16 * resampling.GOLDEN) & 0xFFFFFFFF)
            total += -d if word >> draw % 32 & 1 else d
        hits += abs(total) >= abs(sum(values))
    assert (row["hits"], row["p"]) == (hits, hits / 1000) and row["observed"] == pytest.approx(abs(sum(values)) / 70)


def test_resampling_of_nothing(spark):
    none = spark.createDataFrame([], "pos long, d double")
    assert tuple(resampling.bootstrap_ci(none, 100).first()) == (None, None)
    assert resampling.permutation_p(none, 100).first()["hits"] == 0


def plain_percentile(values, p):
    values = sorted(values)
    k = (len(values) - 1) * p
    low = int(k)
    return values[low] + (k - low) * (values[min(low + 1, len(values) - 1)] - values[low])


AT = {"a": 0.0, "b": 0.001, "c": 0.5, "d": 0.9, "e": 0.999, "f": 1.0}


@pytest.mark.parametrize("bound", [30, 100_000])
def test_percentiles_are_exact(spark, bound, tmp_path):
    dice = random.Random(4)
    groups = {
        "ties": [7.0] * 2000 + [dice.random() for _ in range(2000)], "wide": [dice.gauss(0, 1) * 10 ** dice.randint(-9, 9) for _ in range(3000)],
        "few": [3.0, 1.0], "one": [5.0], None: [float(i % 17) for i in range(1000)], "same": [2.0] * 500,
    }
    rows = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [("few", None), ("null", None)], "g string, v double").repartition(6)
    got = {r["g"]: r for r in selection.percentiles(rows, "v", ["g"], AT, str(tmp_path / "p"), bound).collect()}
    assert set(got) == set(groups)
    for g, values in groups.items():
        assert got[g]["n"] == len(values) and got[g]["avg"] == pytest.approx(sum(values) / len(values))
        for name, p in AT.items():
            assert got[g][name] == pytest.approx(plain_percentile(values, p), rel=1e-12, abs=1e-12), (g, name)
    every = selection.percentiles(rows, "v", [], {"m": 0.5}, str(tmp_path / "q"), bound).first()
    assert every["m"] == pytest.approx(plain_percentile([v for vs in groups.values() for v in vs], 0.5))
    assert selection.percentiles(rows.limit(0), "v", ["g"], AT, str(tmp_path / "r")).count() == 0


def test_a_sketch_that_errs_is_made_good(spark, tmp_path, monkeypatch):
    """Intervals that don't hold their targets are widened to whole groups."""
    monkeypatch.setattr(selection, "ACCURACY", 1)
    rows = spark.range(20_000).select((F.col("id") * 37 % 20_000).cast("double").alias("v"))
    got = selection.percentiles(rows, "v", [], AT, str(tmp_path / "p"), 100).first()
    assert [got[k] for k in AT] == pytest.approx([p * 19_999 for p in AT.values()])


def test_latency_keeps_groups_without_durations(spark):
    rows = spark.createDataFrame([("x", 0.0), ("y", 2.0), ("y", 4.0), (None, 1.0)], "g string, d double")
    got = {r["g"]: tuple(r)[1:] for r in evaluation.latency(rows, "d", ["g"]).collect()}
    assert got == {"x": (0.0, 0.0, 0.0, 0.0), "y": (3.0, 3.0, pytest.approx(3.8), pytest.approx(3.98)), None: (1.0, 1.0, 1.0, 1.0)}


def test_ranks_split_equal_values(spark, tmp_path):
    rows = spark.createDataFrame([(i % 3 if i % 7 else None, 5.0 if i % 2 else float(i)) for i in range(4000)], "g int, v double").repartition(3)
    placed = selection.ranked(rows, "v", ["g"], str(tmp_path / "r"), range_rows=100)
    by = {}
    for r in placed.collect():
        by.setdefault(r["g"], []).append((r["rank"], r["v"]))
    assert set(by) == {0, 1, 2, None}
    for found in by.values():
        found.sort()
        assert [k for k, _ in found] == list(range(1, len(found) + 1))
        assert [v for _, v in found] == sorted(v for _, v in found)
    sizes = spark.read.parquet(str(tmp_path / "r" / "placed")).groupBy(F.shiftright("_id", 33)).count().collect()
    assert len(sizes) == 40 and max(r["count"] for r in sizes) < 300  # half of all values are equal
    whole = [r["rank"] for r in selection.ranked(rows, "v", []).collect()]
    assert sorted(whole) == list(range(1, 4001))
    assert selection.ranked(rows.limit(0), "v", ["g"]).count() == 0


def test_prefixes_keep_each_row_once(spark):
    ids = ["a", "ab", "abc", "abc", "b", "", None, "éa", "x" * 50]
    rows = spark.createDataFrame([(i, k) for k, i in enumerate(ids)], "request_id string, k int")
    for given in (["ab"], ["a", "ab", "abc"], ["é", "b"], [""], ["zz"], ["x" * 49, "x" * 60], [None, "b"]):
        want = [k for k, i in enumerate(ids) if i is not None and any(p is not None and i.startswith(p) for p in given)]
        table = spark.createDataFrame([(p,) for p in given] * 2, "p string")
        for prefixes in (given, table):
            got = select.by_prefixes(rows, prefixes)
            assert got.columns == rows.columns and sorted(r["k"] for r in got.collect()) == want, given
    assert select.by_prefixes(rows, []).count() == len(ids)
    assert select.by_prefixes(rows, spark.createDataFrame([], "p string")).count() == 0
    many = rows.sparkSession.range(5000).select(F.md5(F.col("id").cast("string")).alias("p"))
    plan = select.by_prefixes(rows, many)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_draws_of_many_blocks_are_one_stream(spark, monkeypatch):
    """Without a size of blocks, signs and picks follow from positions, as the SQL has them."""
    monkeypatch.setattr(resampling, "BLOCK", 16)
    monkeypatch.setattr(resampling, "HELD", 30)
    values = [random.Random(i).randint(-9, 10) for i in range(70)]
    diffs = spark.createDataFrame(list(enumerate(values)), "pos long, d long").repartition(3)
    word = lambda number, pos: plain_hash((plain_key(7, 0, number) + pos * resampling.GOLDEN) & 0xFFFFFFFF)
    sums = [sum(-d if word(k // 32, p) >> k % 32 & 1 else d for p, d in enumerate(values)) for k in range(200)]
    assert resampling.permutation_p(diffs, 200, 7).first()["hits"] == sum(abs(s) >= abs(sum(values)) for s in sums)
    got = {r["draw"]: r["mean"] for r in resampling.bootstrap_means(diffs, 50, 7).collect()}
    assert got == pytest.approx({k: sum(values[word(k, p) % 70] for p in range(70)) / 70 for k in range(50)})

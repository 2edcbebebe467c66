import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fellwalk.functions.numbers import general_format, ieee_ratio
from fellwalk.operators import stats


def numbers(spark, values, partitions=3):
    return spark.createDataFrame([(float(v),) for v in values], "x double").repartition(partitions)


def test_histogram_of_the_known_example(spark):
    rows = stats.equal_width_histogram(numbers(spark, range(8)), "x", 3).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [3, 2, 3]
    assert rows[0]["lo"] == 0.0 and rows[-1]["hi"] == 7.0


def test_histogram_edge_cases(spark):
    assert stats.equal_width_histogram(numbers(spark, []), "x", 3).count() == 0
    assert stats.equal_width_histogram(numbers(spark, [5, 5]), "x", 3).collect() == [(0, 5.0, 5.0, 2)]
    gap = stats.equal_width_histogram(numbers(spark, [0, 9, 10]), "x", 5)
    assert sorted(r["bin"] for r in gap.collect()) == [0, 4]
    dense = stats.equal_width_histogram(numbers(spark, [0, 9, 10]), "x", 5, dense=True)
    assert [r["n"] for r in dense.orderBy("bin").collect()] == [1, 0, 0, 0, 2]
    edges = stats.histogram_edges(gap, ascending=False).collect()
    assert [(r["lo"], r["next_lo"]) for r in edges] == [(8.0, 10.0), (0.0, 8.0)]


def test_histogram_counts_every_value_for_any_partitioning(spark):
    values = [random.Random(7).gauss(0, 1) for _ in range(500)]
    results = []
    for partitions in (1, 8):
        found = stats.equal_width_histogram(numbers(spark, values, partitions), "x", 9).orderBy("bin").collect()
        assert sum(r["n"] for r in found) == 500
        results.append(found)
    assert results[0] == results[1]


POINTS = [0.0, 0.1, 0.5, 0.95, 0.99, 1.0]


@pytest.mark.parametrize("kind", ["normal", "hot", "outlier", "two", "equal", "not numbers"])
def test_narrowed_quantiles_are_exact(spark, kind):
    rng = np.random.default_rng(3)
    values = {
        "normal": rng.normal(size=4000),
        "hot": np.concatenate([np.full(2000, 4.5), rng.normal(4, 3, 2000)]),
        "outlier": np.concatenate([rng.normal(size=3000), [1e300, -1e300]]),
        "two": np.array([1.0, 2.0]),
        "equal": np.full(900, 7.25),
        "not numbers": np.concatenate([rng.normal(size=500), np.full(60, math.nan)]),
    }[kind]
    df = numbers(spark, values)
    expected = np.quantile(values[~np.isnan(values)], POINTS)
    for limit in (1 << 16, 40):
        found = stats.exact_quantiles(df, "x", POINTS, digits=limit).collect()
        got = {r["probability"]: r["quantile"] for r in found}
        assert [got[p] for p in POINTS] == pytest.approx(list(expected), rel=1e-12)


@pytest.mark.parametrize("limit", [10**6, 5])
def test_infinities_are_values_and_giant_groups_narrow(spark, limit):
    ends = numbers(spark, [-math.inf, 1.0, 2.0, math.inf, math.inf])
    assert [r["quantile"] for r in stats.exact_quantiles(ends, "x", [0.0, 0.5, 1.0], digits=limit).orderBy("probability").collect()] == [-math.inf, 2.0, math.inf]
    group = F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(-1)
    df = spark.range(4000).select(group.alias("g"), (F.col("id") * 0.5).alias("x"))
    found = {r["g"]: r["quantile"] for r in stats.exact_quantiles(df, "x", [0.25], ["g"], limit).collect()}
    assert found[-1] == np.quantile([i * 0.5 for i in range(4000) if i % 10], 0.25) and found[20] == 10.0 and len(found) == 401
    assert stats.exact_quantiles(df.filter("x < 0"), "x", [0.5], ["g"], limit).collect() == []


def test_quantiles_per_group(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), (F.col("id") * 1.0).alias("x"))
    for limit in (10**6, 50):
        found = {r["g"]: r["quantile"] for r in stats.exact_quantiles(df, "x", [0.5], ["g"], limit).collect()}
        assert found == {g: float(np.median(np.arange(g, 3000, 3))) for g in range(3)}


@pytest.mark.parametrize("limit", [10**6, 50])
def test_a_missing_group_is_a_group(spark, limit):
    group = F.when(F.col("id") % 2 == 0, F.lit("even"))
    df = spark.range(2000).select(group.alias("g"), (F.col("id") * 1.0).alias("x"))
    found = {r["g"]: r["quantile"] for r in stats.exact_quantiles(df, "x", [0.5], ["g"], limit).collect()}
    assert found == {"even": 999.0, None: 1000.0}
    summary = {r["g"]: r["max"] for r in stats.numeric_summary(df, "x", ["g"]).collect()}
    assert summary == {"even": 1998.0, None: 1999.0}


def test_summary_skips_what_is_not_finite(spark):
    row = stats.numeric_summary(numbers(spark, [1, 2, 3, math.nan, math.inf, -math.inf]), "x").first()
    assert (row["min"], row["p50"], row["max"], row["max_abs_pct"]) == (1.0, 2.0, 3.0, 200.0)


def test_finite_average(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (0.0, 0.0), (-1.0, 0.0), (None, 0.0)], "a double, b double")
    ratio = ieee_ratio(F.col("a"), F.col("b"))
    found = df.select(ratio.alias("r")).collect()
    assert found[0][0] == 0.5 and found[1][0] == math.inf and math.isnan(found[2][0]) and found[3][0] == -math.inf
    assert found[4][0] is None
    assert stats.finite_average(df, ratio).first() == (5, 1, 0.5)
    assert stats.finite_average(df.filter("b = 0"), ratio).first()["finite_avg"] is None


def test_general_format_follows_printf(spark):
    rng = random.Random(1)
    values = [0.0, 1.0, 0.999394, 1.00174, 123456.7, 1234567.0, 1e-5, 0.0001, -2.5, 9.999999e5, 999999.7, 1e20]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-8, 9) for _ in range(60)]
    df = numbers(spark, values, 1)
    found = df.select("x", general_format(F.col("x")).alias("a"), general_format(F.col("x"), 3, sign=True).alias("b")).collect()
    for r in found:
        assert r["a"] == f"{r['x']:.6g}"
        assert r["b"] == f"{r['x']:+.3g}"


def test_summary_text(spark):
    row = stats.summary_text(stats.numeric_summary(numbers(spark, [0.999394, 1.00174]), "x")).first()
    assert (row["min"], row["max"]) == ("0.999394(-0.0606%)", "1.00174(+0.174%)")
    zero = stats.summary_text(stats.numeric_summary(numbers(spark, [0.0]), "x"), baseline=0.0).first()
    assert zero["max"] == "0(+0%)"


def test_four_passes_settle_any_doubles(spark, monkeypatch):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(size=3000) * 10.0 ** rng.integers(-320, 300, 3000), 1 + np.arange(3000) * 2.0**-52, [0.0, -0.0, 5e-324, -5e-324]])
    passes, counted = [], stats._digit_counts
    monkeypatch.setattr(stats, "_digit_counts", lambda *a: passes.append(1) or counted(*a))
    found = {r["probability"]: r["quantile"] for r in stats.exact_quantiles(numbers(spark, values), "x", POINTS).collect()}
    assert [found[p] for p in POINTS] == pytest.approx(list(np.quantile(values, POINTS)), rel=1e-15)
    assert len(passes) <= 4

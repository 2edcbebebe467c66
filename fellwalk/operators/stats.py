"""Statistics jobs: exact quantiles, summaries, equal-width histograms, finite means."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fellwalk.functions.numbers import INFINITY, finite, general_format
from fellwalk.operators.joins import same_group_join
from fellwalk.workspace import settled

# values of a digit: a pass tells so many parts of each range apart, so four passes settle any double
DIGITS = 1 << 16


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    digits: int = DIGITS,
) -> DataFrame:
    """Exact quantiles with linear interpolation; columns ``by``, ``probability``, ``quantile``.

    NULL and NaN are left out; infinities are values.  Radix selection: every pass counts the values by
    their next digit, for all wanted ranks at once, and keeps of each rank the one digit that holds
    it.  The first digit is the sign and the logarithm, the later ones are equal parts of the range
    that the values with the digits so far span; digits keep the order of the values, so counts
    decide.  A rank is settled when all values left to it are equal.  A pass moves at most ``digits``
    rows a task and range, whatever the values and however many of them are equal, and passes after
    the first see only the values in ranges still open.
    """
    by = list(by)
    number = F.col(value).cast("double")
    # adding zero makes the two zeros one value
    rows = settled(df.select(*by, (number + 0.0).alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v")), "values")
    position = F.col("probability") * (F.col("n") - 1)
    wanted = F.array(*[F.struct(F.lit(float(p)).alias("probability"), F.lit(side).alias("side")) for p in probabilities for side in (0, 1)])
    counts = _running(_digit_counts(rows.withColumn("_from", F.lit(0.0)), by, _magnitude(digits)), by)
    counts = counts.withColumn("n", F.sum("c").over(Window.partitionBy(*by, "_from"))).select("*", F.inline(wanted))
    ranked = counts.withColumn("rank", F.least(F.floor(position) + F.col("side"), F.col("n") - 1)).withColumn("part", position - F.floor(position))
    found = []
    while True:
        found.append(settled(_held(ranked, by), "targets"))
        open_ranks = found[-1].filter("lo < hi")
        if open_ranks.isEmpty():
            return _between(functools.reduce(DataFrame.unionByName, [f.filter("lo = hi") for f in found]), by)
        inside = _in_ranges(rows, open_ranks.groupBy(*by).agg(F.collect_set(F.struct("lo", "hi")).alias("_ranges")), by)
        share = (F.col("_v") - F.col("r.lo")) / (F.col("r.hi") - F.col("r.lo"))
        counts = _running(_digit_counts(inside.withColumn("_from", F.col("r.lo")), by, F.floor(share * digits).cast("bigint")), by)
        wanted_ranks = open_ranks.select(*by, "probability", "side", "part", "rank", F.col("lo").alias("_from"))
        ranked = same_group_join(wanted_ranks, counts, [*by, "_from"])


def _magnitude(digits: int) -> Column:
    """The first digit: sign and logarithm.  Logarithms are semi-monotonic, so the digit never falls as values rise."""
    v, half = F.col("_v"), digits // 2
    # natural logarithms of doubles lie between -745 and 710
    size = F.floor((F.ln(F.abs(v)) + 746) / 1456 * half).cast("bigint") + 1
    finite_digit = F.when(v == 0, 0).when(v > 0, size).otherwise(-size)
    return F.when(v == INFINITY, half + 2).when(v == -INFINITY, -half - 2).otherwise(finite_digit)


def _digit_counts(rows: DataFrame, by: list[str], digit: Column) -> DataFrame:
    """``by``, ``_from`` (where the range starts), ``digit``, with the count and the span of its values."""
    ends = [F.min("_v").alias("lo"), F.max("_v").alias("hi")]
    return rows.groupBy(*by, "_from", digit.alias("digit")).agg(F.count(F.lit(1)).alias("c"), *ends)


def _running(counts: DataFrame, by: list[str]) -> DataFrame:
    """The counts with the values of the range before each digit: ``_start``, and with it: ``_upto``."""
    running = Window.partitionBy(*by, "_from").orderBy("digit")
    return counts.withColumn("_upto", F.sum("c").over(running)).withColumn("_start", F.col("_upto") - F.col("c"))


def _held(ranked: DataFrame, by: list[str]) -> DataFrame:
    """Each rank with the digit that holds it: what is left of the rank in it, and the span of its values."""
    here = (F.col("_start") <= F.col("rank")) & (F.col("rank") < F.col("_upto"))
    return ranked.filter(here).select(*by, "probability", "side", "part", (F.col("rank") - F.col("_start")).alias("rank"), "lo", "hi")


def _in_ranges(rows: DataFrame, ranges: DataFrame, by: list[str]) -> DataFrame:
    """The values in a range of their group that is still open, with that range as ``r``.

    Without groups the ranges are one scalar, two for each probability at most.  With groups there is one row of
    ranges for each group, and the planner decides on the join by the size of the written targets.
    """
    ranged = same_group_join(rows, ranges, by) if by else rows.withColumn("_ranges", ranges.scalar())
    holding = F.filter("_ranges", lambda r: F.col("_v").between(r["lo"], r["hi"]))
    return ranged.select(*by, "_v", F.explode(holding).alias("r"))


def _between(targets: DataFrame, by: list[str]) -> DataFrame:
    """The quantile between the values at the wanted rank and the next."""
    picked = targets.groupBy(*by, "probability", "part").agg(F.min("lo").alias("at"), F.max("lo").alias("next"))
    between = (1 - F.col("part")) * F.col("at") + F.col("part") * F.col("next")
    quantile = F.when((F.col("part") == 0) | (F.col("at") == F.col("next")), F.col("at")).otherwise(between)
    return picked.select(*by, "probability", quantile.alias("quantile"))


def quantile_columns(
    df: DataFrame, value: str, named: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """:func:`exact_quantiles` with one column per name instead of one row per probability."""
    by = list(by)
    found = exact_quantiles(df, value, sorted(set(named.values())), by)
    picks = [F.max(F.when(F.col("probability") == F.lit(p), F.col("quantile"))).alias(n) for n, p in named.items()]
    return found.groupBy(*by).agg(*picks)


SUMMARY_POINTS = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def numeric_summary(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Min, median, p95, p99, max and the largest deviation from 1 in percent, finite values only."""
    by = list(by)
    rows = df.select(*by, finite(F.col(value).cast("double")).alias("value")).filter(F.col("value").isNotNull())
    ends = rows.groupBy(*by).agg(
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        (F.max(F.abs(F.col("value") - 1.0)) * 100.0).alias("max_abs_pct"),
    )
    points = quantile_columns(rows, "value", SUMMARY_POINTS, by)
    if by:
        joined = same_group_join(ends, points, by)
    else:
        # both sides are single rows
        joined = ends.select("*", *[points.select(name).scalar().alias(name) for name in SUMMARY_POINTS])
    return joined.select(*by, "min", *SUMMARY_POINTS, "max", "max_abs_pct")


def summary_text(summary: DataFrame, baseline: Column | float = 1.0, labels: Sequence[str] = ()) -> DataFrame:
    """The summary with each value as text: the value and its offset from the baseline in percent."""
    base = baseline if isinstance(baseline, Column) else F.lit(float(baseline))

    def cell(name: str) -> Column:
        value = F.col(name)
        percent = F.when(base == 1.0, (value - 1.0) * 100.0).otherwise(value * 100.0)
        text = F.concat(general_format(value, 6), F.lit("("), general_format(percent, 3, sign=True), F.lit("%)"))
        return F.when(finite(value).isNull(), F.lit("nan")).otherwise(text)

    return summary.select(*labels, *[cell(n).alias(n) for n in ["min", *SUMMARY_POINTS, "max"]])


def finite_average(df: DataFrame, value: Column, by: Sequence[str] = ()) -> DataFrame:
    """Count of rows, count of finite values and their mean per group; NULL when none is finite."""
    kept = finite(value)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.count(kept).alias("n_finite"), F.avg(kept).alias("finite_avg")
    )


def equal_width_histogram(df: DataFrame, value: str, bins: int, dense: bool = False) -> DataFrame:
    """Counts in ``bins`` equal-width bins between the smallest and the largest value.

    The largest value belongs to the last bin; equal values share one bin.  Empty bins are
    missing unless ``dense``.  Columns ``bin``, ``lo``, ``hi``, ``n``.
    """
    items = df.select(F.col(value).cast("double").alias("x")).filter(F.col("x").isNotNull())
    limits = items.agg(F.struct(F.min("x").alias("min"), F.max("x").alias("max")).alias("r"))
    ranged = items.withColumn("r", limits.scalar())
    width = (F.col("r.max") - F.col("r.min")) / F.lit(float(bins))
    index = F.when(
        F.col("r.max") > F.col("r.min"),
        F.least(F.floor((F.col("x") - F.col("r.min")) / width).cast("int"), F.lit(bins - 1)),
    ).otherwise(F.lit(0))
    counted = ranged.groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    if dense:
        every = limits.filter(F.col("r.min").isNotNull()).select(
            F.explode(F.when(F.col("r.max") > F.col("r.min"), F.sequence(F.lit(0), F.lit(bins - 1))).otherwise(F.array(F.lit(0)))).alias("bin")
        )
        counted = every.join(counted, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))
    placed = counted.withColumn("r", limits.scalar())
    flat = F.col("r.max") == F.col("r.min")
    return placed.select(
        "bin",
        (F.col("r.min") + F.col("bin") * width).alias("lo"),
        F.when(flat | (F.col("bin") == bins - 1), F.col("r.max")).otherwise(F.col("r.min") + (F.col("bin") + 1) * width).alias("hi"),
        "n",
    )


def histogram_edges(histogram: DataFrame, ascending: bool = True) -> DataFrame:
    """Display rows: each non-empty bin up to the start of the next one, the last up to the maximum.

    The window runs over the bins, never over the items.
    """
    by_start = Window.orderBy("lo")
    rows = histogram.select(
        "lo", F.coalesce(F.lead("lo").over(by_start), F.max("hi").over(Window.partitionBy())).alias("next_lo"), "n"
    )
    return rows.orderBy(F.col("lo").asc() if ascending else F.col("lo").desc())

"""Jobs over single cells: statistics, peak, classes, colours, local algebra."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fellwalk.operators.layers import TILE_SIZE
from fellwalk.operators.stats import exact_quantiles
from fellwalk.workspace import settled


def cell_statistics(cells: DataFrame, value: str = "z") -> DataFrame:
    """Data cells, mean, median, mode, population standard deviation, smallest and largest value: one row.

    The mode comes from a distributed count (smallest value on ties) and the median from
    the exact quantile job, because both aggregates would otherwise hold all distinct values.
    """
    x = F.col(value)
    # three jobs read the values, which may be dear to derive
    cells = settled(cells.select(value), "cells")
    simple = cells.agg(
        F.count(x).alias("data_cells"),
        F.avg(x).alias("mean"),
        F.stddev_pop(x).alias("stddev"),
        F.min(x).alias("zmin"),
        F.max(x).alias("zmax"),
    )
    counts = cells.filter(x.isNotNull()).groupBy(x.alias("v")).agg(F.count(F.lit(1)).alias("n"))
    mode = counts.agg(F.max_by("v", F.struct(F.col("n"), -F.col("v"))))
    median = exact_quantiles(cells, value, [0.5]).select("quantile")
    return simple.select(
        "data_cells", "mean", median.scalar().alias("median"), mode.scalar().alias("mode"), "stddev", "zmin", "zmax"
    )


def peak_cell(cells: DataFrame) -> DataFrame:
    """The highest cell; of equal ones the first by row, then column."""
    best = F.max_by(F.struct("col", "row", "z"), F.struct(F.col("z"), -F.col("row"), -F.col("col")))
    return cells.filter(F.col("z").isNotNull()).agg(best.alias("p")).filter(F.col("p").isNotNull()).select("p.*")


SLOPE_BREAKS = (5, 15, 30)


def break_class(value: Column, breaks: Sequence[float] = SLOPE_BREAKS, truncate: bool = True) -> Column:
    """Number of the class a value falls in: class 0 up to the first break, and so on.

    With ``truncate`` the value is cut to whole numbers first, so class 0 of 5, 15, 30 is all
    below 6; otherwise a class ends just below its break.  NULL stays NULL.
    """
    result = None
    for i, at in enumerate(breaks):
        below = F.floor(value) <= at if truncate else value < at
        result = F.when(below, i) if result is None else result.when(below, i)
    return F.when(value.isNotNull(), result.otherwise(len(breaks)))


def class_label(index: Column, breaks: Sequence[float] = SLOPE_BREAKS) -> Column:
    """``0-5``, ``5-15``, ``15-30``, ``30-Inf``."""
    edges = ["0", *[str(b) for b in breaks], "Inf"]
    labels = [f"{a}-{b}" for a, b in zip(edges, edges[1:])]
    return F.get(F.array(*[F.lit(label) for label in labels]), index)


def tile_class_histogram(
    cells: DataFrame, value: str, breaks: Sequence[float] = SLOPE_BREAKS, truncate: bool = True, tile_size: int = TILE_SIZE
) -> DataFrame:
    """Cells per class in each tile; cells without data are left out.

    Cells that carry ``tile_col`` and ``tile_row`` keep their tile, others are cut by ``tile_size``.
    """
    cut = lambda axis: F.floor(F.col(axis) / tile_size).cast("int")
    tile = lambda axis: F.col(f"tile_{axis}") if f"tile_{axis}" in cells.columns else cut(axis)
    classed = cells.filter(F.col(value).isNotNull()).select(
        tile("col").alias("tile_col"), tile("row").alias("tile_row"), break_class(F.col(value), breaks, truncate).alias("class")
    )
    return classed.groupBy("tile_col", "tile_row", "class").agg(F.count(F.lit(1)).alias("n"))


def class_histogram(tile_histogram: DataFrame, breaks: Sequence[float] = SLOPE_BREAKS) -> DataFrame:
    """The tile histograms merged into one."""
    merged = tile_histogram.groupBy("class").agg(F.sum("n").alias("n"))
    return merged.select("class", class_label(F.col("class"), breaks).alias("label"), "n").orderBy("class")


def class_levels(tile_histogram: DataFrame) -> DataFrame:
    """Share of each class in its tile next to its share in the whole layer."""
    per_tile = tile_histogram.groupBy("tile_col", "tile_row").agg(F.sum("n").alias("tile_n"))
    overall = tile_histogram.groupBy("class").agg(F.sum("n").alias("class_n"))
    everything = tile_histogram.agg(F.sum("n")).scalar()
    joined = tile_histogram.join(per_tile, ["tile_col", "tile_row"]).join(F.broadcast(overall), "class")
    return joined.select(
        "tile_col", "tile_row", "class", "n",
        (F.col("n") / F.col("tile_n")).alias("tile_share"),
        (F.col("class_n") / everything).alias("layer_share"),
    )


def quantile_classes(cells: DataFrame, classes: int, value: str = "z") -> DataFrame:
    """Class of each cell between equally filled quantile breaks; no data has no class (transparent).

    A value equal to a break belongs to the class below it.
    """
    fractions = [i / classes for i in range(1, classes)]
    breaks = exact_quantiles(cells, value, fractions).agg(F.sort_array(F.collect_list("quantile")).alias("b"))
    ranked = cells.withColumn("b", breaks.scalar())
    index = sum(
        (F.when(F.col(value) > F.get("b", F.lit(i)), 1).otherwise(0) for i in range(classes - 1)), F.lit(0)
    )
    return ranked.select("col", "row", value, F.when(F.col(value).isNotNull(), index).alias("class"))


# Colour ramp for slopes, (degrees, red, green, blue).
SLOPE_RAMP = (
    (0.0, 68, 1, 84),
    (5.0, 71, 44, 122),
    (10.0, 59, 81, 139),
    (20.0, 44, 113, 142),
    (30.0, 33, 145, 140),
    (40.0, 39, 173, 129),
    (50.0, 92, 200, 99),
    (60.0, 170, 220, 50),
    (70.0, 253, 231, 36),
)


def ramp_color(value: Column, ramp: Sequence[tuple[float, int, int, int]] = SLOPE_RAMP) -> list[Column]:
    """Red, green and blue of a value, mixed linearly between the stops around it, clamped at the ends."""
    stops = sorted(ramp)
    channels = []
    for channel, name in enumerate("rgb", 1):
        color = F.when(value <= stops[0][0], F.lit(stops[0][channel]))
        for low, high in zip(stops, stops[1:]):
            part = (value - low[0]) / F.lit(float(high[0] - low[0]))
            color = color.when(value <= high[0], F.floor(low[channel] + part * (high[channel] - low[channel]) + 0.5).cast("int"))
        channels.append(F.when(value.isNotNull(), color.otherwise(F.lit(stops[-1][channel]))).alias(name))
    return channels


def color_relief(cells: DataFrame, value: str, ramp: Sequence[tuple[float, int, int, int]] = SLOPE_RAMP) -> DataFrame:
    """Colour of each cell by a ramp; no data has no colour."""
    return cells.select("col", "row", *ramp_color(F.col(value), ramp))


def drop_negative(cells: DataFrame) -> DataFrame:
    """Negative cells become no data."""
    return cells.withColumn("z", F.when(F.col("z") >= 0, F.col("z")))


def normalised(cells: DataFrame) -> DataFrame:
    """Values scaled to 0..1 between the smallest and the largest; NULL if they are equal."""
    limits = cells.agg(F.struct(F.min("z").alias("lo"), F.max("z").alias("hi")).alias("b"))
    spread = F.col("b.hi") - F.col("b.lo")
    return cells.withColumn("b", limits.scalar()).withColumn("z", F.try_divide(F.col("z") - F.col("b.lo"), spread)).drop("b")


def scaled(cells: DataFrame, factor: float = 2.0) -> DataFrame:
    """Every value times a factor."""
    return cells.withColumn("z", F.col("z") * factor)

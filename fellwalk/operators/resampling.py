"""Smaller copies of a raster."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, functions as F

from fellwalk.operators.layers import Shape, shape_of

MAX_SIDE = 1200


def fitted_shape(shape: Shape, max_cols: int = MAX_SIDE, max_rows: int = MAX_SIDE) -> Shape:
    """The largest shape of the same proportions within the limits, never larger than the input."""
    scale = min(max_cols / shape.cols, max_rows / shape.rows, 1.0)
    side = lambda n: int(n * scale + 0.5)
    return Shape(0, 0, side(shape.cols), side(shape.rows))


def _shares(axis: Column, source: int, target: int) -> Column:
    """Target positions along one axis that a source position counts for, with their weights.

    Target ``t`` looks at source position ``(t + 0.5) * source / target - 0.5`` and mixes the
    two positions around it; a source position therefore serves few targets, found near its
    own scaled position.
    """
    step = source / target
    near = F.floor((axis + 0.5) / step).cast("int")
    looks_at = lambda t: (t + 0.5) * step - 0.5
    candidates = F.sequence(F.greatest(near - 1, F.lit(0)), F.least(near + 1, F.lit(target - 1)))
    weighted = F.transform(candidates, lambda t: F.struct(t.alias("at"), (1.0 - F.abs(looks_at(t) - axis)).alias("w")))
    return F.filter(weighted, lambda s: s["w"] > 0)


def downsample(cells: DataFrame, max_cols: int = MAX_SIDE, max_rows: int = MAX_SIDE, shape: Shape | None = None) -> DataFrame:
    """Bilinear copy that fits the limits; a raster that already fits is returned as it is.

    Every source cell sends its weighted value to the few target cells that look at it, and the
    targets are summed: one scan with partial sums, no join of the full raster.  Cells without
    data are left out of the mean.
    """
    shape = shape or shape_of(cells)
    small = fitted_shape(shape, max_cols, max_rows)
    if (small.cols, small.rows) == (shape.cols, shape.rows):
        return cells.select("col", "row", "z")
    col, row = F.col("col") - shape.col0, F.col("row") - shape.row0
    sent = cells.select("z", _shares(row, shape.rows, small.rows).alias("rs"), _shares(col, shape.cols, small.cols).alias("cs"))
    sent = sent.select("z", "cs", F.explode("rs").alias("r")).select("z", "r", F.explode("cs").alias("c"))
    weight = F.col("r.w") * F.col("c.w")
    counted = F.when(F.col("z").isNotNull(), weight)
    return sent.groupBy(F.col("c.at").alias("col"), F.col("r.at").alias("row")).agg(
        F.try_divide(F.sum(F.col("z") * weight), F.sum(counted)).alias("z")
    )


def halved(cells: DataFrame) -> DataFrame:
    """The next pyramid level: the mean of each 2x2 block."""
    half = lambda axis: F.floor(F.col(axis) / 2).cast("int").alias(axis)
    return cells.groupBy(half("col"), half("row")).agg(F.avg("z").alias("z"))


def pyramid(cells: DataFrame, levels: int) -> DataFrame:
    """Levels 0 to ``levels`` stacked, with column ``level``; each level has a quarter of the cells before it.

    The mean of means equals the mean only where all cells have data, so sums and counts are
    carried from level to level.
    """
    half = lambda axis: F.floor(F.col(axis) / 2).cast("int").alias(axis)
    level = cells.select("col", "row", F.col("z").alias("total"), F.when(F.col("z").isNotNull(), 1).otherwise(0).cast("bigint").alias("n"))
    stack = [level.withColumn("level", F.lit(0))]
    for number in range(1, levels + 1):
        level = level.groupBy(half("col"), half("row")).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        stack.append(level.withColumn("level", F.lit(number)))
    stacked = functools.reduce(DataFrame.unionByName, stack)
    return stacked.select("level", "col", "row", F.try_divide(F.col("total"), F.col("n")).alias("z"))

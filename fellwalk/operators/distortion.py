"""Distortion of map projections over sampled regions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from fellwalk.functions.projections import FACTORS, Projection, distortion_factors, with_scales
from fellwalk.operators.stats import numeric_summary
from fellwalk.workspace import settled

# factors whose largest deviation from 1 is reported
SCALES = ("k_mer", "k_par", "k_dist", "k_areal")


def point_scales(points: DataFrame, projections: Mapping[str, Projection]) -> DataFrame:
    """The scales ``h`` and ``k`` of each projection at each point (``lon``, ``lat``), one row per projection."""
    columns = points.columns
    scaled = points
    for i, projection in enumerate(projections.values()):
        scaled = with_scales(scaled, projection, f"_h{i}", f"_k{i}")
    pairs = [F.struct(F.lit(name).alias("projection"), F.col(f"_h{i}").alias("h"), F.col(f"_k{i}").alias("k")) for i, name in enumerate(projections)]
    return scaled.select(*columns, F.explode(F.array(*pairs)).alias("_p")).select(*columns, "_p.*")


def distortion(points: DataFrame, projections: Mapping[str, Projection]) -> DataFrame:
    """Distortion factors of each projection at each point (``lon``, ``lat``), one row per projection."""
    factors = distortion_factors(F.col("h"), F.col("k"))
    return point_scales(points, projections).select(*points.columns, "projection", *[c.alias(n) for n, c in factors.items()])


def distortion_summary(points: DataFrame, projections: Mapping[str, Projection]) -> DataFrame:
    """Min, median, p95, p99, max and, for scales, the largest deviation of every factor of every projection."""
    # written once: the points are made by several steps, and the summary reads them more than once
    factors = settled(distortion(points.select("lon", "lat"), projections).drop("lon", "lat"), "factors")
    each = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in FACTORS])
    stacked = factors.select("projection", F.explode(each).alias("m")).select("projection", "m.*")
    summary = numeric_summary(stacked, "value", ["projection", "metric"])
    return summary.withColumn("max_abs_pct", F.when(F.col("metric").isin(*SCALES), F.col("max_abs_pct")))

"""Jobs over two aligned rasters: the values of one per zone of the other.

Counts are combined before the shuffle, so a zone that holds a third of all cells costs one row
per task and value.  Where zone results go back to the cells, the lookup is salted for the zones
that hold many of them, and for no others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fellwalk.operators.joins import balanced_lookup
from fellwalk.workspace import settled


def aligned(values: DataFrame, zones: DataFrame) -> DataFrame:
    """``col row value zone`` of the cells that have both; inputs have ``value`` and ``zone``."""
    left = values.select("col", "row", "value").filter(F.col("value").isNotNull())
    right = zones.select("col", "row", "zone").filter(F.col("zone").isNotNull())
    return left.join(right, ["col", "row"])


def zonal_histogram(values: DataFrame, zones: DataFrame) -> DataFrame:
    """Number of cells of each value in each zone."""
    return aligned(values, zones).groupBy("zone", "value").agg(F.count(F.lit(1)).alias("n"))


def zone_shares(histogram: DataFrame) -> DataFrame:
    """The histogram with the zone's total and each value's percentage of it."""
    totals = histogram.groupBy("zone").agg(F.sum("n").alias("zone_n"))
    return histogram.join(totals, "zone").withColumn("percentage", F.col("n") * 100.0 / F.col("zone_n"))


def zonal_percentage(values: DataFrame, zones: DataFrame) -> DataFrame:
    """Each cell with the percentage its value has in its zone."""
    cells = aligned(values, zones)
    histogram = settled(cells.groupBy("zone", "value").agg(F.count(F.lit(1)).alias("n")), "histogram")
    lookup = zone_shares(histogram).select("zone", "value", "percentage")
    joined = balanced_lookup(cells, lookup, ["zone", "value"], F.struct("col", "row"), counts=histogram)
    return joined.select("col", "row", "zone", "value", "percentage")


def zones_with_share(histogram: DataFrame, value: object, percent: float) -> DataFrame:
    """Zones in which at least ``percent`` of the cells have ``value``."""
    per_zone = histogram.groupBy("zone").agg(
        F.sum("n").alias("zone_n"), F.sum(F.when(F.col("value") == value, F.col("n")).otherwise(0)).alias("match_n")
    )
    return per_zone.filter(F.col("match_n") >= F.col("zone_n") * (percent / 100.0)).select("zone")


def keep_zones(zones: DataFrame, kept: DataFrame) -> DataFrame:
    """The cells of the kept zones; all others lose their zone."""
    marked = balanced_lookup(zones, kept.withColumn("_kept", F.lit(True)), ["zone"], F.struct("col", "row"), "left")
    return marked.select("col", "row", F.when(F.col("_kept"), F.col("zone")).alias("zone"))

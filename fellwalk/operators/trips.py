"""Trip jobs: rush hours, flow efficiency per origin and destination, demand volatility per zone.

Every frame of trips has at least ``tpep_pickup_datetime``, ``tpep_dropoff_datetime``,
``trip_distance``, ``fare_amount``, ``PULocationID`` and ``DOLocationID``.  Zones have
``LocationID``, ``Borough`` and ``Zone``.  Groups are shuffled after partial aggregation, so
a pair or zone that holds a third of all trips costs one row per task in the exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from fellwalk.functions.numbers import finite, ieee_ratio, minutes_between, ratio
from fellwalk.operators.joins import same_group_join

MONDAY, FRIDAY = 2, 6


def on_weekdays(trips: DataFrame) -> DataFrame:
    """Trips picked up from Monday to Friday."""
    return trips.filter(F.dayofweek("tpep_pickup_datetime").between(MONDAY, FRIDAY))


def hourly_pickups(trips: DataFrame) -> DataFrame:
    """Pickups per hour of day: at most 24 rows and one for a missing time."""
    return (
        trips.select(F.hour("tpep_pickup_datetime").alias("hour"), "tpep_pickup_datetime")
        .groupBy("hour")
        .agg(F.count("tpep_pickup_datetime").alias("pickups_per_hour"))
    )


def weekday_pickups(trips: DataFrame) -> DataFrame:
    """Pickups per hour of day, Monday to Friday only."""
    return hourly_pickups(on_weekdays(trips))


def rush_hours(trips: DataFrame, quantile: float = 0.9, inclusive: bool = True) -> DataFrame:
    """Weekday hours whose pickups reach the given quantile of the hourly counts.

    The threshold is a scalar subquery over the 24 hourly counts; nothing returns to the
    driver.
    """
    hours = weekday_pickups(trips)
    threshold = hours.agg(F.percentile_approx("pickups_per_hour", quantile, 10000)).scalar()
    count = F.col("pickups_per_hour")
    return hours.filter(count >= threshold if inclusive else count > threshold)


def rush_hours_by_rank(trips: DataFrame, quantile: float = 0.9) -> DataFrame:
    """The hours above position ``floor(n * quantile)`` when sorted by pickups; ties by hour."""
    by_count = Window.orderBy("pickups_per_hour", "hour")
    hours = weekday_pickups(trips)
    cut = hours.agg(F.floor(F.count(F.lit(1)) * F.lit(quantile))).scalar()
    return (
        hours.withColumn("position", F.row_number().over(by_count))
        .filter(F.col("position") > cut)
        .select("hour", "pickups_per_hour", F.col("position").cast("int").alias("position"))
    )


def with_zone(df: DataFrame, zones: DataFrame, role: str, strict: bool = False) -> DataFrame:
    """Add borough and zone of the ``role`` location (``PU`` or ``DO``) by a left join.

    With ``strict`` a location without a zone ends the job instead of giving NULL.
    The planner broadcasts ``zones`` only while it measures small.
    """
    key = f"{role}LocationID"
    looked_up = zones.select(
        F.col("LocationID").alias(key),
        F.col("Borough").alias(f"{role}_Borough"),
        F.col("Zone").alias(f"{role}_Zone"),
        F.lit(True).alias("_known"),
    )
    joined = df.join(looked_up, key, "left")
    if strict:
        message = F.concat(F.lit(f"no zone for {key} "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
        joined = joined.withColumn("_known", F.when(F.col("_known"), True).otherwise(F.raise_error(message)))
        joined = joined.filter("_known")
    return joined.drop("_known")


def flow_statistics(trips: DataFrame, skip_non_finite: bool = False) -> DataFrame:
    """Count, mean duration, mean speed and mean fare per mile for each origin and destination.

    Zero divisors give NULL, which the mean skips.  With ``skip_non_finite`` the ratios are
    plain double divisions and the means skip NaN and infinities instead; the result is the
    same unless the inputs hold such values themselves.
    """
    minutes = minutes_between(F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime"))
    distance, fare = F.col("trip_distance"), F.col("fare_amount")
    if skip_non_finite:
        measures = (finite(minutes), finite(ieee_ratio(distance, minutes / 60.0)), finite(ieee_ratio(fare, distance)))
    else:
        measures = (minutes, ratio(distance, minutes / 60.0), ratio(fare, distance))
    names = ("avg_duration_minutes", "avg_mph", "avg_fare_per_mile")
    return trips.groupBy("PULocationID", "DOLocationID").agg(
        F.count(F.lit(1)).alias("count"), *[F.avg(m).alias(n) for m, n in zip(measures, names)]
    )


def trip_flows(
    trips: DataFrame,
    zones: DataFrame,
    top: int = 20,
    inclusive: bool = True,
    weekdays_only: bool = False,
    strict: bool = False,
) -> DataFrame:
    """The busiest rush-hour flows with their zones.

    The rush hours (at most 24 rows) are broadcast and semi-joined; only aggregated pairs
    reach the zone joins, and the sort keeps ``top`` rows per task.
    """
    rush = F.broadcast(rush_hours(trips, inclusive=inclusive).select("hour"))
    population = on_weekdays(trips) if weekdays_only else trips
    in_rush = population.withColumn("hour", F.hour("tpep_pickup_datetime")).join(rush, "hour", "left_semi")
    busiest = (
        flow_statistics(in_rush)
        .orderBy(F.col("count").desc(), F.col("PULocationID"), F.col("DOLocationID"))
        .limit(top)
    )
    named = with_zone(with_zone(busiest, zones, "PU", strict), zones, "DO", strict)
    return named.orderBy(F.col("count").desc(), F.col("PULocationID"), F.col("DOLocationID"))


def zone_volatility(trips: DataFrame, zones: DataFrame, dense_hours: bool = False) -> DataFrame:
    """Sample variance and range of the hourly pickup counts per zone, most volatile first.

    An hour without pickups is absent unless ``dense_hours`` counts it as zero.
    """
    per_hour = trips.groupBy("PULocationID", F.hour("tpep_pickup_datetime").alias("hour")).agg(
        F.count(F.lit(1)).alias("count")
    )
    if dense_hours:
        every_hour = per_hour.select("PULocationID").distinct().select(
            "PULocationID", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")
        )
        per_hour = same_group_join(every_hour, per_hour, ["PULocationID", "hour"], "left").select(
            "PULocationID", "hour", F.coalesce("count", F.lit(0)).alias("count")
        )
    per_zone = per_hour.groupBy("PULocationID").agg(
        F.var_samp("count").alias("variance"), (F.max("count") - F.min("count")).alias("min_max_diff")
    )
    return per_zone.join(zones.withColumnRenamed("LocationID", "PULocationID"), "PULocationID", "left").orderBy(
        F.col("variance").desc_nulls_last(), F.col("PULocationID")
    )


def unmatched_locations(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trip ends whose location has no zone, with their counts; empty when every lookup succeeds."""
    ends = trips.groupBy("PULocationID", "DOLocationID").agg(F.count(F.lit(1)).alias("n"))
    by_role = ends.select(
        F.explode(
            F.array(
                F.struct(F.lit("PU").alias("role"), F.col("PULocationID").alias("LocationID"), "n"),
                F.struct(F.lit("DO").alias("role"), F.col("DOLocationID").alias("LocationID"), "n"),
            )
        ).alias("end")
    ).select("end.*")
    per_location = by_role.groupBy("role", "LocationID").agg(F.sum("n").alias("n"))
    return per_location.join(zones, "LocationID", "left_anti").select("role", "LocationID", "n")

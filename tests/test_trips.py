import datetime as dt

import pytest

from fellwalk.operators import trips

SCHEMA = (
    "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, trip_distance double, "
    "fare_amount double, PULocationID int, DOLocationID int"
)


def trip(day, hour, minutes=30.0, distance=10.0, fare=20.0, pu=1, do=2):
    start = dt.datetime(2024, 1, day, hour)
    return (start, start + dt.timedelta(minutes=minutes), distance, fare, pu, do)


@pytest.fixture(scope="module")
def zones(spark):
    return spark.createDataFrame([(1, "B1", "Z1"), (2, "B2", "Z2")], "LocationID int, Borough string, Zone string")


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_weekdays_are_monday_to_friday(spark):
    # 2024-01-01 is a Monday
    days = frame(spark, [trip(d, 8) for d in range(1, 8)])
    assert trips.weekday_pickups(days).collect() == [(8, 5)]
    assert trips.hourly_pickups(days).collect() == [(8, 7)]


def test_rush_hours_with_untied_counts(spark):
    rows = [trip(1, hour) for hour in range(24) for _ in range(hour + 1)]
    df = frame(spark, rows)
    hours = lambda result: sorted(r["hour"] for r in result.collect())
    assert hours(trips.rush_hours(df)) == [21, 22, 23]
    assert hours(trips.rush_hours(df, inclusive=False)) == [22, 23]
    assert hours(trips.rush_hours_by_rank(df)) == [21, 22, 23]


def test_flows_guard_zero_divisors(spark, zones):
    df = frame(spark, [trip(1, 8), trip(1, 8, minutes=0), trip(1, 8, distance=0.0), trip(1, 8, pu=9)])
    first, second = trips.trip_flows(df, zones).collect()
    assert (first["count"], first["PU_Zone"], first["DO_Borough"]) == (3, "Z1", "B2")
    assert first["avg_duration_minutes"] == 20.0
    assert first["avg_mph"] == 10.0  # 20 and 0; the trip without duration has no speed
    assert first["avg_fare_per_mile"] == 2.0
    assert second["PU_Zone"] is None
    plain = trips.flow_statistics(df).orderBy("PULocationID").collect()
    assert plain == trips.flow_statistics(df, skip_non_finite=True).orderBy("PULocationID").collect()


def test_strict_lookup_fails_on_a_missing_zone(spark, zones):
    df = frame(spark, [trip(1, 8, pu=9)])
    with pytest.raises(Exception, match="no zone for PULocationID 9"):
        trips.trip_flows(df, zones, strict=True).collect()
    assert trips.unmatched_locations(df, zones).collect() == [("PU", 9, 1)]


def test_durations_cut_each_side_to_seconds(spark):
    rows = [(dt.datetime(2024, 1, 1, 8, 0, 10, 900000), dt.datetime(2024, 1, 1, 8, 0, 11, 100000), 1.0, 1.0, 1, 2)]
    assert trips.flow_statistics(frame(spark, rows)).first()["avg_duration_minutes"] == 1 / 60


def test_volatility(spark, zones):
    rows = [trip(1, 8)] * 4 + [trip(2, 9)] * 2 + [trip(1, 5, pu=2)] + [trip(1, 5, pu=None)] * 3
    sparse = {r["PULocationID"]: r for r in trips.zone_volatility(frame(spark, rows), zones).collect()}
    assert (sparse[1]["variance"], sparse[1]["min_max_diff"]) == (2.0, 2)
    assert sparse[2]["variance"] is None
    dense = {r["PULocationID"]: r for r in trips.zone_volatility(frame(spark, rows), zones, dense_hours=True).collect()}
    assert dense[1]["min_max_diff"] == 4 and dense[None]["min_max_diff"] == 3
    assert dense[2]["variance"] == pytest.approx(1 / 24)

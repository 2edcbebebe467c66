"""Registered queries: trips, schemas, records and statistics."""

from __future__ import annotations

from pyspark.sql import Window, functions as F, types as T

from fellwalk.functions.numbers import ieee_ratio
from fellwalk.operators import records, schemas, stats, trips
from fellwalk.plans import tables as t
from fellwalk.plans.registry import job, rounded
from fellwalk.sources import files
from fellwalk.workspace import fresh_path

# --- trips -------------------------------------------------------------------------------

WEEKDAY_SQL = """SELECT hour(tpep_pickup_datetime)::INT AS hour, count(*) AS pickups_per_hour FROM trips_v
WHERE dayofweek(tpep_pickup_datetime) + 1 BETWEEN 2 AND 6 GROUP BY 1"""

RUSH_SQL = "SELECT hour, pickups_per_hour FROM hours WHERE pickups_per_hour >= (SELECT quantile_disc(pickups_per_hour, 0.9) FROM hours)"

FLOW_SQL = """SELECT PULocationID, DOLocationID, count(*) AS count, round(avg(mins), 6) AS avg_duration_minutes,
  round(avg(trip_distance / NULLIF(mins / 60, 0)), 6) AS avg_mph,
  round(avg(fare_amount / NULLIF(trip_distance, 0)), 6) AS avg_fare_per_mile
FROM (SELECT *, (floor(epoch(tpep_dropoff_datetime)) - floor(epoch(tpep_pickup_datetime))) / 60 AS mins FROM trips_v) m
{where} GROUP BY 1, 2"""


def _trips_and_zones(spark, d):
    return t.trips(spark, d), t.zones(spark, d)


@job("hourly_pickups", t.with_views("SELECT hour(tpep_pickup_datetime)::INT AS hour, count(*) AS pickups_per_hour FROM trips_v GROUP BY 1", "trips_v"))
def hourly_pickups(spark, d):
    return trips.hourly_pickups(t.trips(spark, d))


@job("weekday_pickups", t.with_views(WEEKDAY_SQL, "trips_v"))
def weekday_pickups(spark, d):
    return trips.weekday_pickups(t.trips(spark, d))


@job("rush_hours", t.with_views(RUSH_SQL, "trips_v", extra={"hours": WEEKDAY_SQL}))
def rush_hours(spark, d):
    return trips.rush_hours(t.trips(spark, d))


@job("rush_hours_exclusive", t.with_views(RUSH_SQL.replace(">=", ">"), "trips_v", extra={"hours": WEEKDAY_SQL}))
def rush_hours_exclusive(spark, d):
    return trips.rush_hours(t.trips(spark, d), inclusive=False)


@job(
    "rush_hours_rank",
    t.with_views(
        """SELECT hour, pickups_per_hour, position FROM (
  SELECT *, row_number() OVER (ORDER BY pickups_per_hour, hour)::INT AS position FROM hours)
WHERE position > (SELECT floor(count(*) * 0.9) FROM hours)""",
        "trips_v",
        extra={"hours": WEEKDAY_SQL},
    ),
)
def rush_hours_rank(spark, d):
    return trips.rush_hours_by_rank(t.trips(spark, d))


TOP_FLOWS_SQL = """SELECT f.*, p.Borough AS PU_Borough, p.Zone AS PU_Zone, q.Borough AS DO_Borough, q.Zone AS DO_Zone
FROM (SELECT * FROM flows ORDER BY count DESC, PULocationID, DOLocationID LIMIT 20) f
LEFT JOIN zones_v p ON f.PULocationID = p.LocationID LEFT JOIN zones_v q ON f.DOLocationID = q.LocationID"""
IN_RUSH = "WHERE hour(tpep_pickup_datetime) IN (SELECT hour FROM rush)"


@job(
    "trip_flows",
    t.with_views(TOP_FLOWS_SQL, "trips_v", "zones_v", extra={"hours": WEEKDAY_SQL, "rush": RUSH_SQL, "flows": FLOW_SQL.format(where=IN_RUSH)}),
)
def trip_flows(spark, d):
    return rounded(trips.trip_flows(*_trips_and_zones(spark, d)))


@job(
    "trip_flows_weekdays",
    t.with_views(
        TOP_FLOWS_SQL,
        "trips_v",
        "zones_v",
        extra={
            "hours": WEEKDAY_SQL,
            "rush": RUSH_SQL,
            "flows": FLOW_SQL.format(where=IN_RUSH + " AND dayofweek(tpep_pickup_datetime) BETWEEN 1 AND 5"),
        },
    ),
)
def trip_flows_weekdays(spark, d):
    return rounded(trips.trip_flows(*_trips_and_zones(spark, d), weekdays_only=True))


@job("flow_statistics", t.with_views(FLOW_SQL.format(where=""), "trips_v"))
def flow_statistics(spark, d):
    return rounded(trips.flow_statistics(t.trips(spark, d), skip_non_finite=True))


@job(
    "finite_avg",
    t.with_views(
        """SELECT PULocationID, count(*) AS n, count(x) AS n_finite, round(avg(x), 6) AS finite_avg
FROM (SELECT PULocationID, fare_amount / NULLIF(trip_distance, 0) AS x FROM trips_v) GROUP BY 1""",
        "trips_v",
    ),
)
def finite_avg(spark, d):
    fare_per_mile = ieee_ratio(F.col("fare_amount"), F.col("trip_distance"))
    return rounded(stats.finite_average(t.trips(spark, d), fare_per_mile, ["PULocationID"]))


VOLATILITY_SQL = """SELECT v.PULocationID, variance, min_max_diff, Borough, Zone FROM (
  SELECT PULocationID, round(var_samp(n), 6) AS variance, max(n) - min(n) AS min_max_diff FROM ({hours}) GROUP BY 1) v
LEFT JOIN zones_v ON v.PULocationID = LocationID"""
ZONE_HOURS_SQL = "SELECT PULocationID, hour(tpep_pickup_datetime) AS h, count(*) AS n FROM trips_v GROUP BY 1, 2"


@job("zone_volatility", t.with_views(VOLATILITY_SQL.format(hours=ZONE_HOURS_SQL), "trips_v", "zones_v"))
def zone_volatility(spark, d):
    return rounded(trips.zone_volatility(*_trips_and_zones(spark, d)))


@job(
    "zone_volatility_dense",
    t.with_views(
        VOLATILITY_SQL.format(
            hours=f"""SELECT PULocationID, g.h, coalesce(n, 0) AS n
FROM (SELECT DISTINCT PULocationID FROM trips_v) CROSS JOIN range(24) g(h) LEFT JOIN ({ZONE_HOURS_SQL}) c USING (PULocationID, h)"""
        ),
        "trips_v",
        "zones_v",
    ),
)
def zone_volatility_dense(spark, d):
    return rounded(trips.zone_volatility(*_trips_and_zones(spark, d), dense_hours=True))


@job(
    "unmatched_zones",
    t.with_views(
        """SELECT role, LocationID, n FROM (
  SELECT 'PU' AS role, PULocationID AS LocationID, count(*) AS n FROM trips_v GROUP BY ALL
  UNION ALL SELECT 'DO', DOLocationID, count(*) FROM trips_v GROUP BY ALL) e
WHERE NOT EXISTS (SELECT 1 FROM zones_v z WHERE z.LocationID = e.LocationID)""",
        "trips_v",
        "zones_v",
    ),
)
def unmatched_zones(spark, d):
    return trips.unmatched_locations(*_trips_and_zones(spark, d))


@job(
    "zone_lookup",
    """SELECT CAST(s_suppkey AS INT) AS LocationID, n_name AS Borough, s_name AS Zone
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def zone_lookup(spark, d):
    """The zone lookup read back from CSV text: one zone per supplier."""
    supplier, nation = t.table(spark, d, "supplier"), t.table(spark, d, "nation")
    rows = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
    path = fresh_path(spark, "zones")
    files.write_csv(rows.select(F.col("s_suppkey").alias("LocationID"), F.col("n_name").alias("Borough"), F.col("s_name").alias("Zone")), path)
    return files.read_zones(spark, path)


# --- schemas -----------------------------------------------------------------------------

TRIP_SCHEMA = T.StructType(
    [
        T.StructField("trip_id", T.LongType()),
        T.StructField("tpep_pickup_datetime", T.TimestampType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("VendorID", T.IntegerType()),
        T.StructField("passenger_count", T.LongType()),
        T.StructField("RatecodeID", T.LongType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("payment_type", T.LongType()),
        *[T.StructField(name, T.DoubleType()) for name in (
            "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee")],
    ]
)
DOUBLES = {f.name for f in TRIP_SCHEMA if f.dataType == T.DoubleType()}


def _drifting_parts(spark, d):
    """The trips as three parts whose names, types and column order differ, one per group of zones.

    The second has fares that are no number, the third locations that no integer holds.
    """
    rows = t.trips(spark, d)
    low = rows.filter("PULocationID < 8 OR PULocationID IS NULL")
    middle = rows.filter("PULocationID >= 8 AND PULocationID < 16").select(
        F.col("trip_id").alias("Trip-ID"),
        F.col("PULocationID").cast("bigint").alias("pu_location_id"),
        F.col("DOLocationID").cast("bigint").alias("do_location_id"),
        F.when(F.col("trip_id") % 101 == 0, "n/a").otherwise(F.col("fare_amount").cast("string")).alias("Fare-Amount"),
        F.col("trip_distance").alias("TRIP_DISTANCE"),
        F.col("tpep_pickup_datetime").alias("tpepPickupDatetime"),
        F.col("tpep_dropoff_datetime").alias("tpepDropoffDatetime"),
        F.lit("x").alias("not_in_the_schema"),
        *[(F.col(n).cast("string") if n in DOUBLES else F.col(n)).alias(n.replace("_", "-").upper()) for n in t.TRIP_EXTRAS],
    )
    high = rows.filter("PULocationID >= 16").select(
        F.col("tpep_pickup_datetime").cast("timestamp").alias("tpep-pickup-datetime"),
        F.col("tpep_dropoff_datetime").cast("timestamp").alias("tpep-dropoff-datetime"),
        F.col("PULocationID").cast("double").alias("PULocationID"),
        F.when(F.col("trip_id") % 103 == 0, 1e12).otherwise(F.col("DOLocationID").cast("double")).alias("DOLocationID"),
        F.col("trip_distance").cast("decimal(10,1)").alias("trip_distance"),
        F.col("fare_amount").alias("fare_amount"),
        F.col("trip_id").cast("decimal(20,0)").alias("tripid"),
        *[(F.col(n).cast("double") if n in ("passenger_count", "RatecodeID", "payment_type") else F.col(n)).alias(n.replace("_", "")) for n in reversed(t.TRIP_EXTRAS)],
    )
    return low, middle, high


_UNION_SQL = """SELECT * REPLACE (CASE WHEN PULocationID >= 8 AND PULocationID < 16 AND trip_id % 101 = 0 THEN NULL ELSE fare_amount END AS fare_amount,
  CASE WHEN PULocationID >= 16 AND trip_id % 103 = 0 THEN NULL ELSE DOLocationID END AS DOLocationID) FROM trips_v"""


@job("schema_union", t.with_views(_UNION_SQL, "trips_v"))
def schema_union(spark, d):
    return schemas.enforced_union(_drifting_parts(spark, d), TRIP_SCHEMA)


@job("schema_union_files", t.with_views(_UNION_SQL, "trips_v"))
def schema_union_files(spark, d):
    """The same union over parquet files found by a path pattern."""
    folder = fresh_path(spark, "parts")
    for month, part in enumerate(_drifting_parts(spark, d), 1):
        part.write.parquet(f"{folder}/trips-{month:02d}")
    return files.read_drifting_parts(spark, f"{folder}/trips-*/*.parquet", TRIP_SCHEMA)


def _schema_frames(spark, d):
    base = t.table(spark, d, "customer")
    others = {name: t.table(spark, d, name) for name in ("supplier", "nation", "orders")}
    # columns without their table prefix, so that names can meet
    plain = lambda df: df.select(*[F.col(c).alias(c.split("_", 1)[1]) for c in df.columns])
    return plain(base), {name: plain(df) for name, df in others.items()}


# type names of the driver tables in the two dialects
_FIELDS_SQL = """SELECT table_name, regexp_replace(column_name, '^[a-z]+_', '') AS name,
  CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
                 WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS data_type
FROM duckdb_columns() WHERE table_name IN ('customer', 'supplier', 'nation', 'orders')"""


@job(
    "schema_diff",
    t.with_views(
        """SELECT d.dataset, coalesce(b.name, o.name) AS name, b.data_type AS base_type, o.data_type AS other_type,
  CASE WHEN o.name IS NULL THEN 'only_base' WHEN b.name IS NULL THEN 'only_other'
       WHEN b.data_type <> o.data_type THEN 'type_mismatch' ELSE 'same' END AS status
FROM (VALUES ('supplier'), ('nation'), ('orders')) d(dataset),
  (SELECT DISTINCT name FROM f) k
  LEFT JOIN (SELECT * FROM f WHERE table_name = 'customer') b ON b.name = k.name
  LEFT JOIN f o ON o.name = k.name AND o.table_name = d.dataset
WHERE b.name IS NOT NULL OR o.name IS NOT NULL""",
        extra={"f": _FIELDS_SQL},
    ),
)
def schema_diff(spark, d):
    return schemas.schema_diff(*_schema_frames(spark, d))


@job(
    "schema_diff_strict",
    t.with_views(
        """SELECT o.table_name AS dataset, 'base' AS missing_from, o.name, o.data_type, true AS nullable FROM f o
WHERE o.table_name <> 'customer'
  AND NOT EXISTS (SELECT 1 FROM f b WHERE b.table_name = 'customer' AND b.name = o.name AND b.data_type = o.data_type)
UNION ALL
SELECT d.dataset, 'other', b.name, b.data_type, true FROM f b, (VALUES ('supplier'), ('nation'), ('orders')) d(dataset)
WHERE b.table_name = 'customer'
  AND NOT EXISTS (SELECT 1 FROM f o WHERE o.table_name = d.dataset AND b.name = o.name AND b.data_type = o.data_type)""",
        extra={"f": _FIELDS_SQL},
    ),
)
def schema_diff_strict(spark, d):
    return schemas.schema_diff_strict(*_schema_frames(spark, d))


# --- records -----------------------------------------------------------------------------

CUSTOMER_FIELDS = {
    "idx": ("Index", "int"),
    "customer_id": ("Customer Id", "hex"),
    "company": ("Company", "string"),
    "city": ("City", "string"),
    "country": ("Country", "string"),
    "subscription_date": ("Subscription Date", "date"),
    **{name: (heading, "string") for name, heading in t.CUSTOMER_HEADINGS.items()},
}
_TYPED_SQL = """SELECT TRY_CAST(index_text AS INT) AS idx,
  CASE WHEN regexp_full_match(hex_text, '[0-9a-f]{1,16}') THEN CAST('0x' || hex_text AS BIGINT) END AS customer_id,
  company, city, country, TRY_CAST(date_text AS DATE) AS subscription_date, first_name, last_name, phone1, phone2, email, website
FROM customer_text_v"""


def _typed_customers(spark, d):
    path = fresh_path(spark, "customers")
    files.write_csv(t.customer_text(spark, d), path)
    return records.typed_records(files.read_text_table(spark, path), CUSTOMER_FIELDS)


@job(
    "typed_csv_clean",
    t.with_views(
        "SELECT * FROM typed WHERE idx IS NOT NULL AND customer_id IS NOT NULL AND subscription_date IS NOT NULL",
        "customers_v",
        "customer_text_v",
        extra={"typed": _TYPED_SQL},
    ),
)
def typed_csv_clean(spark, d):
    return records.good_records(_typed_customers(spark, d))


@job(
    "typed_csv_rejects",
    t.with_views(
        """SELECT failed, count(*) AS n FROM (SELECT concat_ws(',', CASE WHEN idx IS NULL THEN 'idx' END,
  CASE WHEN customer_id IS NULL THEN 'customer_id' END,
  CASE WHEN subscription_date IS NULL THEN 'subscription_date' END) AS failed FROM typed) WHERE failed <> '' GROUP BY 1""",
        "customers_v",
        "customer_text_v",
        extra={"typed": _TYPED_SQL},
    ),
)
def typed_csv_rejects(spark, d):
    rejects = records.rejected_records(_typed_customers(spark, d))
    return records.count_by(rejects.select(F.concat_ws(",", "_failed").alias("failed")), "failed")


@job(
    "typed_csv_report",
    t.with_views(
        """SELECT count(*) AS total, count(*) FILTER (good) AS parsed, count(*) FILTER (NOT good) AS rejected FROM (
  SELECT idx IS NOT NULL AND customer_id IS NOT NULL AND subscription_date IS NOT NULL AS good FROM typed)""",
        "customers_v",
        "customer_text_v",
        extra={"typed": _TYPED_SQL},
    ),
)
def typed_csv_report(spark, d):
    return records.parse_report(_typed_customers(spark, d))


@job("count_by_key", t.with_views("SELECT company, count(*) AS n FROM customers_v GROUP BY 1", "customers_v"))
def count_by_key(spark, d):
    return records.count_by(t.customers(spark, d), "company")


@job(
    "location_rollup",
    t.with_views(
        """SELECT CASE WHEN grouping(city) = 0 THEN 2 ELSE 1 END AS level, country, city,
  CASE WHEN grouping(city) = 0 THEN country || ' / ' || city ELSE country END AS path, count(*) AS n
FROM customers_v GROUP BY GROUPING SETS ((country), (country, city))""",
        "customers_v",
    ),
)
def location_rollup(spark, d):
    return records.location_rollup(t.customers(spark, d))


@job(
    "date_gaps",
    t.with_views(
        """SELECT from_date, to_date, y::INT AS years, (m - 12 * y)::INT AS months, days::INT AS days, total::INT AS total_days,
  concat_ws(', ', CASE WHEN y <> 0 THEN y || ' Year' || CASE WHEN y = 1 THEN '' ELSE 's' END END,
    CASE WHEN m - 12 * y <> 0 THEN (m - 12 * y) || ' Month' || CASE WHEN m - 12 * y = 1 THEN '' ELSE 's' END END,
    CASE WHEN days <> 0 OR m = 0 THEN days || ' Day' || CASE WHEN days = 1 THEN '' ELSE 's' END END)
  || ' (Total: ' || total || ' Day' || CASE WHEN total = 1 THEN '' ELSE 's' END || ')' AS text
FROM (SELECT *, m // 12 AS y, date_diff('day', CAST(from_date + to_months(m::INT) AS DATE), to_date) AS days,
        date_diff('day', from_date, to_date) AS total
  FROM (SELECT *, CASE WHEN apart > 0 AND day(to_date) < day(from_date) THEN apart - 1 ELSE apart END AS m
    FROM (SELECT from_date, to_date, (year(to_date) * 12 + month(to_date)) - (year(from_date) * 12 + month(from_date)) AS apart
      FROM (SELECT lag(subscription_date) OVER (ORDER BY subscription_date, idx) AS from_date, subscription_date AS to_date
        FROM customers_v) WHERE from_date IS NOT NULL)))""",
        "customers_v",
    ),
)
def date_gaps(spark, d):
    return records.date_gaps(t.customers(spark, d), "subscription_date", ordered=True)


@job(
    "int_list_parse",
    t.with_views(
        """SELECT p_partkey, '[' || array_to_string(l, ',') || ']' AS items_text,
  '[' || array_to_string(list_transform(l, lambda x: x * 10), ',') || ']' AS times_ten_text,
  len(l)::INT AS n_items, CAST(list_sum(l) AS BIGINT) AS items_sum
FROM (SELECT p_partkey, list_filter(list_transform(string_split(s, ','),
        lambda x: CASE WHEN regexp_full_match(trim(x), '[+-]?[0-9]+') THEN TRY_CAST(trim(x) AS INT) END),
      lambda x: x IS NOT NULL) AS l FROM int_lists_v)""",
        "int_lists_v",
    ),
)
def int_list_parse(spark, d):
    return records.parsed_lists(t.int_lists(spark, d), "s", "p_partkey")


@job("page_sizes", "SELECT url, length(html) AS body_size FROM pages")
def page_sizes(spark, d):
    return records.body_sizes(t.table(spark, d, "pages"))


@job("file_sizes", "SELECT o_orderpriority AS priority, count(*) * 21 AS bytes FROM orders GROUP BY 1")
def file_sizes(spark, d):
    """Sizes of the files of each priority, into which the orders were written as lines of one width."""
    folder = fresh_path(spark, "lines")
    lines = t.table(spark, d, "orders").select("o_orderpriority", F.lpad(F.col("o_orderkey").cast("string"), 20, " ").alias("value"))
    lines.write.partitionBy("o_orderpriority").text(folder)
    listed = files.list_files(spark, f"{folder}/*/*.txt")
    priority = F.url_decode(F.regexp_extract("path", "o_orderpriority=([^/]*)/", 1))
    return listed.groupBy(priority.alias("priority")).agg(F.sum("length").alias("bytes"))


@job(
    "flow_report",
    t.with_views(
        TOP_FLOWS_SQL + " ORDER BY count DESC, f.PULocationID, f.DOLocationID",
        "trips_v", "zones_v", extra={"hours": WEEKDAY_SQL, "rush": RUSH_SQL, "flows": FLOW_SQL.format(where=IN_RUSH)},
    ),
)
def flow_report(spark, d):
    """The top flows written to one sorted CSV file and read back."""
    flows, path = rounded(trips.trip_flows(*_trips_and_zones(spark, d))), fresh_path(spark, "report")
    files.write_report(flows, path, [F.col("count").desc(), "PULocationID", "DOLocationID"], single_file=True)
    return spark.read.schema(flows.schema).option("header", True).csv(path)


@job("hour_report", t.with_views("SELECT row_number() OVER (ORDER BY n DESC, h, PULocationID) AS line, * FROM (" + ZONE_HOURS_SQL + ")", "trips_v"))
def hour_report(spark, d):
    """Counts per zone and hour written as a report of several files in order, and the order in which they are read back."""
    counts = t.trips(spark, d).groupBy("PULocationID", F.hour("tpep_pickup_datetime").cast("bigint").alias("h")).agg(F.count(F.lit(1)).alias("n"))
    path = fresh_path(spark, "report")
    files.write_report(counts, path, [F.col("n").desc(), "h", "PULocationID"])
    read = spark.read.schema(counts.schema).option("header", True).csv(path).select("*", "_metadata.file_name", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at"))
    in_order = Window.orderBy("file_name", "file_block_start", "at")
    return read.select(F.row_number().over(in_order).cast("bigint").alias("line"), "PULocationID", "h", "n")


# --- statistics --------------------------------------------------------------------------

_RANGE_SQL = "SELECT min(value) AS lo, max(value) AS hi, (max(value) - min(value)) / 12.0::DOUBLE AS w FROM events"
_BINS_SQL = """SELECT bin, r.lo + bin * w AS lo_x, CASE WHEN bin = 11 THEN hi ELSE r.lo + (bin + 1) * w END AS hi_x, n
FROM (SELECT least(floor((value - lo) / w), 11)::INT AS bin, count(*) AS n FROM events, r GROUP BY 1), r"""


@job(
    "equal_width_histogram",
    t.with_views("SELECT bin, round(lo_x, 6) AS lo, round(hi_x, 6) AS hi, n FROM b", extra={"r": _RANGE_SQL, "b": _BINS_SQL}),
)
def equal_width_histogram(spark, d):
    return rounded(stats.equal_width_histogram(t.table(spark, d, "events"), "value", 12))


@job(
    "histogram_edges",
    t.with_views(
        """SELECT round(lo_x, 6) AS lo, round(coalesce(lead(lo_x) OVER (ORDER BY lo_x), (SELECT hi FROM r)), 6) AS next_lo, n FROM b""",
        extra={"r": _RANGE_SQL, "b": _BINS_SQL},
    ),
)
def histogram_edges(spark, d):
    return rounded(stats.histogram_edges(stats.equal_width_histogram(t.table(spark, d, "events"), "value", 12), ascending=False))


@job(
    "numeric_summary",
    """SELECT event_type, round(min(value), 6) AS min, round(quantile_cont(value, 0.5), 6) AS p50,
  round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99, round(max(value), 6) AS max,
  round(max(abs(value - 1)) * 100, 6) AS max_abs_pct FROM events GROUP BY 1""",
)
def numeric_summary(spark, d):
    return rounded(stats.numeric_summary(t.table(spark, d, "events"), "value", ["event_type"]))


_CELL_SQL = "printf('%.6g', {0}) || '(' || printf('%+.3g', ({0} - 1.0::DOUBLE) * 100.0::DOUBLE) || '%)' AS {1}"


@job(
    "numeric_summary_text",
    "SELECT "
    + ", ".join(
        _CELL_SQL.format(expr, name)
        for name, expr in {
            "min": "min(value)",
            "p50": "quantile_cont(value, 0.5)",
            "p95": "quantile_cont(value, 0.95)",
            "p99": "quantile_cont(value, 0.99)",
            "max": "max(value)",
        }.items()
    )
    + " FROM events",
)
def numeric_summary_text(spark, d):
    return stats.summary_text(stats.numeric_summary(t.table(spark, d, "events"), "value"))

"""Job inputs derived from the driver tables, each as a DataFrame and as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The other fields of a trip record, in terms both engines read alike.
TRIP_EXTRAS = {
    "VendorID": "CAST(event_id % 2 + 1 AS INT)",
    "passenger_count": "event_id % 6",
    "RatecodeID": "event_id % 5 + 1",
    "store_and_fwd_flag": "CASE WHEN event_id % 3 = 0 THEN 'Y' ELSE 'N' END",
    "payment_type": "event_id % 4 + 1",
    "extra": "CAST(event_id % 3 AS DOUBLE) / 2",
    "mta_tax": "CAST(event_id % 7 AS DOUBLE) / 2",
    "tip_amount": "CAST(event_id % 11 AS DOUBLE) / 4",
    "tolls_amount": "CASE WHEN event_id % 10 = 0 THEN CAST(6.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
    "improvement_surcharge": "CAST(event_id % 2 AS DOUBLE)",
    "total_amount": "value + CAST(event_id % 11 AS DOUBLE) / 4",
    "congestion_surcharge": "CAST(event_id % 2 AS DOUBLE) * 5 / 2",
    "airport_fee": "CASE WHEN event_id % 20 = 0 THEN CAST(1.25 AS DOUBLE) END",
}


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = F.make_dt_interval(F.lit(0), F.lit(0), (F.col("event_id") % 40).cast("int"), F.lit(0))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("trip_id"),
        F.col("ts").alias("tpep_pickup_datetime"),
        (F.col("ts") + minutes).alias("tpep_dropoff_datetime"),
        ((F.col("event_id") % 17).cast("double") / 2).alias("trip_distance"),
        F.col("value").alias("fare_amount"),
        (F.col("user_id") % 25).cast("int").alias("PULocationID"),
        (F.col("event_id") % 26).cast("int").alias("DOLocationID"),
        *[F.expr(value).alias(name) for name, value in TRIP_EXTRAS.items()],
    )


TRIPS_SQL = f"""
SELECT event_id AS trip_id, ts AS tpep_pickup_datetime,
       ts + to_minutes(CAST(event_id % 40 AS INT)) AS tpep_dropoff_datetime,
       CAST(event_id % 17 AS DOUBLE) / 2 AS trip_distance, value AS fare_amount,
       CAST(user_id % 25 AS INT) AS PULocationID, CAST(event_id % 26 AS INT) AS DOLocationID,
       {", ".join(f"{value} AS {name}" for name, value in TRIP_EXTRAS.items())}
FROM events"""


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("LocationID"), F.col("r_name").alias("Borough"), F.col("n_name").alias("Zone")
    )


ZONES_SQL = """
SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone
FROM nation JOIN region ON n_regionkey = r_regionkey"""


# The other fields of a customer record, with commas and quotes, in terms both engines read alike.
CUSTOMER_EXTRAS = {
    "first_name": "concat('First', c_custkey % 97)",
    "last_name": "concat('Last, \"Jr\" ', c_custkey % 89)",
    "phone1": "concat('+1-', c_custkey % 1000, '-555x', c_custkey % 10)",
    "phone2": "concat('(', c_custkey % 900, ')5550100')",
    "email": "concat('user', c_custkey, '@example.com')",
    "website": "concat('https://www.example.com/', c_custkey % 31, '/')",
}


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation, region = (table(spark, sf_dir, n) for n in ("customer", "nation", "region"))
    placed = customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    return placed.select(
        F.col("c_custkey").alias("idx"),
        F.lower(F.hex("c_custkey")).alias("customer_hex"),
        F.col("c_mktsegment").alias("company"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
        F.date_add(F.lit("2020-01-31").cast("date"), (F.col("c_custkey") * 37 % 900).cast("int")).alias("subscription_date"),
        *[F.expr(value).alias(name) for name, value in CUSTOMER_EXTRAS.items()],
    )


CUSTOMERS_SQL = f"""
SELECT c_custkey AS idx, lower(to_hex(c_custkey)) AS customer_hex, c_mktsegment AS company, n_name AS city,
       r_name AS country, DATE '2020-01-31' + CAST(c_custkey * 37 % 900 AS INT) AS subscription_date,
       {", ".join(f"{value} AS {name}" for name, value in CUSTOMER_EXTRAS.items())}
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


CUSTOMER_HEADINGS = {
    "first_name": "First Name", "last_name": "Last Name", "phone1": "Phone 1", "phone2": "Phone 2", "email": "Email", "website": "Website"}


def customer_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as text columns under the headings of a CSV export, with damaged records."""
    damaged = lambda at, value, good: F.when(F.col("idx") % 50 == at, F.lit(value)).otherwise(good)
    return customers(spark, sf_dir).select(
        damaged(13, "", F.col("idx").cast("string")).alias("Index"),
        damaged(7, "12zz", F.col("customer_hex")).alias("Customer Id"),
        F.col("company").alias("Company"),
        F.col("city").alias("City"),
        F.col("country").alias("Country"),
        damaged(11, "2021-13-01", F.date_format("subscription_date", "yyyy-MM-dd")).alias("Subscription Date"),
        *[F.col(name).alias(heading) for name, heading in CUSTOMER_HEADINGS.items()],
    )


CUSTOMER_TEXT_SQL = """
SELECT CASE WHEN idx % 50 = 13 THEN '' ELSE CAST(idx AS VARCHAR) END AS index_text,
       CASE WHEN idx % 50 = 7 THEN '12zz' ELSE customer_hex END AS hex_text,
       CASE WHEN idx % 50 = 11 THEN '2021-13-01' ELSE CAST(subscription_date AS VARCHAR) END AS date_text,
       company, city, country, first_name, last_name, phone1, phone2, email, website
FROM customers_v"""


def int_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    text = F.concat(F.col("p_size"), F.lit(", x"), key % 7, F.lit(","), -(key % 5), F.lit(",4.5, "), key % 3)
    return table(spark, sf_dir, "part").select("p_partkey", text.alias("s"))


INT_LISTS_SQL = """
SELECT p_partkey, concat(p_size, ', x', p_partkey % 7, ',', -(p_partkey % 5), ',4.5, ', p_partkey % 3) AS s FROM part"""


def tile_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tile keys from the customers: repeated (col, row) pairs, and rows down to -1."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        (key * 7 % 61).cast("int").alias("col"),
        (key * 3 % 37 - 1).cast("int").alias("row"),
        F.col("c_nationkey").alias("zoom"),
    )


TILE_KEYS_SQL = """
SELECT CAST(c_custkey * 7 % 61 AS INT) AS col, CAST(c_custkey * 3 % 37 - 1 AS INT) AS row, c_nationkey AS zoom
FROM customer"""


def dem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An elevation raster of all orders as a cell table: a dome with noise and holes, its last row partly absent."""
    orders = table(spark, sf_dir, "orders")
    side = orders.agg(F.floor(F.sqrt(F.count(F.lit(1)))).alias("w")).scalar()
    keyed = orders.select("o_orderkey", "o_custkey", side.alias("w"))
    placed = keyed.select(
        F.expr("CAST(o_orderkey % w AS INT)").alias("col"),
        F.expr("CAST(o_orderkey DIV w AS INT)").alias("row"),
        "o_orderkey",
        "o_custkey",
        "w",
    )
    dc, dr = F.expr("col - w DIV 3"), F.expr("row - w DIV 3")
    height = F.lit(4000.0) - F.lit(20.0) * (dc * dc + dr * dr) / F.col("w") + (F.col("o_custkey") * 7 % 11)
    return placed.select("col", "row", F.when(F.col("o_orderkey") % 97 != 0, height).alias("z"))


DEM_SQL = """
SELECT CAST(o_orderkey % w AS INT) AS col, CAST(o_orderkey // w AS INT) AS row,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL
            ELSE 4000.0::DOUBLE - 20.0::DOUBLE
                 * ((o_orderkey % w - w // 3) * (o_orderkey % w - w // 3)
                    + (o_orderkey // w - w // 3) * (o_orderkey // w - w // 3)) / w + (o_custkey * 7 % 11) END AS z
FROM orders, (SELECT CAST(floor(sqrt(count(*))) AS BIGINT) AS w FROM orders)"""

VIEWS = {
    "trips_v": TRIPS_SQL,
    "zones_v": ZONES_SQL,
    "customers_v": CUSTOMERS_SQL,
    "customer_text_v": CUSTOMER_TEXT_SQL,
    "int_lists_v": INT_LISTS_SQL,
    "keys_v": TILE_KEYS_SQL,
    "dem_v": DEM_SQL,
}


def with_views(sql: str, *names: str, extra: dict[str, str] | None = None, recursive: bool = False) -> str:
    """Put the named views in front of a query as common table expressions."""
    chosen = {**{n: VIEWS[n] for n in names}, **(extra or {})}
    heads = ",\n".join(f"{name} AS ({body})" for name, body in chosen.items())
    return f"WITH {'RECURSIVE ' if recursive else ''}{heads}\n{sql}"

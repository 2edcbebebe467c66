import json

import pytest
from pyspark.sql import functions as F, types as T

from fellwalk.operators import layers, polygons, schemas
from fellwalk.functions.numbers import morton
from fellwalk.sources import files
from fellwalk.sources.regions import read_regions

TARGET = T.StructType([T.StructField("VendorID", T.IntegerType()), T.StructField("airport_fee", T.DoubleType())])


def test_enforce_matches_names_and_types(spark):
    df = spark.createDataFrame([(1.5, 7, "x")], "`Airport-Fee` double, vendor_id bigint, extra string")
    found = schemas.enforce(df, TARGET)
    assert found.schema.simpleString() == "struct<VendorID:int,airport_fee:double>"
    assert found.collect() == [(7, 1.5)]


def test_last_of_two_alike_names_wins(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "VendorID int, `airport_fee` double, `Airport-Fee` double")
    assert schemas.enforce(df, TARGET).first()["airport_fee"] == 3.0


def test_missing_field_is_an_error(spark):
    with pytest.raises(KeyError, match="airport_fee"):
        schemas.enforce(spark.range(1).withColumnRenamed("id", "vendorid"), TARGET)


def test_drifting_files(spark, tmp_path):
    spark.createDataFrame([(1, 1.0)], "VendorID int, airport_fee double").write.parquet(f"{tmp_path}/m-1")
    spark.createDataFrame([(2, 2)], "vendor_id bigint, `Airport-Fee` int").write.parquet(f"{tmp_path}/m-2")
    spark.createDataFrame([(3, 3)], "vendor_id bigint, `Airport-Fee` int").write.parquet(f"{tmp_path}/m-3")
    found = files.read_drifting_parts(spark, f"{tmp_path}/m-*/*.parquet", TARGET)
    assert sorted(found.collect()) == [(1, 1.0), (2, 2.0), (3, 3.0)]
    with pytest.raises(Exception):
        files.read_drifting_parts(spark, f"{tmp_path}/none-*/*.parquet", TARGET)


def test_files_of_other_writers_and_unreadable_values(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"vendorId": ["5", "no number", None], "AIRPORT_FEE": ["1.5", "x", "2"]}), tmp_path / "a.parquet")
    pq.write_table(pa.table({"VendorID": [2**40, 6], "airport-fee": [0.5, 0.25]}), tmp_path / "b.parquet")
    found = files.read_drifting_parts(spark, f"{tmp_path}/*.parquet", TARGET).collect()
    assert sorted(found, key=str) == sorted([(5, 1.5), (None, None), (None, 2.0), (None, 0.5), (6, 0.25)], key=str)
    lost = schemas.lost_values(spark.read.parquet(f"{tmp_path}/a.parquet"), TARGET).collect()
    assert [(r["name"], r["lost"]) for r in lost] == [("VendorID", 1), ("airport_fee", 1)]


def test_drifting_files_of_every_type_by_row_group(spark, tmp_path):
    """Values of all simple types come back as Spark itself reads them; many row groups, an empty file, columns left out."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    rows = spark.range(500).select(
        "id", F.expr("timestamp'2024-03-01 10:00:00' + make_interval(0, 0, 0, 0, 0, 0, id)").alias("at"), F.expr("timestamp_ntz'2024-03-01 10:00:00'").alias("local"),
        F.expr("date'2024-03-01' + CAST(id AS INT)").alias("day"), F.expr("CAST(id / 7 AS DECIMAL(12, 3))").alias("price"), F.expr("id % 2 = 0").alias("even"),
        F.expr("CAST(id AS STRING)").alias("name"), F.expr("array(id)").alias("other"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/m-1")
    pq.write_table(pa.table({"ID": pa.array(range(1000, 1300), pa.int32()), "AT": pa.array([None] * 300, pa.timestamp("us", "UTC")), "local": pa.array([0] * 300, pa.timestamp("us")),
                             "day": pa.array([1] * 300, pa.date32()), "price": pa.array(["1.5"] * 300), "even": pa.array([True] * 300), "name": pa.array([None] * 300, pa.string())}),
                   tmp_path / "m-2.parquet", row_group_size=64)
    rows.limit(0).drop("other").write.parquet(f"{tmp_path}/m-3")
    target = rows.drop("other").schema
    found = files.read_drifting_parts(spark, f"{tmp_path}/{{m-1/*,m-2,m-3/*}}.parquet", target)
    assert found.schema.names == target.names and found.count() == 800
    first = found.filter("id < 500")
    assert first.exceptAll(rows.drop("other")).isEmpty() and rows.drop("other").exceptAll(first).isEmpty()
    assert found.filter("id >= 1000 AND price = 1.5 AND at IS NULL AND local = timestamp_ntz'1970-01-01 00:00:00'").count() == 300
    assert files.manifest_of(spark, f"{tmp_path}/m-2.parquet").first()["groups"] == 5


def test_no_path_reaches_the_plan(spark, tmp_path):
    for i in range(30):
        spark.range(i, i + 1).select(F.col("id").cast("int").alias("VendorID"), F.lit(0.5).alias("airport_fee")).coalesce(1).write.parquet(f"{tmp_path}/part-{i}")
    found = files.read_drifting_parts(spark, f"{tmp_path}/part-*/*.parquet", TARGET)
    plan = found._jdf.queryExecution().toString()
    assert "part-" not in plan.replace("part-0000", "") and plan.count("MapInArrow") <= 4 * 1
    assert sorted(r["VendorID"] for r in found.collect()) == list(range(30))


def test_schema_diff(spark):
    base = spark.createDataFrame([], "a int, b string, c double")
    other = spark.createDataFrame([], "a bigint, b string, d date")
    status = {r["name"]: r["status"] for r in schemas.schema_diff(base, {"o": other}).collect()}
    assert status == {"a": "type_mismatch", "b": "same", "c": "only_base", "d": "only_other"}
    strict = schemas.schema_diff_strict(base, {"o": other}).collect()
    assert sorted((r["missing_from"], r["name"], r["data_type"]) for r in strict) == [
        ("base", "a", "bigint"), ("base", "d", "date"), ("other", "a", "int"), ("other", "c", "double"),
    ]


def test_strict_diff_sees_nullability(spark):
    base = spark.range(1)  # not nullable
    other = spark.createDataFrame([], "id bigint")
    assert schemas.schema_diff_strict(base, {"o": other}).count() == 2
    assert [r["status"] for r in schemas.schema_diff(base, {"o": other}).collect()] == ["same"]


def test_csv_text_keeps_empty_and_missing_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b,c\n1,,"x, y"\n2\n')
    rows = files.read_text_table(spark, str(tmp_path / "a.csv")).orderBy("a").collect()
    assert rows[0] == ("1", "", "x, y")
    assert rows[1] == ("2", None, None)


def test_zone_csv(spark, tmp_path):
    (tmp_path / "z.csv").write_text("LocationID,Borough,Zone,service_zone\n1,EWR,Newark,EWR\nx,Q,Y,Z\n")
    assert files.read_zones(spark, str(tmp_path / "z.csv")).collect() == [(1, "EWR", "Newark"), (None, "Q", "Y")]


def test_report_in_one_sorted_file(spark, tmp_path):
    df = spark.range(100).select((F.col("id") * 37 % 100).alias("n")).repartition(5)
    files.write_report(df, f"{tmp_path}/r", [F.col("n").desc()], single_file=True)
    (part,) = (tmp_path / "r").glob("part-*.csv")
    assert part.read_text().split() == ["n", *[str(n) for n in range(99, -1, -1)]]


def test_report_is_in_order_over_its_files(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("n")).repartition(5)
    files.write_report(df, f"{tmp_path}/r", ["n"])
    lines = [int(x) for part in sorted((tmp_path / "r").glob("part-*.csv")) for x in part.read_text().split()[1:]]
    assert lines == list(range(1000))


def test_file_sizes(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"12345")
    (row,) = files.list_files(spark, f"{tmp_path}/*.bin").collect()
    assert row["path"].endswith("a.bin") and row["length"] == 5


def test_color_ramp(spark, tmp_path):
    (tmp_path / "ramp.txt").write_text("0   68  1  84\n5   71  44 122\n\n")
    assert files.read_color_ramp(spark, str(tmp_path / "ramp.txt")).collect() == [(0.0, 68, 1, 84), (5.0, 71, 44, 122)]


def test_layer_catalog_reads_one_zoom(spark, tmp_path, raster):
    import numpy as np

    tiles = layers.to_tiles(raster(np.arange(12.0).reshape(3, 4)), layers.Georeference(0, 3, 1, 1, "x"), 2)
    files.write_layer(tiles.withColumn("zoom", F.lit(0)).unionByName(tiles.withColumn("zoom", F.lit(1))), f"{tmp_path}/c")
    assert files.read_layer(spark, f"{tmp_path}/c").count() == 8
    assert files.read_layer(spark, f"{tmp_path}/c", 1).count() == 4


def collection(*geometries, crs=None):
    features = [{"type": "Feature", "properties": {}, "geometry": g} for g in geometries]
    document = {"type": "FeatureCollection", "features": features}
    if crs:
        document["crs"] = {"type": "name", "properties": {"name": crs}}
    return json.dumps(document, indent=1)


SQUARE = [[84.0, 0.0], [90.0, 0.0], [90.0, 84.0], [84.0, 84.0], [84.0, 0.0]]


def test_regions_from_geojson(spark, tmp_path):
    path = tmp_path / "r.geojson"
    path.write_text(collection({"type": "Polygon", "coordinates": [SQUARE]}, {"type": "MultiPolygon", "coordinates": [[SQUARE], [SQUARE]]}))
    regions = read_regions(spark, str(path))
    assert sorted((r["region"], len(r["rings"])) for r in regions.collect()) == [(0, 1), (1, 2)]
    assert polygons.bounds(polygons.ring_edges(regions)).first() == (84.0, 0.0, 90.0, 84.0)
    with pytest.raises(Exception, match="names no reference system"):
        read_regions(spark, str(path), on_missing_crs="error").collect()


def test_region_reference_systems(spark, tmp_path):
    utm = {"type": "Polygon", "coordinates": [[[500000, 0], [600000, 0], [600000, 100000], [500000, 0]]]}
    path = tmp_path / "u.geojson"
    path.write_text(collection(utm, crs="urn:ogc:def:crs:EPSG::32645"))
    ring = read_regions(spark, str(path), on_missing_crs="error").first()["rings"][0]
    assert ring[0]["x"] == pytest.approx(87.0) and ring[0]["y"] == pytest.approx(0.0, abs=1e-9)
    path.write_text(collection(utm, crs="EPSG:2039"))
    with pytest.raises(Exception, match="unsupported reference system"):
        read_regions(spark, str(path)).collect()


def test_feature_sink(spark, tmp_path):
    tiles = spark.createDataFrame([("t", 86, 27)], "tile string, lon int, lat int")
    files.write_features(polygons.tile_rings(tiles), f"{tmp_path}/f", ["tile"], "ring")
    (line,) = [x for p in (tmp_path / "f").glob("part-*") for x in p.read_text().splitlines()]
    feature = json.loads(line)
    assert feature["properties"] == {"tile": "t"}
    assert feature["geometry"]["coordinates"] == [[[86.0, 27.0], [87.0, 27.0], [87.0, 28.0], [86.0, 28.0], [86.0, 27.0]]]


def test_a_window_of_a_layer_reads_few_files(spark, tmp_path):
    """Files along the curve are found by their bounds; the others are not read."""
    tiles = spark.range(64 * 64).select(
        (F.col("id") % 64 - 20).cast("int").alias("tile_col"), F.floor(F.col("id") / 64).cast("int").alias("tile_row"), F.lit(1.5).alias("z"), (F.col("id") % 2).cast("int").alias("zoom"))
    path = f"{tmp_path}/layer"
    files.write_layer(tiles, path, 64)
    every = {r["file"] for r in spark.read.parquet(f"{path}/{files.BOUNDS}").collect()}
    assert len(every) >= 60
    found = files.read_layer(spark, path, 1, (3, 9), (30, 33))
    assert sorted((r["tile_col"], r["tile_row"]) for r in found.collect()) == sorted((c, r) for c in range(3, 10) for r in range(30, 34) if (c + 20) % 2 == 1)
    read = {r["f"] for r in found.select(F.input_file_name().alias("f")).collect()}
    listed = files.layer_files(spark, path, 1, (3, 9), (30, 33))
    assert 0 < len(read) <= len(listed) <= 8
    assert found.inputFiles() and len(found.inputFiles()) == len(listed)
    assert files.read_layer(spark, path, 0, (900, 901), (0, 1)).count() == 0
    assert files.read_layer(spark, path).count() == 64 * 64


def test_the_curve_goes_through_quarters(spark):
    """Every square of four, sixteen and so on is one run of the curve, negative places too."""
    frame = spark.range(256).select((F.col("id") % 16 - 8).cast("int").alias("c"), F.floor(F.col("id") / 16).cast("int").alias("r"))
    order = [(r["c"], r["r"]) for r in frame.orderBy(morton(F.col("c"), F.col("r"))).collect()]
    for size in (2, 4, 8):
        for at in range(0, 256, size * size):
            run = order[at : at + size * size]
            assert len({(c // size, r // size) for c, r in run}) == 1

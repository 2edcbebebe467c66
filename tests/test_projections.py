import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fellwalk.functions import projections as proj
from fellwalk.operators import distortion, layers, polygons, warping
from mountain_strip import RING

LCC = proj.LambertConformalConic(28.0, 32.0, 30.0, 85.0)
OMERC = proj.ObliqueMercator(75.0, 32.0, 95.0, 28.0, 0.9996)
UTM45 = proj.TransverseMercator.utm(45)
RECTANGLE = ((84.0, 0.0), (90.0, 0.0), (90.0, 84.0), (84.0, 84.0), (84.0, 0.0))


def region(spark, ring):
    points = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ring])
    return polygons.ring_edges(spark.range(1).select(F.lit("r").alias("region"), F.array(points).alias("rings")))


@pytest.mark.parametrize("ring, candidates, inside", [(RING, 57226, 17504), (RECTANGLE, 203401, 201480)])
def test_sample_counts_equal_the_published_ones(spark, ring, candidates, inside):
    assert polygons.sample_counts(region(spark, ring), 0.05).collect() == [("r", candidates, inside)]


# Published accuracy numbers: min, p50, p95, p99, max of the linear and of the areal scale, and
# the largest deviation in percent.
PUBLISHED = [
    (LCC, RING, (0.999394, 0.999803, 1.00078, 1.00133, 1.00174), "0.174", (0.998788, 0.999605, 1.00155, 1.00267, 1.00348), "0.348"),
    (OMERC, RING, (0.999496, 0.999704, 1.0005, 1.00073, 1.00089), "0.0885", (0.998992, 0.999408, 1.001, 1.00147, 1.00177), "0.177"),
    (UTM45, RECTANGLE, (0.9996, 0.999711, 1.00054, 1.00082, 1.00098), "0.0981", (0.9992, 0.999422, 1.00107, 1.00163, 1.00196), "0.196"),
]


@pytest.mark.parametrize("projection, ring, linear, linear_max, areal, areal_max", PUBLISHED, ids=["lcc", "omerc", "utm45"])
def test_distortion_equals_the_published_digits(spark, projection, ring, linear, linear_max, areal, areal_max):
    points = polygons.region_samples(region(spark, ring), 0.05)
    rows = {r["metric"]: r for r in distortion.distortion_summary(points, {"p": projection}).collect()}
    assert set(rows) == set(proj.FACTORS)
    digits = lambda row: tuple(float(f"{row[c]:.6g}") for c in ("min", "p50", "p95", "p99", "max"))
    for metric in ("k_mer", "k_par", "k_dist"):
        assert digits(rows[metric]) == linear
        assert f"{rows[metric]['max_abs_pct']:.3g}" == linear_max
    assert digits(rows["k_areal"]) == areal
    assert f"{rows['k_areal']['max_abs_pct']:.3g}" == areal_max
    assert digits(rows["anisotropy"]) == (1.0,) * 5 and digits(rows["angular_distortion"]) == (0.0,) * 5


@pytest.mark.parametrize("projection", [LCC, OMERC, UTM45, proj.TransverseMercator.utm(45, north=False)], ids=["lcc", "omerc", "utm", "south"])
def test_forward_and_inverse_agree(spark, projection):
    df = spark.createDataFrame([(lon + 0.37, lat + 0.11) for lon in range(80, 95, 3) for lat in range(20, 40, 4)], "lon double, lat double")
    x, y = projection.forward(F.col("lon"), F.col("lat"))
    lon, lat = projection.inverse(F.col("x"), F.col("y"))
    back = df.select("lon", "lat", x.alias("x"), y.alias("y")).select("lon", "lat", lon.alias("lon2"), lat.alias("lat2"))
    for r in back.collect():
        assert (r["lon2"], r["lat2"]) == pytest.approx((r["lon"], r["lat"]), abs=1e-8)


@pytest.mark.parametrize("projection", [LCC, OMERC, UTM45], ids=["lcc", "omerc", "utm"])
def test_scale_is_the_local_stretch(spark, projection):
    """The scale equals the length of a short projected step over its length on the ellipsoid."""
    step = 1e-5
    df = spark.createDataFrame([(86.3, 28.4), (78.1, 31.2), (90.9, 27.5)], "lon double, lat double")
    x0, y0 = projection.forward(F.col("lon"), F.col("lat") - step)
    x1, y1 = projection.forward(F.col("lon"), F.col("lat") + step)
    found = proj.with_scales(df.withColumn("d", F.sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2)), projection, "h", "k").collect()
    for r in found:
        s = math.sin(math.radians(r["lat"]))
        meridian = proj.SEMI_MAJOR * (1 - proj.E2) / (1 - proj.E2 * s * s) ** 1.5 * math.radians(2 * step)
        assert r["d"] / meridian == pytest.approx(r["k"], rel=1e-6)


def test_known_utm_coordinates(spark):
    df = spark.createDataFrame([(87.0, 0.0), (90.0, 0.0)], "lon double, lat double")
    x, y = UTM45.forward(F.col("lon"), F.col("lat"))
    found = df.select(x, y).collect()
    assert found[0] == pytest.approx((500000.0, 0.0), abs=1e-6)
    assert found[1][0] == pytest.approx(833978.557, abs=1e-3)


@pytest.mark.parametrize("lon, lat, zone, epsg", [(86.9, 28.0, 45, 32645), (-180.0, -1.0, 1, 32701), (179.99, 0.0, 60, 32660), (180.0, 1.0, 1, 32601), (0.0, 10.0, 31, 32631)])
def test_utm_zone(spark, lon, lat, zone, epsg):
    row = spark.range(1).select(proj.utm_zone(F.lit(lon)), proj.utm_epsg(F.lit(lon), F.lit(lat))).first()
    assert tuple(row) == (zone, epsg)


def plane(lon, lat):
    return 1000.0 + 300.0 * (lon - 86.9) - 700.0 * (lat - 28.0)


@pytest.mark.parametrize("method", ["bilinear", "nearest"])
def test_warp_of_a_plane(spark, raster, method):
    """A surface that is linear in longitude and latitude is kept by bilinear mixing."""
    geo, step = layers.Georeference(86.9, 28.03, 1 / 3600, 1 / 3600, "EPSG:4326"), 1 / 3600
    rows, cols = np.mgrid[0:30, 0:40]
    values = plane(geo.xmin + (cols + 0.5) * step, geo.ymax - (rows + 0.5) * step)
    cells = raster(values)
    shape = layers.shape_of(cells)
    target, target_shape = warping.target_frame(spark, geo, shape, UTM45, 30.0, "EPSG:32645")
    found = warping.warp(cells, geo, shape, UTM45, target, target_shape, method)
    x, y = target.xmin + (F.col("col") + 0.5) * 30.0, target.ymax - (F.col("row") + 0.5) * 30.0
    lon, lat = UTM45.inverse(x, y)
    placed = found.select("z", lon.alias("lon"), lat.alias("lat")).collect()
    assert len(placed) == target_shape.cols * target_shape.rows
    margin = step if method == "bilinear" else 0.0
    tolerance = 1e-6 if method == "bilinear" else 1000 * step
    inner = 0
    for r in placed:
        outside = r["lon"] < 86.9 or r["lon"] > 86.9 + 40 * step or r["lat"] > 28.03 or r["lat"] < 28.03 - 30 * step
        if outside:
            assert r["z"] is None
        elif 86.9 + margin < r["lon"] < 86.9 + 40 * step - margin and 28.03 - 30 * step + margin < r["lat"] < 28.03 - margin:
            inner += 1
            assert r["z"] == pytest.approx(plane(r["lon"], r["lat"]), abs=tolerance)
    assert inner > 800


def test_warp_leaves_out_cells_without_data(spark, raster):
    geo = layers.Georeference(86.9, 28.03, 1 / 3600, 1 / 3600, "EPSG:4326")
    values = np.full((12, 12), 5.0)
    values[4:8, 4:8] = np.nan
    shape = layers.Shape(0, 0, 12, 12)
    frame = warping.target_frame(spark, geo, shape, UTM45, 30.0, "EPSG:32645")
    dense = warping.warp(raster(values), geo, shape, UTM45, *frame).collect()
    sparse = warping.warp(raster(values).filter("z IS NOT NULL"), geo, shape, UTM45, *frame).collect()
    assert sorted(map(str, dense)) == sorted(map(str, sparse))
    assert {r["z"] and round(r["z"], 9) for r in dense} == {5.0, None}


def test_tiles_get_the_zone_of_their_centre(raster):
    geo = layers.Georeference(89.99, 28.0, 0.002, 0.002, "EPSG:4326")
    tiles = layers.to_tiles(raster(np.zeros((4, 8))), geo, 4)
    assert sorted(r["utm_epsg"] for r in warping.tile_utm(tiles).collect()) == [32645, 32646]
    flat = warping.projected_slopes(tiles, 150.0).filter("slope IS NOT NULL").agg({"slope": "max"}).first()[0]
    assert flat == 0.0


def sloping_tiles(raster, low=12):
    """Two tiles on both sides of a zone border, rising to the south by 20 a row of cells of 0.002 degrees, one cell without data."""
    values = np.repeat(20.0 * np.arange(12.0)[:, None], 12 + low, axis=1)
    values[2, 3] = np.nan
    return layers.to_tiles(raster(values), layers.Georeference(89.976, 28.0, 0.002, 0.002, "EPSG:4326"), 12)


def test_projected_slopes_send_no_cells_to_the_driver(raster):
    """Target cells come from one row for each tile: their number is not to be taken from the size of those rows."""
    slopes = warping.projected_slopes(sloping_tiles(raster), 25.0)
    rows = slopes.collect()
    plan = slopes._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert {(r["tile_col"], r["tile_row"]) for r in rows} == {(0, 0), (1, 0)}
    inner = [r["slope"] for r in rows if 40 < r["col"] < 60 and 60 < r["row"] < 80]
    # 0.002 degrees of latitude are 221.7 m at 28 degrees
    assert len(inner) == 2 * 19 * 19 and inner == pytest.approx([math.degrees(math.atan(20 / 221.7))] * len(inner), rel=0.01)


def test_warped_tiles_meet_their_cells_without_a_broadcast(spark, raster):
    """Every tile gives the rows it gives alone, in tiles of unequal width, and neither cells nor tiles go to the driver."""
    tiles = sloping_tiles(raster, 5)
    together = warping.warp_tiles(tiles, 100.0)
    rows = sorted(map(str, together.collect()))
    plan = together._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    alone = [warping.warp_tiles(tiles.filter(F.col("tile_col") == c), 100.0).collect() for c in range(2)]
    assert [len(a) > 0 for a in alone] == [True, True] and rows == sorted(str(r) for a in alone for r in a)
    assert warping.warp_tiles(tiles.limit(0), 100.0).collect() == []


def test_albers_scales_follow_from_its_formulas(spark):
    albers, step = proj.AlbersEqualArea(28.0, 32.0, 30.0, 85.0), 1e-5
    df = spark.createDataFrame([(lon + 0.3, lat + 0.2) for lon in range(76, 94, 4) for lat in range(22, 40, 4)], "lon double, lat double")
    moved = lambda a, b: F.array(*albers.forward(F.col("lon") + a, F.col("lat") + b))
    ends = df.select("*", moved(-step, 0).alias("w"), moved(step, 0).alias("e"), moved(0, -step).alias("s"), moved(0, step).alias("n"))
    found = distortion.distortion(ends, {"p": albers}).collect()
    for r in found:
        phi, d = math.radians(r["lat"]), math.radians(2 * step)
        squeeze = 1 - proj.E2 * math.sin(phi) ** 2
        along = math.hypot(r["n"][0] - r["s"][0], r["n"][1] - r["s"][1]) / d / (proj.SEMI_MAJOR * (1 - proj.E2) / squeeze**1.5)
        across = math.hypot(r["e"][0] - r["w"][0], r["e"][1] - r["w"][1]) / d / (proj.SEMI_MAJOR * math.cos(phi) / math.sqrt(squeeze))
        assert (r["k_mer"], r["k_par"]) == pytest.approx((along, across), abs=1e-7)
        assert r["k_areal"] == pytest.approx(1.0, abs=1e-12)
        assert r["anisotropy"] == pytest.approx(max(along, across) / min(along, across), abs=1e-6)
        assert r["angular_distortion"] == pytest.approx(math.degrees(2 * math.asin(abs(along - across) / (along + across))), abs=1e-5)
    assert max(r["anisotropy"] for r in found) > 1.001
    on_parallel = distortion.distortion(df.filter("lon < 77").withColumn("lat", F.lit(28.0)), {"p": albers}).first()
    assert on_parallel["k_par"] == pytest.approx(1.0, abs=1e-12)

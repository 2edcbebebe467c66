import numpy as np
import pytest
from conftest import grid_of

from fellwalk.operators import layers, surfaces, tilekeys, zonal

KEYS = [(1, 2, 3), (3, 1, 2), (1, 2, 1), (4, 2, 3)]


@pytest.fixture(scope="module")
def keys(spark):
    return spark.createDataFrame(KEYS, "col int, row int, zoom int")


def test_key_texts(keys):
    found = {(r["col"], r["row"], r["zoom"]): r for r in tilekeys.formatted_keys(keys).collect()}
    assert found[(1, 2, 3)]["short"] == "3z/1c/2r"
    assert found[(1, 2, 3)]["index"] == "0x00000001-0x00000002-0x00000003"
    assert found[(4, 2, 3)]["id"] == "id:0x00000004-0x00000002-0x00000003"


def test_negative_words_have_eight_digits(spark):
    df = spark.createDataFrame([(-1, 255, None)], "col int, row int, zoom int")
    row = tilekeys.formatted_keys(df).first()
    assert row["index"].startswith("0xffffffff-0x000000ff") and row["zoom_or_none"] == -1


def test_neighbours(spark, keys):
    centre = spark.createDataFrame([(1, 2)], "col int, row int")
    plus = {(r["col"], r["row"]) for r in tilekeys.neighbours(centre).collect()}
    assert plus == {(2, 2), (0, 2), (1, 3), (1, 1)}
    box = {(r["col"], r["row"]) for r in tilekeys.neighbours(centre, "box").collect()}
    assert len(box) == 8 and (1, 2) not in box and plus < box
    assert (4, 6, 3) in tilekeys.shifted(keys, 3, 4).collect()


def test_occupancy_picture(spark):
    plus = spark.createDataFrame([(2, 2), (0, 2), (1, 3), (1, 1), (1, 1)], "col int, row int")
    assert [r["picture"] for r in tilekeys.occupancy_picture(plus).collect()] == ["□■□", "■□■", "□■□"]
    apart = spark.createDataFrame([(-1, 0), (2, 2)], "col int, row int")
    assert [r["picture"] for r in tilekeys.occupancy_picture(apart).collect()] == ["■□□□", "□□□□", "□□□■"]
    assert tilekeys.occupancy_picture(plus.filter("col > 9")).count() == 0


GEO = layers.Georeference(10.0, 50.0, 0.5, 0.25, "EPSG:4326")


@pytest.mark.parametrize("size", [1, 3, 4, 16])
def test_tiles_keep_every_cell(raster, size):
    values = np.arange(35.0).reshape(5, 7)
    values[2, 3] = np.nan
    cells = raster(values)
    tiles = layers.to_tiles(cells, GEO, size)
    for recovered in (layers.to_cells(tiles, size), layers.pieces_to_cells(tiles)):
        assert sorted(recovered.collect()) == sorted(cells.collect())


def test_absent_cells_become_no_data(raster):
    values = np.arange(20.0).reshape(4, 5)
    keep = np.random.default_rng(2).random((4, 5)) < 0.5
    keep[3, 4] = True
    found = grid_of(layers.to_cells(layers.to_tiles(raster(values, keep=keep), GEO, 3), 3), "z", (4, 5))
    assert np.array_equal(found, np.where(keep, values, np.nan), equal_nan=True)


def test_layer_metadata(raster):
    tiles = layers.to_tiles(raster(np.zeros((5, 7))), GEO, 3)
    row = layers.layer_metadata(tiles).first()
    assert (row["tiles"], row["cells"], row["crs"]) == (6, 35, "EPSG:4326")
    assert (row["xmin"], row["ymin"], row["xmax"], row["ymax"]) == (10.0, 48.75, 13.5, 50.0)
    assert (row["cell_width"], row["cell_height"]) == (0.5, 0.25)
    assert (row["max_tile_col"], row["max_tile_row"], row["first_tile_col"], row["first_tile_row"]) == (2, 1, 0, 0)


def test_mixed_reference_systems_fail(raster):
    tiles = layers.to_tiles(raster(np.zeros((2, 2))), GEO, 3)
    other = layers.to_tiles(raster(np.zeros((2, 2))), layers.Georeference(10.0, 50.0, 0.5, 0.25, "EPSG:32645"), 3)
    with pytest.raises(Exception, match="different reference systems"):
        layers.layer_metadata(tiles.unionByName(other)).collect()


def test_statistics_and_peak(raster):
    values = np.array([[1.0, 2.0, 2.0], [3.0, np.nan, 9.0], [9.0, 3.0, 0.0]])
    row = surfaces.cell_statistics(raster(values)).first()
    flat = values[~np.isnan(values)]
    assert row["data_cells"] == 8 and row["mode"] == 2.0 and row["median"] == np.median(flat)
    assert row["stddev"] == pytest.approx(flat.std()) and (row["zmin"], row["zmax"]) == (0.0, 9.0)
    assert surfaces.peak_cell(raster(values)).collect() == [(2, 1, 9.0)]
    assert surfaces.peak_cell(raster(np.full((2, 2), -3.0))).collect() == [(0, 0, -3.0)]


def test_classes_at_their_breaks(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 5.0, 5.9, 6.0, 15.99, 16.0, 30.5, 31.0, None)], "v double")
    truncated = surfaces.break_class(df["v"])
    exact = surfaces.break_class(df["v"], truncate=False)
    found = df.select(truncated, exact, surfaces.class_label(truncated)).collect()
    assert [r[0] for r in found] == [0, 0, 0, 1, 1, 2, 2, 3, None]
    assert [r[1] for r in found] == [0, 1, 1, 1, 2, 2, 3, 3, None]
    assert [r[2] for r in found] == ["0-5"] * 3 + ["5-15"] * 2 + ["15-30"] * 2 + ["30-Inf", None]


def test_ramp_colors(spark):
    df = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 2.5, 5.0, 70.0, 99.0, None)], "v double")
    found = df.select(*surfaces.ramp_color(df["v"])).collect()
    assert found[0] == found[1] == (68, 1, 84)
    assert found[2] == (70, 23, 103)
    assert found[3] == (71, 44, 122) and found[4] == found[5] == (253, 231, 36) and found[6] == (None, None, None)


def test_quantile_classes_are_equally_filled(raster):
    found = surfaces.quantile_classes(raster(np.arange(100.0).reshape(10, 10)), 4).groupBy("class").count().collect()
    assert sorted(r["count"] for r in found) == [25, 25, 25, 25]


def test_local_algebra(raster):
    cells = raster(np.array([[-4.0, 2.0, 6.0, np.nan]]))
    assert [r["z"] for r in surfaces.drop_negative(cells).orderBy("col").collect()] == [None, 2.0, 6.0, None]
    assert [r["z"] for r in surfaces.normalised(cells).orderBy("col").collect()] == [0.0, 0.6, 1.0, None]
    assert [r["z"] for r in surfaces.scaled(cells).orderBy("col").collect()] == [-8.0, 4.0, 12.0, None]


def test_zonal_jobs(spark):
    values = spark.createDataFrame([(c, 0, c % 2) for c in range(8)] + [(9, 0, None)], "col int, row int, value int")
    zones = spark.createDataFrame([(c, 0, c // 4) for c in range(7)] + [(9, 0, 1), (8, 0, 1)], "col int, row int, zone int")
    histogram = zonal.zonal_histogram(values, zones)
    assert sorted(histogram.collect()) == [(0, 0, 2), (0, 1, 2), (1, 0, 2), (1, 1, 1)]
    share = {r["col"]: r["percentage"] for r in zonal.zonal_percentage(values, zones).collect()}
    assert len(share) == 7 and share[0] == 50.0 and share[4] == pytest.approx(200 / 3)
    kept = zonal.zones_with_share(histogram, 1, 50.0)
    assert [r["zone"] for r in kept.collect()] == [0]
    left = {r["col"]: r["zone"] for r in zonal.keep_zones(zones, kept).collect()}
    assert left[0] == 0 and left[5] is None and len(left) == 9

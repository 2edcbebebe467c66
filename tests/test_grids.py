"""Raster files: round trips of cells and headers, windows, and what is read."""

import numpy as np
import pytest
from conftest import grid_of
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, IsNotNull, LessThan

from fellwalk.operators.layers import Georeference, Shape
from fellwalk.sources import grids


@pytest.fixture
def terrain():
    z = np.random.default_rng(2).normal(size=(23, 37))
    z[3:6, 4:9] = np.nan
    z[20] = np.nan
    return z


def test_cells_come_back_from_strips(spark, raster, tmp_path, monkeypatch, terrain):
    monkeypatch.setattr(grids, "STRIP_ROWS", 4)
    cells = raster(terrain).filter("z IS NOT NULL").withColumn("twice", F.col("z") * 2)
    folder = str(tmp_path / "layer")
    geo = Georeference(8.25, 47.5, 1 / 3600, 1 / 3600, "EPSG:4326")
    header = grids.write_grid(cells, folder, ["z", "twice"], Shape(0, 0, 37, 23), geo)
    assert grids.read_header(folder) == header and header.geo == geo
    assert sorted(p.name for p in (tmp_path / "layer").iterdir()) == ["layer.hdr", *[f"strip-{i:06d}.bil" for i in range(6)]]
    for window in (5, 256):
        found = grids.read_grid(spark, folder, window)
        assert found.count() == 2 * terrain.size
        assert np.array_equal(grid_of(found.filter("band = 0"), "z", terrain.shape), terrain, equal_nan=True)
        assert np.array_equal(grid_of(found.filter("band = 1"), "z", terrain.shape), 2 * terrain, equal_nan=True)


def test_filters_reach_the_source(spark, raster, tmp_path, terrain):
    folder = str(tmp_path / "layer")
    shifted = raster(terrain).select((F.col("col") - 10).alias("col"), (F.col("row") + 100).alias("row"), "z")
    grids.write_grid(shifted, folder)
    found = grids.read_grid(spark, folder, 8).filter("col >= -5 AND col < 2 AND row = 107 AND z IS NOT NULL")
    assert {(r["col"], r["z"]) for r in found.collect()} == {(c - 10, terrain[7, c]) for c in range(5, 12) if not np.isnan(terrain[7, c])}
    assert "col >=" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.rdd.getNumPartitions() == 2 and grids.read_grid(spark, folder, 8).rdd.getNumPartitions() == 15

    reader = grids.GridReader(grids.as_uri(folder), 8)
    left = list(reader.pushFilters([GreaterThanOrEqual(("col",), -5), LessThan(("col",), 2), EqualTo(("row",), 107), IsNotNull(("z",))]))
    assert left == [IsNotNull(("z",))]
    windows = reader.partitions()
    assert [(w.west, w.north, w.east, w.south) for w in windows] == [(5, 7, 8, 8), (8, 7, 12, 8)]
    assert sum(b.num_rows for w in windows for b in reader.read(w)) == 7


def test_windows_beyond_the_layer_read_nothing(spark, raster, tmp_path, terrain):
    folder = str(tmp_path / "layer")
    grids.write_grid(raster(terrain), folder)
    assert grids.read_grid(spark, folder).filter("col > 1000").count() == 0


def test_other_layouts_are_refused(tmp_path):
    text = grids.Header(Shape(0, 0, 2, 2), 1, 256, None).text()
    assert grids.Header.of(text).shape == Shape(0, 0, 2, 2)
    with pytest.raises(ValueError, match="little-endian"):
        grids.Header.of(text.replace("BYTEORDER I", "BYTEORDER M"))

import math

import numpy as np
import pytest
from conftest import grid_of

from fellwalk.operators import resampling, terrain


def weighted_gradient(z, cell):
    """The 3x3 gradient by direct indexing."""
    padded = np.pad(z, 1, constant_values=np.nan)
    part = lambda dr, dc: padded[1 + dr : 1 + dr + z.shape[0], 1 + dc : 1 + dc + z.shape[1]]
    v = {(dr, dc): np.where(np.isnan(part(dr, dc)), z, part(dr, dc)) for dr in (-1, 0, 1) for dc in (-1, 0, 1)}
    dx = (v[-1, 1] + 2 * v[0, 1] + v[1, 1] - v[-1, -1] - 2 * v[0, -1] - v[1, -1]) / (8 * cell)
    dy = (v[1, -1] + 2 * v[1, 0] + v[1, 1] - v[-1, -1] - 2 * v[-1, 0] - v[-1, 1]) / (8 * cell)
    return np.where(np.isnan(z), np.nan, dx), np.where(np.isnan(z), np.nan, dy)


@pytest.fixture(scope="module")
def bumpy():
    rng = np.random.default_rng(11)
    z = rng.normal(0, 5, (13, 17)).cumsum(axis=0)
    z[rng.random(z.shape) < 0.08] = np.nan
    return z


@pytest.mark.parametrize("block", [1, 4, 64])
def test_slope_and_aspect_for_any_block(raster, bumpy, block):
    dx, dy = weighted_gradient(bumpy, 30.0)
    slope = grid_of(terrain.slope(raster(bumpy), 30.0, block=block), "slope", bumpy.shape)
    assert np.allclose(slope, np.degrees(np.arctan(np.hypot(dx, dy))), equal_nan=True)
    aspect = grid_of(terrain.aspect(raster(bumpy), 30.0, block=block), "aspect", bumpy.shape)
    assert np.allclose(aspect, (450 - np.degrees(np.arctan2(dy, -dx))) % 360, equal_nan=True)


def test_partitioning_does_not_matter(raster, bumpy):
    one, many = (terrain.slope(raster(bumpy, n), 30.0, block=5) for n in (1, 8))
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_absent_cells_are_no_data(raster, bumpy):
    keep = np.random.default_rng(4).random(bumpy.shape) < 0.7
    masked = np.where(keep, bumpy, np.nan)
    sparse = grid_of(terrain.slope(raster(bumpy, keep=keep), 30.0, block=4), "slope", bumpy.shape)
    dense = grid_of(terrain.slope(raster(masked), 30.0, block=4), "slope", bumpy.shape)
    assert np.array_equal(sparse, dense, equal_nan=True)


def test_plane(raster):
    rows, cols = np.mgrid[0:6, 0:6]
    slope = grid_of(terrain.slope(raster(3.0 * cols + 4.0 * rows), 1.0), "slope", (6, 6))
    assert np.allclose(slope[1:-1, 1:-1], math.degrees(math.atan(5)))


@pytest.mark.parametrize("step, heading", [((0, -1), 90), ((0, 1), 270), ((1, 0), 0), ((-1, 0), 180), ((0, 0), -1)])
def test_aspect_is_downhill_from_north(raster, step, heading):
    rows, cols = np.mgrid[0:3, 0:3]
    found = grid_of(terrain.aspect(raster(step[0] * rows + step[1] * cols + 5.0), 1.0), "aspect", (3, 3))
    assert found[1, 1] == heading


def test_tile_local_ignores_other_tiles(raster, bumpy):
    whole = bumpy.copy()
    expected = np.full(bumpy.shape, np.nan)
    for r in range(0, 13, 4):
        for c in range(0, 17, 4):
            dx, dy = weighted_gradient(whole[r : r + 4, c : c + 4], 30.0)
            expected[r : r + 4, c : c + 4] = np.degrees(np.arctan(np.hypot(dx, dy)))
    found = grid_of(terrain.slope(raster(bumpy), 30.0, block=4, tile_local=True), "slope", bumpy.shape)
    assert np.allclose(found, expected, equal_nan=True)


def test_hillshade(raster):
    flat = grid_of(terrain.hillshade(raster(np.zeros((3, 3))), 1.0), "hillshade", (3, 3))
    assert np.allclose(flat, 255 * math.sin(math.radians(45)))
    rows, cols = np.mgrid[0:3, 0:3]
    # a slope of 45 degrees that faces the sun in the north west squarely
    facing = grid_of(terrain.hillshade(raster((cols + rows) / math.sqrt(2.0)), 1.0), "hillshade", (3, 3))
    assert facing[1, 1] == pytest.approx(255)
    away = grid_of(terrain.hillshade(raster(-(cols + rows) / math.sqrt(2.0) * 3), 1.0), "hillshade", (3, 3))
    assert away[1, 1] == 0


def test_focal_mean(raster, bumpy):
    padded = np.pad(bumpy, 1, constant_values=np.nan)
    stack = [padded[1 + a : 14 + a, 1 + b : 18 + b] for a in (-1, 0, 1) for b in (-1, 0, 1)]
    expected = np.where(np.isnan(bumpy), np.nan, np.nanmean(stack, axis=0))
    assert np.allclose(grid_of(terrain.focal_mean(raster(bumpy), block=4), "focal_mean", bumpy.shape), expected, equal_nan=True)


def bilinear(z, rows, cols):
    out = np.full((rows, cols), np.nan)
    for r in range(rows):
        for c in range(cols):
            y, x = (r + 0.5) * z.shape[0] / rows - 0.5, (c + 0.5) * z.shape[1] / cols - 0.5
            total = weight = 0.0
            for a in (math.floor(y), math.floor(y) + 1):
                for b in (math.floor(x), math.floor(x) + 1):
                    w = (1 - abs(y - a)) * (1 - abs(x - b))
                    if w > 0 and not np.isnan(z[a, b]):
                        total, weight = total + w * z[a, b], weight + w
            out[r, c] = total / weight if weight else np.nan
    return out


@pytest.mark.parametrize("limits", [(5, 5), (16, 9), (3, 100), (1, 1)])
def test_downsample(raster, bumpy, limits):
    shape = resampling.fitted_shape(resampling.shape_of(raster(bumpy)), *limits)
    found = grid_of(resampling.downsample(raster(bumpy), *limits), "z", (shape.rows, shape.cols))
    assert np.allclose(found, bilinear(bumpy, shape.rows, shape.cols), equal_nan=True)


def test_downsample_never_enlarges(raster, bumpy):
    assert np.array_equal(grid_of(resampling.downsample(raster(bumpy)), "z", bumpy.shape), bumpy, equal_nan=True)


def test_pyramid(raster):
    z = np.array([[1.0, 2, 3], [5, np.nan, 7], [9, 10, 11]])
    levels = resampling.pyramid(raster(z), 2)
    assert grid_of(levels.filter("level = 1"), "z", (2, 2)).tolist() == [[8 / 3, 5.0], [9.5, 11.0]]
    assert levels.filter("level = 2").collect() == [(2, 0, 0, 6.0)]
    assert grid_of(resampling.halved(raster(z)), "z", (2, 2))[0, 0] == pytest.approx(8 / 3)

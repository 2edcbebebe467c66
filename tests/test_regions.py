import heapq
import math

import numpy as np
import pytest
from conftest import grid_of

from fellwalk.operators import components, costs, regions, visibility
from fellwalk.operators.terrain import slope

STEPS = {4: [(0, 1), (1, 0), (0, -1), (-1, 0)]}
STEPS[8] = STEPS[4] + [(1, 1), (1, -1), (-1, 1), (-1, -1)]


def flood(mask, connectivity):
    """Smallest cell number of each region, by flood fill."""
    label = np.full(mask.shape, np.nan)
    for r, c in zip(*np.nonzero(mask)):
        if not np.isnan(label[r, c]):
            continue
        stack, number = [(r, c)], r * mask.shape[1] + c
        label[r, c] = number
        while stack:
            y, x = stack.pop()
            for dy, dx in STEPS[connectivity]:
                b, a = y + dy, x + dx
                if 0 <= b < mask.shape[0] and 0 <= a < mask.shape[1] and mask[b, a] and np.isnan(label[b, a]):
                    label[b, a] = number
                    stack.append((b, a))
    return label


def spiral(size):
    """One long winding region."""
    mask = np.zeros((size, size), dtype=bool)
    for ring in range(0, size // 2, 2):
        mask[ring, ring : size - ring] = mask[size - 1 - ring, ring : size - ring] = True
        mask[ring : size - ring, ring] = mask[ring : size - ring, size - 1 - ring] = True
        if ring:
            mask[ring, ring - 1] = True
            mask[ring + 1, ring] = False
    return mask


@pytest.mark.parametrize("connectivity", [4, 8])
@pytest.mark.parametrize("tile_size", [3, 7, 256])
def test_regions_for_any_tile_size(spark, raster, connectivity, tile_size):
    mask = np.random.default_rng(8).random((19, 23)) < 0.6
    mask[:, 22] = mask[18, :] = True
    cells = raster(np.where(mask, 1.0, np.nan)).filter("z IS NOT NULL")
    shape = regions.Shape(0, 0, 23, 19)
    found = grid_of(regions.label_regions(cells, connectivity, tile_size, shape), "region", mask.shape)
    assert np.array_equal(found, flood(mask, connectivity), equal_nan=True)


def test_a_winding_region_over_many_tiles(raster):
    mask = spiral(24)
    cells = raster(np.where(mask, 1.0, np.nan)).filter("z IS NOT NULL")
    found = grid_of(regions.label_regions(cells, 4, 3, regions.Shape(0, 0, 24, 24)), "region", mask.shape)
    assert np.array_equal(found, flood(mask, 4), equal_nan=True)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(8, 60)]
    edges = spark.createDataFrame(chain + star + [(500, 499), (500, 500)], "a bigint, b bigint")
    found = dict(components.connected_components(edges).collect())
    assert found == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in range(7, 60)}, 499: 499, 500: 499}
    assert components.connected_components(edges.filter("a < 0")).count() == 0


def seen_from(z, col, row, cell):
    """Visibility by walking every line to a border cell."""
    rows, cols = z.shape
    seen = np.where(np.isnan(z), np.nan, 0.0)
    if not np.isnan(z[row, col]):
        seen[row, col] = 1
    border = [(r, c) for r in range(rows) for c in range(cols) if r in (0, rows - 1) or c in (0, cols - 1)]
    for r1, c1 in border:
        dc, dr = c1 - col, r1 - row
        n = max(abs(dc), abs(dr))
        highest = -math.inf
        for k in range(1, n + 1):
            c, r = col + math.floor((2 * dc * k + n) / (2 * n)), row + math.floor((2 * dr * k + n) / (2 * n))
            if np.isnan(z[r, c]):
                continue
            angle = (z[r, c] - z[row, col]) / (math.hypot(c - col, r - row) * cell)
            if angle >= highest:
                seen[r, c] = 1
            highest = max(highest, angle)
    return seen


@pytest.mark.parametrize("observer", [(6, 4), (0, 0), (12, 8), (0, 5)])
def test_viewshed(raster, observer):
    z = np.random.default_rng(5).normal(0, 20, (9, 13))
    z[2, 3] = z[7, 8] = np.nan
    found = grid_of(visibility.viewshed(raster(z), *observer, 30.0), "visible", z.shape)
    assert np.array_equal(found, seen_from(z, *observer, 30.0), equal_nan=True)


@pytest.mark.parametrize("observer", [(17, 11), (0, 0), (29, 3), (5, 20)])
def test_viewshed_over_many_blocks(raster, monkeypatch, observer):
    """Lines through blocks of any size, in short runs, see what whole lines see."""
    monkeypatch.setattr(visibility, "MOST_STEPS", 40)
    z = np.random.default_rng(6).normal(0, 20, (21, 30))
    z[4:8, 6:11] = np.nan
    expected = seen_from(z, *observer, 30.0)
    for block in (4, 7):
        monkeypatch.setattr(visibility, "BLOCK", block)
        found = grid_of(visibility.viewshed(raster(z), *observer, 30.0), "visible", z.shape)
        assert np.array_equal(found, expected, equal_nan=True)


def test_lines_leave_one_row_a_block():
    """What is shuffled follows the rims of blocks: of each block at most as many rows as lines pass it."""
    handed = []
    lines = visibility.Lines(visibility.Shape(0, 0, 512, 512), 256, 256)
    for west, north in ((128, -64), (-256, -256), (192, 191)):
        passing = sum(len(number) for number, *_ in lines.steps(west, north, west + 63, north + 63))
        handed.append(passing)
        assert passing <= 6 * 64
    assert all(handed)


def test_flat_land_is_seen_whole(raster):
    assert grid_of(visibility.viewshed(raster(np.zeros((6, 11))), 3, 2, 30.0), "visible", (6, 11)).min() == 1


@pytest.mark.parametrize("size", [(1, 5), (5, 1), (1, 1), (2, 2)])
def test_narrow_rasters(raster, size):
    z = np.zeros(size)
    assert grid_of(visibility.viewshed(raster(z), 0, 0, 1.0), "visible", size).min() == 1


@pytest.mark.parametrize("percent", [0.0, 30.0, 60.0, 100.0])
def test_visible_regions_end_to_end(raster, percent):
    rng = np.random.default_rng(21)
    z = rng.normal(0, 6, (16, 18)).cumsum(axis=1)
    z[4, 5] = np.nan
    cells = raster(z)
    steep = grid_of(slope(cells, 30.0), "slope", z.shape)
    label = flood(steep <= 15, 4)
    peak = np.unravel_index(np.nanargmax(z), z.shape)
    seen = seen_from(z, peak[1], peak[0], 30.0)
    keep = [n for n in np.unique(label[~np.isnan(label)]) if seen[label == n].mean() >= percent / 100]
    expected = np.where(np.isin(label, keep), label, np.nan)
    found = grid_of(visibility.visible_regions(cells, 30.0, 15.0, percent, tile_size=5), "region", z.shape)
    assert np.array_equal(found, expected, equal_nan=True)


def shortest(cost, sources, connectivity, cell):
    distance = np.full(cost.shape, np.inf)
    heap = [(0.0, s) for s in sources]
    for s in sources:
        distance[s] = 0
    while heap:
        d, (r, c) = heapq.heappop(heap)
        if d > distance[r, c]:
            continue
        for dr, dc in STEPS[connectivity]:
            a, b = r + dr, c + dc
            if 0 <= a < cost.shape[0] and 0 <= b < cost.shape[1] and not np.isnan(cost[a, b]):
                through = d + cell * math.hypot(dr, dc) / 2 * (cost[r, c] + cost[a, b])
                if through < distance[a, b]:
                    distance[a, b] = through
                    heapq.heappush(heap, (through, (a, b)))
    return np.where(np.isinf(distance), np.nan, distance)


@pytest.fixture(scope="module")
def maze():
    cost = np.random.default_rng(14).uniform(1, 9, (15, 17))
    cost[3, :14] = cost[7, 3:] = cost[11, :12] = np.nan
    cost[0, 16] = np.nan
    cost[13, 15] = np.nan
    return cost


@pytest.mark.parametrize("connectivity, block", [(4, 6), (8, 7), (8, 64)])
def test_cost_distance(spark, raster, maze, connectivity, block):
    sources = [(0, 0), (0, 16)]  # the second one is forbidden
    frame = spark.createDataFrame([(c, r) for r, c in sources], "col int, row int")
    reached = costs.cost_distance(raster(maze).withColumnRenamed("z", "cost"), frame, 2.0, connectivity, block).cache()
    expected = shortest(maze, sources[:1], connectivity, 2.0)
    assert np.array_equal(grid_of(reached, "distance", maze.shape), expected, equal_nan=True)

    ends = spark.createDataFrame([("a", 16, 14), ("b", 16, 14), ("c", 0, 0), ("d", 16, 0), ("e", 2, 13)], "destination string, col int, row int")
    path = costs.least_cost_paths(reached, ends, block)
    by_end = {}
    for r in path.orderBy("destination", "step").collect():
        by_end.setdefault(r["destination"], []).append((r["row"], r["col"]))
    assert set(by_end) == {"a", "b", "c", "e"} and by_end["c"] == [(0, 0)] and by_end["a"] == by_end["b"]
    for way in (by_end["a"], by_end["e"]):
        assert way[-1] == (0, 0)
        total = 0.0
        for here, there in zip(way[::-1], way[::-1][1:]):
            total += math.hypot(here[0] - there[0], here[1] - there[1]) * (maze[here] + maze[there])
        assert total == pytest.approx(expected[way[0]])


def test_unreachable_land_is_absent(spark, raster):
    cost = np.ones((5, 5))
    cost[:, 2] = np.nan
    start = spark.createDataFrame([(0, 0)], "col int, row int")
    found = costs.cost_distance(raster(cost).withColumnRenamed("z", "cost"), start, 1.0, 8, 2)
    assert found.count() == 10
    nowhere = spark.createDataFrame([(2, 0)], "col int, row int")
    assert costs.cost_distance(raster(cost).withColumnRenamed("z", "cost"), nowhere, 1.0, 8, 2).count() == 0


def test_cost_surface(spark):
    slopes = spark.createDataFrame(
        [(c, 0, 100.0 * c, s) for c, s in enumerate([0.0, 20.0, 50.0, 5.0, None])], "col int, row int, z double, slope double")
    found = costs.cost_surface(slopes, 0.1, max_slope=40.0, max_height=250.0).orderBy("col").collect()
    assert [r["cost"] for r in found] == [1.0, 3.0, None, None, None]

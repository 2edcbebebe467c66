import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fellwalk.functions.text import elevation_tile_name, elevation_tile_url
from fellwalk.operators import polygons


def star(rng, cx, cy, size, corners):
    """A ring around a centre whose radius changes from corner to corner: concave, not crossing itself."""
    turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(corners))
    return [(cx + size * rng.uniform(0.2, 1) * math.cos(a), cy + size * rng.uniform(0.2, 1) * math.sin(a)) for a in turns]


def frame(spark, regions):
    rows = [(name, [[(float(x), float(y)) for x, y in ring] for ring in rings]) for name, rings in regions.items()]
    return spark.createDataFrame(rows, "region string, rings array<array<struct<x:double,y:double>>>")


def sides(rings):
    return [(a, b) for ring in rings for a, b in zip(ring, ring[1:] + ring[:1]) if a != b]


def strictly_inside(rings, x, y):
    odd = False
    for (x1, y1), (x2, y2) in sides(rings):
        if min(y1, y2) <= y <= max(y1, y2):
            if y1 == y2:
                if min(x1, x2) <= x <= max(x1, x2):
                    return False
                continue
            at = x1 if y == y1 else x2 if y == y2 else min(max(x1 + (y - y1) * (x2 - x1) / (y2 - y1), min(x1, x2)), max(x1, x2))
            if at == x:
                return False
            if y < max(y1, y2) and at < x:
                odd = not odd
    return odd


@pytest.fixture(scope="module")
def regions():
    rng = random.Random(17)
    shapes = {f"s{i}": [star(rng, rng.uniform(-4, 4), rng.uniform(-4, 4), rng.uniform(0.3, 3), rng.randint(3, 11))] for i in range(25)}
    shapes["square"] = [[(-2, -2), (2, -2), (2, 2), (-2, 2)]]
    shapes["closed"] = [[(0.5, 0.5), (1.5, 0.5), (1.5, 1.5), (0.5, 0.5)]]
    shapes["holed"] = [[(-3, -3), (3, -3), (3, 3), (-3, 3)], [(-1, -1), (1, -1), (1, 1), (-1, 1)]]
    shapes["parts"] = [[(-4, 3), (-3, 3), (-3, 4)], [(3, 3), (4, 3), (4, 4)]]
    shapes["diamond"] = [[(0, -1), (1, 0), (0, 1), (-1, 0)]]
    shapes["notch"] = [[(0, 0), (4, 0), (4, 3), (2, 1), (0, 3)]]
    return shapes


def test_points_within(spark, regions):
    rng = random.Random(3)
    places = [(rng.uniform(-5, 5), rng.uniform(-5, 5)) for _ in range(400)]
    places += [(x / 2, y / 2) for x in range(-8, 9) for y in range(-8, 9)]  # many on outlines and corners
    places += [p for rings in regions.values() for ring in rings for p in ring]
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(places)], "point int, x double, y double")
    expected = {(i, name) for i, (x, y) in enumerate(places) for name, rings in regions.items() if strictly_inside(rings, x, y)}
    edges = polygons.ring_edges(frame(spark, regions))
    for size, most in ((0.25, 64), (1.0, 64), (16.0, 12)):
        found = polygons.points_within(points, edges, size, most).collect()
        assert len(found) == len(expected) and set(map(tuple, found)) == expected


def test_points_see_few_sides_of_a_fine_outline(spark):
    """A ring of 20,000 sides within one tile: a point meets at most the sides of its leaf, and the answers are exact."""
    rng = np.random.default_rng(4)
    turn = np.arange(20_000) * (2 * math.pi / 20_000)
    radius = 0.09 + 0.02 * np.sin(37 * turn) + 0.0005 * rng.random(20_000)
    ring = list(zip((0.125 + radius * np.cos(turn)).tolist(), (0.125 + radius * np.sin(turn)).tolist()))
    edges = polygons.ring_edges(frame(spark, {"fine": [ring], "wide": [[(0.01, 0.01), (0.24, 0.01), (0.24, 0.24)]]}))
    at = np.concatenate([rng.random((1500, 2)) * 0.25, np.asarray(ring[:100]), np.asarray(ring[:400]) + rng.normal(0, 2e-5, (400, 2))])
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(at.tolist())], "point int, x double, y double")
    x1, y1 = np.asarray(ring).T
    x2, y2 = np.roll(x1, -1), np.roll(y1, -1)
    expected = set()
    for i, (x, y) in enumerate(at.tolist()):
        spans = (y1 <= y) != (y2 <= y)
        cross = x1[spans] + (y - y1[spans]) * (x2[spans] - x1[spans]) / (y2[spans] - y1[spans])
        if i not in range(1500, 1600) and (cross < x).sum() % 2:
            expected.add((i, "fine"))
        if 0.01 < y < x < 0.24:
            expected.add((i, "wide"))
    assert set(map(tuple, polygons.points_within(points, edges).collect())) == expected
    met, _ = polygons.points_and_sides(points, edges)
    assert met.groupBy("point").count().agg(F.max("count")).first()[0] <= polygons.SIDES_MOST


def test_sides_over_each_other_are_followed_to_points_alone(spark, monkeypatch):
    """More equal sides than a tile takes: they are written for the tiles of points, and no lookup is sent to the driver for its file size."""
    triangle = [(0.01, 0.01), (0.23, 0.02), (0.12, 0.24)]
    shapes = {f"t{i}": [triangle] for i in range(polygons.SIDES_MOST + 6)}
    places = [(0.12, 0.1), (0.01, 0.01), (0.2, 0.2), (0.12, 0.24 - 2e-7), (5.0, 5.0)]
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(places)], "point int, x double, y double")
    written, settled = [], polygons.settled

    def counted(df, label="table"):
        table = settled(df, label)
        written.append(table.count())
        assert written[-1] < 5_000, f"{written[-1]} rows of {label}"
        return table

    monkeypatch.setattr(polygons, "settled", counted)
    monkeypatch.setattr(polygons, "LEVELS", 3)
    found = polygons.points_within(points, polygons.ring_edges(frame(spark, shapes)))
    lines = found._jdf.queryExecution().executedPlan().toString().splitlines()
    assert not [line for line in lines if "BroadcastHashJoin" in line and "Inner" in line]
    expected = {(i, name) for i, (x, y) in enumerate(places) for name, rings in shapes.items() if strictly_inside(rings, x, y)}
    rows = found.collect()
    assert len(rows) == len(expected) and set(map(tuple, rows)) == expected


@pytest.mark.parametrize("step", [0.5, 0.37])
def test_region_samples(spark, regions, step):
    expected = set()
    for name, rings in regions.items():
        xs, ys = [p[0] for r in rings for p in r], [p[1] for r in rings for p in r]
        for x in np.arange(min(xs), max(xs) + 1e-12, step):
            for y in np.arange(min(ys), max(ys) + 1e-12, step):
                if strictly_inside(rings, x, y):
                    expected.add((name, x, y))
    found = polygons.region_samples(polygons.ring_edges(frame(spark, regions)), step).collect()
    assert len(found) == len(expected) and set(map(tuple, found)) == expected


def test_sample_step_and_emptiness_are_checked(spark):
    edges = polygons.ring_edges(frame(spark, {"a": [[(0, 0), (0.1, 0), (0, 0.1)]]}))
    with pytest.raises(ValueError, match="positive"):
        polygons.region_samples(edges, 0)
    with pytest.raises(ValueError, match="no sample point"):
        polygons.region_samples(edges, 1.0, require_points=True)


def meets_box(rings, c, r):
    """Closed polygon against closed unit box: a side meets the box, or the centre is inside."""
    for (x1, y1), (x2, y2) in sides(rings):
        t0, t1, possible = 0.0, 1.0, True
        for a, d, low in ((x1, x2 - x1, c), (y1, y2 - y1, r)):
            if d == 0:
                possible = possible and low <= a <= low + 1
            else:
                near, far = sorted(((low - a) / d, (low + 1 - a) / d))
                t0, t1 = max(t0, near), min(t1, far)
        if possible and t0 <= t1:
            return True
    return strictly_inside(rings, c + 0.5, r + 0.5)


def test_tile_cover(spark, regions):
    expected = set()
    for name, rings in regions.items():
        xs, ys = [p[0] for r in rings for p in r], [p[1] for r in rings for p in r]
        for c in range(math.floor(min(xs)), math.ceil(max(xs))):
            for r in range(math.floor(min(ys)), math.ceil(max(ys))):
                if meets_box(rings, c, r):
                    expected.add((name, c, r))
    found = polygons.tile_cover(polygons.ring_edges(frame(spark, regions))).collect()
    assert len(found) == len(expected) and set(map(tuple, found)) == expected


def test_rasterised(spark, regions):
    scaled = {n: [[(4 * x + 20, 4 * y + 18) for x, y in ring] for ring in rings] for n, rings in regions.items()}
    expected = {(n, c, r) for n, rings in scaled.items() for c in range(33) for r in range(30) if strictly_inside(rings, c + 0.5, r + 0.5)}
    found = polygons.rasterised(polygons.ring_edges(frame(spark, scaled)), 33, 30).collect()
    assert len(found) == len(expected) and set(map(tuple, found)) == expected


def test_vertex_rows_give_the_same_edges(spark, regions):
    rows = [(n, i, float(x), float(y)) for n, rings in regions.items() if len(rings) == 1 for i, (x, y) in enumerate(rings[0] + rings[0][:1])]
    vertices = spark.createDataFrame(rows, "region string, seq int, x double, y double")
    whole = polygons.ring_edges(frame(spark, {n: r for n, r in regions.items() if len(r) == 1}))
    columns = ["region", *polygons.SIDES, *polygons.BOX]
    closed = polygons.vertex_edges(vertices).filter("x1 <> x2 OR y1 <> y2")
    assert sorted(closed.select(*columns).collect()) == sorted(whole.select(*columns).collect())


def test_line_cells(spark):
    lines = spark.createDataFrame([("l", 0, 0.5, 0.5, 4.5, 2.5), ("l", 1, 4.5, 2.5, 4.5, 9.5), ("m", 0, 1.2, 1.2, 1.4, 1.4)], "region string, seq int, x1 double, y1 double, x2 double, y2 double")
    found = set(map(tuple, polygons.line_cells(lines, 6, 5).collect()))
    assert found == {(0, 0), (1, 1), (2, 1), (3, 2), (4, 2), (4, 3), (4, 4)}


def test_tile_names_and_missing_tiles(spark):
    tiles = spark.createDataFrame([(26, 87), (-3, -5)], "lat int, lon int")
    tiles = tiles.withColumn("tile", elevation_tile_name(F.col("lat"), F.col("lon")))
    assert [r["tile"] for r in tiles.collect()] == ["Copernicus_DSM_COG_10_N26_00_E087_00_DEM", "Copernicus_DSM_COG_10_S03_00_W005_00_DEM"]
    coarse = tiles.select(elevation_tile_name(F.col("lat"), F.col("lon"), 90).alias("t")).select(elevation_tile_url(F.col("t"), 90)).first()[0]
    name = "Copernicus_DSM_COG_30_N26_00_E087_00_DEM"
    assert coarse == f"https://copernicus-dem-90m.s3.amazonaws.com/{name}/{name}.tif"
    present = tiles.filter("lat > 0").select("tile")
    assert [r["lat"] for r in polygons.missing_tiles(tiles, present.unionByName(present)).collect()] == [-3]


def test_zone_statistics(spark):
    slopes = spark.createDataFrame([(c, 0, float(c), 10.0 * c) for c in range(4)], "col int, row int, z double, slope double")
    zones = spark.createDataFrame([("a", 0, 0), ("a", 1, 0), ("b", 1, 0), ("b", 3, 0)], "region string, col int, row int")
    expected = [("b", 2, 2.0, 1.0, 30.0, 1), ("a", 2, 0.5, 0.25, 10.0, 2)]
    assert polygons.zone_statistics(slopes, zones).collect() == expected
    every = spark.createDataFrame([("a",), ("b",), ("no cell",)], "region string")
    assert polygons.zone_statistics(slopes, zones, every).collect() == [*expected, ("no cell", 0, None, None, None, 3)]


def test_zone_cells_are_not_broadcast_for_the_size_of_their_outlines(spark):
    """A few sides become many cells; regions that overlap count each cell for themselves."""
    side = 40
    height = lambda c, r: float((c * 7 + r * 3) % 11)
    slopes = spark.createDataFrame([(c, r, height(c, r), float(c + r)) for c in range(side) for r in range(side)], "col int, row int, z double, slope double")
    boxes = {"a": (2.0, 3.0, 30.0, 35.0), "b": (2.0, 3.0, 30.0, 35.0), "c": (10.0, 0.0, 40.0, 12.0)}
    zones = polygons.rasterised(polygons.ring_edges(frame(spark, {n: [[(x1, y1), (x2, y1), (x2, y2), (x1, y2)]] for n, (x1, y1, x2, y2) in boxes.items()})), side, side)
    found = polygons.zone_statistics(slopes, zones)
    rows = {r["region"]: r for r in found.collect()}
    lines = found._jdf.queryExecution().executedPlan().toString().splitlines()
    assert not [line for line in lines if "BroadcastHashJoin" in line]
    for name, (x1, y1, x2, y2) in boxes.items():
        z = [height(c, r) for c in range(int(x1), int(x2)) for r in range(int(y1), int(y2))]
        assert rows[name]["n"] == len(z) and rows[name]["max_slope"] == x2 + y2 - 2
        assert rows[name]["mean_z"] == pytest.approx(np.mean(z)) and rows[name]["var_z"] == pytest.approx(np.var(z))
    assert rows["a"]["rank"] == rows["b"]["rank"]


def test_regions_of_the_same_cells_share_a_rank(spark):
    """Large heights whose squares differ in the last bits: the order in which cells arrive is not to show in the ninth place."""
    rng = np.random.default_rng(7)
    heights = {(c, r): float(z) for (c, r), z in zip([(c, r) for c in range(12) for r in range(9)], rng.random(108) * 1e6)}
    slopes = spark.createDataFrame([(c, r, None if (c, r) == (3, 3) else z, 1.0) for (c, r), z in heights.items()], "col int, row int, z double, slope double")
    rows = [(f"r{k}", *cell) for k in range(40) for cell in rng.permutation(list(heights)).tolist()] + [("one", 4, 4), ("none", 3, 3)]
    zones = spark.createDataFrame(rng.permutation(np.array(rows, dtype=object)).tolist(), "region string, col int, row int").repartition(7)
    found = {r["region"]: r for r in polygons.zone_statistics(slopes, zones).collect()}
    z = [z for cell, z in heights.items() if cell != (3, 3)]
    same = [found[f"r{k}"] for k in range(40)]
    assert {(r["n"], r["rank"], r["var_z"]) for r in same} == {(107, 1, same[0]["var_z"])}
    assert same[0]["mean_z"] == pytest.approx(np.mean(z), rel=1e-12) and same[0]["var_z"] == pytest.approx(np.var(z), rel=1e-12)
    assert found["one"][1:] == (1, heights[4, 4], 0.0, 1.0, 41) and found["none"][1:] == (0, None, None, 1.0, 42)

"""Registered queries: region bounds, tile cover, samples, distortion, zones of a layer, lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fellwalk.functions import projections as proj
from fellwalk.functions.text import elevation_tile_name, elevation_tile_url
from fellwalk.operators import distortion, layers, polygons, terrain
from fellwalk.plans import projection_sql as ps
from fellwalk.plans import tables as t
from fellwalk.plans.raster import CELL, TERRAIN
from fellwalk.plans.registry import job, rounded
from fellwalk.sources import files
from fellwalk.sources.regions import parse_regions, read_regions
from fellwalk.workspace import fresh_path

# A concave ring around the origin, in units of the region's size.
ARROW = ((0.0, 0.0), (2.0, 0.3), (1.2, 1.0), (1.6, 2.0), (0.5, 1.5))
_ARROW_SQL = ", ".join(f"({i}, {x}::DOUBLE, {y}::DOUBLE)" for i, (x, y) in enumerate(ARROW))
_EDGES_SQL = """SELECT a.region, a.seq, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
FROM {0} a JOIN {0} b ON a.region = b.region AND b.seq = (a.seq + 1) % 5"""


def _rings(df: DataFrame, x0, y0, size) -> DataFrame:
    points = F.array(*[F.struct((x0 + size * px).alias("x"), (y0 + size * py).alias("y")) for px, py in ARROW])
    return df.select("region", F.array(points).alias("rings"))


def _rings_sql(table: str, key: str, x0: str, y0: str, size: str) -> str:
    return f"""SELECT {key} AS region, seq, {x0} + {size} * px AS x, {y0} + {size} * py AS y
FROM {table}, (VALUES {_ARROW_SQL}) o(seq, px, py)"""


# One region per customer, all over the earth, and one per supplier in a mountain strip.
def world_regions(spark, d) -> DataFrame:
    key = F.col("region")
    rows = t.table(spark, d, "customer").select(F.col("c_custkey").alias("region"))
    return _rings(
        rows, F.lit(-170.013) + (key * 37 % 3400) / 10.0, F.lit(-60.013) + (key * 53 % 1200) / 10.0, F.lit(0.4) + (key % 6) * 0.3
    )


WORLD_SQL = _rings_sql(
    "customer", "c_custkey", "-170.013::DOUBLE + (c_custkey * 37 % 3400) / 10.0::DOUBLE",
    "-60.013::DOUBLE + (c_custkey * 53 % 1200) / 10.0::DOUBLE", "(0.4::DOUBLE + (c_custkey % 6) * 0.3::DOUBLE)",
)


def strip_regions(spark, d) -> DataFrame:
    key = F.col("region")
    rows = t.table(spark, d, "supplier").select(F.col("s_suppkey").alias("region"))
    return _rings(
        rows, F.lit(76.013) + (key * 37 % 170) / 10.0, F.lit(27.013) + (key * 53 % 50) / 10.0, F.lit(0.2) + (key % 5) * 0.1
    )


STRIP_SQL = _rings_sql(
    "supplier", "s_suppkey", "76.013::DOUBLE + (s_suppkey * 37 % 170) / 10.0::DOUBLE",
    "27.013::DOUBLE + (s_suppkey * 53 % 50) / 10.0::DOUBLE", "(0.2::DOUBLE + (s_suppkey % 5) * 0.1::DOUBLE)",
)
WORLD = {"ring": WORLD_SQL, "edges": _EDGES_SQL.format("ring")}
STRIP = {"ring": STRIP_SQL, "edges": _EDGES_SQL.format("ring")}


def _as_geojson(regions: DataFrame) -> DataFrame:
    """One GeoJSON document per region, with a closed ring."""
    closed = lambda ring: F.concat(ring, F.slice(ring, 1, 1))
    pairs = lambda ring: F.transform(closed(ring), lambda p: F.array(p["x"], p["y"]))
    coordinates = F.to_json(F.transform("rings", pairs))
    head = '{"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:OGC:1.3:CRS84"}}, '
    body = '"features": [{"type": "Feature", "properties": {}, "geometry": {"type": "Polygon", "coordinates": '
    return regions.select(F.col("region").alias("document"), F.concat(F.lit(head + body), coordinates, F.lit("}}]}")).alias("value"))


@job(
    "region_bounds",
    t.with_views(
        """SELECT region, round(min(x), 6) AS xmin, round(min(y), 6) AS ymin, round(max(x), 6) AS xmax, round(max(y), 6) AS ymax
FROM ring GROUP BY 1""",
        extra=WORLD,
    ),
)
def region_bounds(spark, d):
    """Bounds of regions that were written as GeoJSON text and parsed again."""
    parsed = parse_regions(_as_geojson(world_regions(spark, d)), on_missing_crs="error")
    edges = polygons.ring_edges(parsed.select(F.col("document").alias("region"), "rings"))
    return rounded(polygons.bounds(edges, "region"))


@job(
    "layer_bounds",
    t.with_views(
        "SELECT round(min(x), 6) AS xmin, round(min(y), 6) AS ymin, round(max(x), 6) AS xmax, round(max(y), 6) AS ymax FROM ring", extra=WORLD
    ),
)
def layer_bounds(spark, d):
    return rounded(polygons.bounds(polygons.ring_edges(world_regions(spark, d))))


# a side meets a box if the part of it within the box's columns and rows is not empty
_COVER = {
    **WORLD,
    "box": "SELECT region, min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1 FROM ring GROUP BY 1",
    "tiles": """SELECT region, lon.i::INT AS lon, lat.i::INT AS lat FROM box, range(-181, 181) lon(i), range(-91, 91) lat(i)
WHERE lon.i >= floor(x0) AND lon.i < ceil(x1) AND lat.i >= floor(y0) AND lat.i < ceil(y1)""",
    "spans": """SELECT region, lon, lat, x1, y1, x2, y2,
  least((lon - x1) / nullif(x2 - x1, 0), (lon + 1 - x1) / nullif(x2 - x1, 0)) AS xa, greatest((lon - x1) / nullif(x2 - x1, 0), (lon + 1 - x1) / nullif(x2 - x1, 0)) AS xb,
  least((lat - y1) / nullif(y2 - y1, 0), (lat + 1 - y1) / nullif(y2 - y1, 0)) AS ya, greatest((lat - y1) / nullif(y2 - y1, 0), (lat + 1 - y1) / nullif(y2 - y1, 0)) AS yb
FROM tiles JOIN edges USING (region)""",
    "cover": """SELECT region, lon, lat FROM spans GROUP BY ALL
HAVING bool_or((x1 <> x2 OR x1 BETWEEN lon AND lon + 1) AND (y1 <> y2 OR y1 BETWEEN lat AND lat + 1)
    AND greatest(0, coalesce(xa, 0), coalesce(ya, 0)) <= least(1, coalesce(xb, 1), coalesce(yb, 1)))
  OR count(*) FILTER ((y1 <= lat + 0.5) <> (y2 <= lat + 0.5) AND x1 + (lat + 0.5 - y1) * (x2 - x1) / (y2 - y1) < lon + 0.5) % 2 = 1""",
    "named": """SELECT *, 'Copernicus_DSM_COG_10_' || printf('%s%02d_00', CASE WHEN lat >= 0 THEN 'N' ELSE 'S' END, abs(lat)) || '_'
  || printf('%s%03d_00', CASE WHEN lon >= 0 THEN 'E' ELSE 'W' END, abs(lon)) || '_DEM' AS tile FROM cover""",
}


def _named_cover(spark, d):
    cover = polygons.tile_cover(polygons.ring_edges(world_regions(spark, d)))
    return cover.withColumn("tile", elevation_tile_name(F.col("lat"), F.col("lon")))


@job(
    "tile_cover",
    t.with_views(
        "SELECT region, lon, lat, tile, 'https://copernicus-dem-30m.s3.amazonaws.com/' || tile || '/' || tile || '.tif' AS url FROM named",
        extra=_COVER,
    ),
)
def tile_cover(spark, d):
    return _named_cover(spark, d).withColumn("url", elevation_tile_url(F.col("tile")))


@job(
    "tiles_missing",
    t.with_views(
        """SELECT DISTINCT tile, lon, lat FROM named WHERE tile NOT IN (
  SELECT tile FROM named JOIN customer ON region = c_custkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))""",
        extra=_COVER,
    ),
)
def tiles_missing(spark, d):
    """Tiles still wanted when the regions of two market segments are already present."""
    cover = _named_cover(spark, d)
    owners = t.table(spark, d, "customer").filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    present = cover.join(owners.select(F.col("c_custkey").alias("region")), "region", "left_semi").select("tile")
    return polygons.missing_tiles(cover.select("tile", "lon", "lat").dropDuplicates(), present)


@job("tile_features", t.with_views("SELECT DISTINCT tile, lon::DOUBLE AS xmin, lat::DOUBLE AS ymin, lon + 1::DOUBLE AS xmax, lat + 1::DOUBLE AS ymax FROM named", extra=_COVER))
def tile_features(spark, d):
    """The covering tiles written as GeoJSON features and read back: name and bounds."""
    tiles, path = _named_cover(spark, d).select("tile", "lon", "lat").dropDuplicates(), fresh_path(spark, "features")
    files.write_features(polygons.tile_rings(tiles), path, ["tile"], "ring")
    shape = "properties struct<tile:string>, geometry struct<coordinates:array<array<array<double>>>>"
    ring = F.col("f.geometry.coordinates")[0]
    along = lambda axis: F.transform(ring, lambda p: p[axis])
    return spark.read.text(path).select(F.from_json("value", shape).alias("f")).select(
        "f.properties.tile", F.array_min(along(0)).alias("xmin"), F.array_min(along(1)).alias("ymin"), F.array_max(along(0)).alias("xmax"), F.array_max(along(1)).alias("ymax"))


STEP = 0.05
_SAMPLES = {
    **STRIP,
    "box": f"""SELECT region, x0, y0, (x0 + {STEP}::DOUBLE) - x0 AS dx, (y0 + {STEP}::DOUBLE) - y0 AS dy,
  ceil((x1 + 1e-12 - x0) / {STEP}::DOUBLE) AS nx, ceil((y1 + 1e-12 - y0) / {STEP}::DOUBLE) AS ny
FROM (SELECT region, min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1 FROM ring GROUP BY 1)""",
    "grid": """SELECT region, i.i AS i, j.j AS j, x0 + i.i * dx AS lon, y0 + j.j * dy AS lat
FROM box, (SELECT unnest(range(0, max(nx)::BIGINT)) AS i FROM box) i, (SELECT unnest(range(0, max(ny)::BIGINT)) AS j FROM box) j
WHERE i.i < nx AND j.j < ny""",
    "samples": """SELECT region, lon, lat FROM grid JOIN edges USING (region) GROUP BY region, i, j, lon, lat
HAVING count(*) FILTER ((y1 <= lat) <> (y2 <= lat) AND x1 + (lat - y1) * (x2 - x1) / (y2 - y1) < lon) % 2 = 1
  AND NOT bool_or(coalesce(lat BETWEEN least(y1, y2) AND greatest(y1, y2) AND lon BETWEEN least(x1, x2) AND greatest(x1, x2)
    AND (y1 = y2 OR x1 + (lat - y1) * (x2 - x1) / (y2 - y1) = lon), false))""",
}


def _samples(spark, d):
    return polygons.region_samples(polygons.ring_edges(strip_regions(spark, d)), STEP)


@job("region_samples", t.with_views("SELECT region, round(lon, 6) AS lon, round(lat, 6) AS lat FROM samples", extra=_SAMPLES))
def region_samples(spark, d):
    return rounded(_samples(spark, d))


@job(
    "region_sample_counts",
    t.with_views(
        """SELECT region, CAST(any_value(nx * ny) AS BIGINT) AS candidates, count(s.lon) AS inside FROM box LEFT JOIN samples s USING (region) GROUP BY 1""",
        extra=_SAMPLES,
    ),
)
def region_sample_counts(spark, d):
    return polygons.sample_counts(polygons.ring_edges(strip_regions(spark, d)), STEP)


WIDE_STEP = 0.1
_UNITED = {
    **STRIP,
    "box": f"""SELECT doc, x0, y0, (x0 + {WIDE_STEP}::DOUBLE) - x0 AS dx, (y0 + {WIDE_STEP}::DOUBLE) - y0 AS dy,
  ceil((x1 + 1e-12 - x0) / {WIDE_STEP}::DOUBLE) AS nx, ceil((y1 + 1e-12 - y0) / {WIDE_STEP}::DOUBLE) AS ny
FROM (SELECT region // 8 AS doc, min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1 FROM ring GROUP BY 1)""",
    "grid": """SELECT doc, i.i AS i, j.j AS j, x0 + i.i * dx AS lon, y0 + j.j * dy AS lat
FROM box, (SELECT unnest(range(0, max(nx)::BIGINT)) AS i FROM box) i, (SELECT unnest(range(0, max(ny)::BIGINT)) AS j FROM box) j
WHERE i.i < nx AND j.j < ny""",
    "samples": _SAMPLES["samples"].replace("SELECT region, lon, lat FROM grid JOIN edges USING (region) GROUP BY region, i, j, lon, lat",
                                           "SELECT DISTINCT doc, lon, lat FROM grid JOIN edges ON region // 8 = doc GROUP BY doc, region, i, j, lon, lat"),
}


@job("file_region_samples", t.with_views("SELECT doc, round(lon, 6) AS lon, round(lat, 6) AS lat FROM samples", extra=_UNITED))
def file_region_samples(spark, d):
    """Sample points of region files of up to eight features that overlap: written, read back, and taken as one region each."""
    closed = lambda ring: F.concat(ring, F.slice(ring, 1, 1))
    pairs = lambda ring: F.transform(closed(ring), lambda p: F.array(p["x"], p["y"]))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Polygon").alias("type"), F.transform("rings", pairs).alias("coordinates")).alias("geometry"),
    )
    doc = F.floor(F.col("region") / 8).cast("bigint").alias("doc")
    named = F.struct(F.struct(F.lit("EPSG:4326").alias("name")).alias("properties")).alias("crs")
    collected = strip_regions(spark, d).groupBy(doc).agg(F.collect_list(feature).alias("features"))
    text = F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), named, "features"))
    path = fresh_path(spark, "regions")
    collected.select("doc", text.alias("value")).write.partitionBy("doc").text(path)
    found = polygons.united_samples(read_regions(spark, f"{path}/*/*.txt", on_missing_crs="error"), WIDE_STEP)
    return rounded(found.select(F.regexp_extract("document", "doc=([0-9]+)/", 1).cast("bigint").alias("doc"), "lon", "lat"))


_PLACE = {
    "place": """SELECT o_orderkey AS point, 76.0::DOUBLE + (o_orderkey * 7919 % 18000) / 1000.0::DOUBLE AS x,
  27.0::DOUBLE + (o_orderkey * 104729 % 6000) / 1000.0::DOUBLE AS y FROM orders"""
}


def _places(spark, d):
    key = F.col("o_orderkey")
    return t.table(spark, d, "orders").select(
        key.alias("point"),
        (F.lit(76.0) + (key * 7919 % 18000) / 1000.0).alias("x"),
        (F.lit(27.0) + (key * 104729 % 6000) / 1000.0).alias("y"),
    )


@job(
    "points_in_regions",
    t.with_views(
        """SELECT point, region FROM place JOIN edges ON y BETWEEN least(y1, y2) AND greatest(y1, y2) GROUP BY point, region
HAVING count(*) FILTER ((y1 <= y) <> (y2 <= y) AND x1 + (y - y1) * (x2 - x1) / (y2 - y1) < x) % 2 = 1
  AND NOT bool_or(coalesce(x BETWEEN least(x1, x2) AND greatest(x1, x2) AND (y1 = y2 OR x1 + (y - y1) * (x2 - x1) / (y2 - y1) = x), false))""",
        extra={**STRIP, **_PLACE},
    ),
)
def points_in_regions(spark, d):
    return polygons.points_within(_places(spark, d), polygons.ring_edges(strip_regions(spark, d)))


LCC = proj.LambertConformalConic(28.0, 32.0, 30.0, 85.0)
OMERC = proj.ObliqueMercator(75.0, 32.0, 95.0, 28.0, 0.9996)
UTM45 = proj.TransverseMercator.utm(45)
ALBERS = proj.AlbersEqualArea(28.0, 32.0, 30.0, 85.0)
PROJECTIONS = {"lcc": LCC, "omerc": OMERC, "utm45": UTM45, "albers": ALBERS}
_SCALED = {
    **_SAMPLES,
    "scaled": f"""SELECT *, CASE projection WHEN 'albers' THEN 1 / k ELSE k END AS h FROM (
  SELECT region, lon, lat, unnest(['lcc', 'omerc', 'utm45', 'albers']) AS projection,
    unnest([{ps.lcc_scale(LCC)}, {ps.omerc_scale(OMERC)}, {ps.tm_scale()}, {ps.albers_scale(ALBERS)}]) AS k
  FROM ({ps.tm_sphere('SELECT * FROM samples', '87')}))""",
    "factors": """SELECT region, lon, lat, projection, h AS k_mer, k AS k_par, sqrt(h * k) AS k_dist, greatest(h, k) / least(h, k) AS anisotropy,
  degrees(2 * asin(abs(h - k) / (h + k))) AS angular_distortion, h * k AS k_areal FROM scaled""",
}


@job(
    "point_distortion",
    t.with_views(
        """SELECT region, round(lon, 6) AS lon, round(lat, 6) AS lat, projection, round(k_mer, 6) AS k_mer, round(k_par, 6) AS k_par,
  round(k_dist, 6) AS k_dist, round(anisotropy, 6) AS anisotropy, round(angular_distortion, 6) AS angular_distortion, round(k_areal, 6) AS k_areal
FROM factors""",
        extra=_SCALED,
    ),
)
def point_distortion(spark, d):
    return rounded(distortion.distortion(_samples(spark, d), PROJECTIONS))


_QUANTILES = """round(min({0}), 6) AS min, round(quantile_cont({0}, 0.5), 6) AS p50, round(quantile_cont({0}, 0.95), 6) AS p95,
  round(quantile_cont({0}, 0.99), 6) AS p99, round(max({0}), 6) AS max, round(max(abs({0} - 1)) * 100, 6) AS max_abs_pct"""
_UNSCALED = _QUANTILES.replace("round(max(abs({0} - 1)) * 100, 6) AS max_abs_pct", "NULL::DOUBLE AS max_abs_pct")


@job(
    "crs_distortion",
    t.with_views(
        " UNION ALL ".join(
            f"SELECT projection, '{n}' AS metric, {_QUANTILES.format(n) if n.startswith('k') else _UNSCALED.format(n)} FROM factors GROUP BY 1" for n in proj.FACTORS
        ),
        extra=_SCALED,
    ),
)
def crs_distortion(spark, d):
    return rounded(distortion.distortion_summary(_samples(spark, d), PROJECTIONS))


_OWN = """SELECT *, (floor((lon + 180) / 6)::INT % 60) * 6.0::DOUBLE - 177 AS lon0, (floor((lon + 180) / 6)::INT % 60 + 1) AS zone,
  CASE WHEN lat >= 0 THEN 0.0::DOUBLE ELSE 1e7 END AS south FROM (SELECT region, (min(x) + max(x)) / 2 AS lon, (min(y) + max(y)) / 2 AS lat FROM ring GROUP BY 1)"""
_OWN_XY = ps.tm_xy("south")


@job(
    "utm_zone",
    t.with_views(
        f"""SELECT region, zone, (CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END + zone)::INT AS epsg, round({_OWN_XY[0]}, 4) AS easting,
  round({_OWN_XY[1]}, 4) AS northing FROM ({ps.tm_sphere(_OWN, 'lon0')})""",
        extra=WORLD,
    ),
)
def utm_zone(spark, d):
    """UTM zone and coordinates of the centre of every region's extent, each in its own zone."""
    along = lambda axis: F.transform(F.flatten("rings"), lambda p: p[axis])
    middle = lambda axis: (F.array_min(along(axis)) + F.array_max(along(axis))) / 2
    corner = world_regions(spark, d).select("region", middle("x").alias("lon"), middle("y").alias("lat"))
    lon, lat = F.col("lon"), F.col("lat")
    easting, northing = proj.own_utm(lon, lat).forward(lon, lat)
    placed = corner.select(
        "region", proj.utm_zone(lon).alias("zone"), proj.utm_epsg(lon, lat).alias("epsg"), easting.alias("easting"), northing.alias("northing")
    )
    return rounded(placed, 4)


# --- regions and lines on the raster -----------------------------------------------------

_SIDE_SQL = "(SELECT (max(col) + 1)::DOUBLE AS w FROM dem_v)"
_FIELD_SQL = f"""SELECT s_suppkey AS region, seq, w * ((s_suppkey * 37 % 100) * 0.009::DOUBLE) + 0.137::DOUBLE + (1.5::DOUBLE + (s_suppkey % 4) * 1.25::DOUBLE) * px AS x,
  w * ((s_suppkey * 61 % 100) * 0.009::DOUBLE) + 0.137::DOUBLE + (1.5::DOUBLE + (s_suppkey % 4) * 1.25::DOUBLE) * py AS y
FROM supplier, {_SIDE_SQL}, (VALUES {_ARROW_SQL}) o(seq, px, py)"""
FIELDS = {"ring": _FIELD_SQL, "edges": _EDGES_SQL.format("ring")}


def field_edges(spark, d, side: int) -> DataFrame:
    """One region per supplier on the elevation layer, in cells."""
    key = F.col("region")
    rows = t.table(spark, d, "supplier").select(F.col("s_suppkey").alias("region"))
    at = lambda factor: F.lit(float(side)) * ((key * factor % 100) * 0.009) + 0.137
    return polygons.ring_edges(_rings(rows, at(37), at(61), F.lit(1.5) + (key % 4) * 1.25))


_RASTERISED = {
    **FIELDS,
    "zone_cells": """SELECT region, col, row FROM dem_v JOIN edges ON (y1 <= row + 0.5) <> (y2 <= row + 0.5)
GROUP BY ALL HAVING count(*) FILTER (x1 + (row + 0.5 - y1) * (x2 - x1) / (y2 - y1) < col + 0.5) % 2 = 1""",
}


@job("rasterised_regions", t.with_views("SELECT * FROM zone_cells", "dem_v", extra=_RASTERISED))
def rasterised_regions(spark, d):
    shape = layers.shape_of(t.dem(spark, d))
    return polygons.rasterised(field_edges(spark, d, shape.cols), shape.cols, shape.rows)


@job(
    "zone_statistics",
    t.with_views(
        """SELECT * EXCLUDE v, rank() OVER (ORDER BY v DESC NULLS LAST)::INT AS rank FROM (
  SELECT s_suppkey AS region, count(z) AS n, round(avg(z), 6) AS mean_z, round(var_pop(z), 6) AS var_z, round(max(slope), 6) AS max_slope,
    round(var_pop(z), 9) AS v FROM supplier LEFT JOIN zone_cells ON region = s_suppkey LEFT JOIN dem_v USING (col, row) LEFT JOIN slope_v USING (col, row) GROUP BY 1)""",
        "dem_v",
        extra={**TERRAIN, **_RASTERISED},
    ),
)
def zone_statistics(spark, d):
    cells = t.dem(spark, d)
    shape = layers.shape_of(cells)
    zones = polygons.rasterised(field_edges(spark, d, shape.cols), shape.cols, shape.rows)
    every = t.table(spark, d, "supplier").select(F.col("s_suppkey").alias("region"))
    return rounded(polygons.zone_statistics(terrain.slope(cells, CELL, with_height=True), zones, every))


@job(
    "road_cells",
    t.with_views(
        """SELECT DISTINCT c + floor((2.0::DOUBLE * dc * k.k + m) / (2.0::DOUBLE * m))::INT AS col, r + floor((2.0::DOUBLE * dr * k.k + m) / (2.0::DOUBLE * m))::INT AS row
FROM (SELECT floor(x1)::INT AS c, floor(y1)::INT AS r, floor(x2)::INT - floor(x1)::INT AS dc, floor(y2)::INT - floor(y1)::INT AS dr,
    greatest(abs(floor(x2)::INT - floor(x1)::INT), abs(floor(y2)::INT - floor(y1)::INT)) AS n, greatest(n, 1) AS m FROM edges),
  (SELECT unnest(range(0, max(greatest(abs(floor(x2) - floor(x1)), abs(floor(y2) - floor(y1))))::BIGINT + 1)) AS k FROM edges) k,
  (SELECT max(col) AS w, max(row) AS d FROM dem_v)
WHERE k.k <= n AND c + floor((2.0::DOUBLE * dc * k.k + m) / (2.0::DOUBLE * m)) BETWEEN 0 AND w
  AND r + floor((2.0::DOUBLE * dr * k.k + m) / (2.0::DOUBLE * m)) BETWEEN 0 AND d""",
        "dem_v",
        extra=FIELDS,
    ),
)
def road_cells(spark, d):
    """Cells of the layer under the outlines of all regions, taken as lines."""
    shape = layers.shape_of(t.dem(spark, d))
    return polygons.line_cells(field_edges(spark, d, shape.cols), shape.cols, shape.rows)

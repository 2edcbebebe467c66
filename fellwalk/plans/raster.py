"""Registered queries: tile keys, layers, terrain, surfaces, zones, regions, viewshed, costs."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from fellwalk.functions.projections import TransverseMercator
from fellwalk.operators import costs, layers, regions, resampling, surfaces, terrain, tilekeys, visibility, warping, zonal
from fellwalk.plans import projection_sql as ps
from fellwalk.plans import tables as t
from fellwalk.plans.registry import job, rounded
from fellwalk.sources import files, grids
from fellwalk.workspace import fresh_path, settled

CELL = 30.0

# --- tile keys ---------------------------------------------------------------------------

_HEX = "'0x' || lpad(lower(to_hex(CAST({0} AS BIGINT) & 4294967295)), 8, '0')"


@job(
    "tile_key_format",
    t.with_views(
        f"""SELECT col, row, zoom, zoom || 'z/' || col || 'c/' || row || 'r' AS short, i AS index, 'id:' || i AS id, zoom AS zoom_or_none
FROM (SELECT *, {_HEX.format('col')} || '-' || {_HEX.format('row')} || '-' || {_HEX.format('zoom')} AS i FROM keys_v)""",
        "keys_v",
    ),
)
def tile_key_format(spark, d):
    return tilekeys.formatted_keys(t.tile_keys(spark, d))


_NEIGHBOURS_SQL = """SELECT k.col AS from_col, k.row AS from_row, k.col + o.dc AS col, k.row + o.dr AS row, zoom
FROM keys_v k, (SELECT dc::INT AS dc, dr::INT AS dr FROM range(-1, 2) a(dc), range(-1, 2) b(dr)) o WHERE {0}"""


@job("tile_neighbors", t.with_views(_NEIGHBOURS_SQL.format("abs(dc) + abs(dr) = 1"), "keys_v"))
def tile_neighbors(spark, d):
    return tilekeys.neighbours(t.tile_keys(spark, d), "plus")


@job("tile_neighbors_box", t.with_views(_NEIGHBOURS_SQL.format("abs(dc) + abs(dr) > 0"), "keys_v"))
def tile_neighbors_box(spark, d):
    return tilekeys.neighbours(t.tile_keys(spark, d), "box")


@job(
    "tile_offset",
    t.with_views("SELECT col + 3 AS col, row + 4 AS row, zoom, zoom = 3 AS at_zoom FROM keys_v", "keys_v"),
)
def tile_offset(spark, d):
    moved = tilekeys.shifted(t.tile_keys(spark, d), 3, 4)
    return moved.withColumn("at_zoom", tilekeys.same_zoom(F.col("zoom"), F.lit(3)))


@job(
    "occupancy_grid",
    t.with_views(
        """SELECT r.r::INT AS row, string_agg(CASE WHEN k.col IS NULL THEN '□' ELSE '■' END, '' ORDER BY c.c) AS picture
FROM b CROSS JOIN (SELECT unnest(range(0, r1 - r0 + 1)) AS r FROM b) r CROSS JOIN (SELECT unnest(range(0, c1 - c0 + 1)) AS c FROM b) c
LEFT JOIN (SELECT DISTINCT col, row FROM keys_v) k ON k.col = c.c + c0 AND k.row = r.r + r0 GROUP BY 1""",
        "keys_v",
        extra={"b": "SELECT min(col) AS c0, max(col) AS c1, min(row) AS r0, max(row) AS r1 FROM keys_v"},
    ),
)
def occupancy_grid(spark, d):
    return tilekeys.occupancy_picture(t.tile_keys(spark, d))


# --- layers ------------------------------------------------------------------------------

ORIGIN = layers.Georeference(86.9, 28.03, 1 / 3600, 1 / 3600, "EPSG:4326")
PIECE = 64



def _boxed(source: str) -> str:
    """A tile holds every cell of its box; cells that the layer lacks are without data."""
    return f"""(SELECT c AS col, r AS row, z FROM (SELECT *, unnest(range(r0, r1 + 1)) AS r FROM (SELECT *, unnest(range(c0, c1 + 1)) AS c FROM (
  SELECT min(col) AS c0, max(col) AS c1, min(row) AS r0, max(row) AS r1 FROM {source} GROUP BY col // {PIECE}, row // {PIECE})))
LEFT JOIN (SELECT col AS c, row AS r, z FROM {source}) USING (c, r))"""


_TILES_SQL = f"""SELECT (col // {PIECE})::INT AS tile_col, (row // {PIECE})::INT AS tile_row,
  (max(col) - min(col) + 1)::INT AS cols, (max(row) - min(row) + 1)::INT AS rows, count(z) AS data_cells,
  86.9::DOUBLE + min(col) * {ps.num(1 / 3600)} AS xmin, 28.03::DOUBLE - min(row) * {ps.num(1 / 3600)} AS ymax,
  md5(string_agg(coalesce(CAST(round(z * 1000)::BIGINT AS VARCHAR), 'NA'), ',' ORDER BY row, col)) AS cells_md5
FROM {_boxed('dem_v')} GROUP BY 1, 2"""


def _tiles(spark, d):
    return layers.to_tiles(t.dem(spark, d), ORIGIN, PIECE)


@job("dem_tiles", t.with_views("SELECT * REPLACE (round(xmin, 6) AS xmin, round(ymax, 6) AS ymax) FROM tiles", "dem_v", extra={"tiles": _TILES_SQL}))
def dem_tiles(spark, d):
    text = F.transform("cells", lambda z: F.coalesce(F.round(z * 1000).cast("bigint").cast("string"), F.lit("NA")))
    return rounded(
        _tiles(spark, d).select(
            "tile_col", "tile_row", "cols", "rows",
            F.size(F.filter("cells", lambda z: z.isNotNull())).cast("bigint").alias("data_cells"),
            "extent.xmin", "extent.ymax",
            F.md5(F.array_join(text, ",").cast("binary")).alias("cells_md5"),
        )
    )


@job("dem_cells", t.with_views(f"SELECT col::INT AS col, row::INT AS row, round(z, 6) AS z FROM {_boxed('dem_v')}", "dem_v"))
def dem_cells(spark, d):
    """The cell table recovered from the tiles by their extents; absent cells of a tile come back without data."""
    return rounded(layers.pieces_to_cells(_tiles(spark, d)))


@job(
    "layer_metadata",
    t.with_views(
        f"""SELECT count(*) AS tiles, 'EPSG:4326' AS crs, round(min(xmin), 6) AS xmin, round(min(ymax - rows * {ps.num(1 / 3600)}), 6) AS ymin,
  round(max(xmin + cols * {ps.num(1 / 3600)}), 6) AS xmax, round(max(ymax), 6) AS ymax, round({ps.num(1 / 3600)}, 6) AS cell_width,
  round({ps.num(1 / 3600)}, 6) AS cell_height, min(tile_col) AS min_tile_col, max(tile_col) AS max_tile_col,
  min(tile_row) AS min_tile_row, max(tile_row) AS max_tile_row, CAST(sum(cols * rows) AS BIGINT) AS cells,
  arg_min(tile_col, (tile_row, tile_col)) AS first_tile_col, arg_min(tile_row, (tile_row, tile_col)) AS first_tile_row FROM tiles""",
        "dem_v",
        extra={"tiles": _TILES_SQL},
    ),
)
def layer_metadata(spark, d):
    return rounded(layers.layer_metadata(_tiles(spark, d)))


@job("window_sample", t.with_views("SELECT col, row, round(z, 6) AS z FROM dem_v WHERE col BETWEEN 5 AND 20 AND row BETWEEN 3 AND 12", "dem_v"))
def window_sample(spark, d):
    """A window of the layer: sampling by key range is the feature."""
    return rounded(layers.window_cells(t.dem(spark, d), (5, 20), (3, 12)))


def _grid(spark, d):
    """The raster of all orders written as a banded grid with its cell numbers as a second band, and opened."""
    path = fresh_path(spark, "grid")
    grids.write_grid(t.dem(spark, d).withColumn("number", (F.col("row") * 1000 + F.col("col")).cast("double")), path, ["z", "number"])
    return grids.read_grid(spark, path)


@job("grid_cells", t.with_views(f"SELECT col::INT AS col, row::INT AS row, round(z, 6) AS z FROM {_boxed('dem_v')}", "dem_v"))
def grid_cells(spark, d):
    """One band of a raster file, all windows of it."""
    return rounded(_grid(spark, d).filter("band = 0").select("col", "row", "z"))


@job(
    "grid_window",
    t.with_views(
        """SELECT b.band, col, row, CASE b.band WHEN 0 THEN round(z, 6) ELSE row * 1000.0::DOUBLE + col END AS z
FROM dem_v, (VALUES (0), (1)) b(band) WHERE col BETWEEN 5 AND 30 AND row >= 7 AND row < 19""",
        "dem_v",
    ),
)
def grid_window(spark, d):
    """A window of a raster file in both bands: only its rows and columns are read."""
    return rounded(_grid(spark, d).filter("col BETWEEN 5 AND 30 AND row >= 7 AND row < 19"))


SMALL = 8


@job("layer_window", t.with_views("SELECT col, row, round(z, 6) AS z FROM dem_v WHERE col BETWEEN 5 AND 20 AND row BETWEEN 3 AND 12", "dem_v"))
def layer_window(spark, d):
    """The same window from a layer in a catalog folder: files without a tile of it are not opened."""
    path = fresh_path(spark, "layer")
    files.write_layer(layers.to_tiles(t.dem(spark, d), ORIGIN, SMALL).withColumn("zoom", F.lit(0)), path)
    tiles = files.read_layer(spark, path, 0, (5 // SMALL, 20 // SMALL), (3 // SMALL, 12 // SMALL))
    opened = tiles.select("tile_col", "tile_row", "cols", F.posexplode("cells").alias("at", "z"))
    cells = opened.select(
        (F.col("tile_col") * SMALL + F.col("at") % F.col("cols")).cast("int").alias("col"),
        (F.col("tile_row") * SMALL + F.floor(F.col("at") / F.col("cols"))).cast("int").alias("row"), "z")
    return rounded(layers.window_cells(cells, (5, 20), (3, 12)))


@job(
    "layer_catalog",
    t.with_views(
        """SELECT z.zoom::INT AS zoom, count(*) AS cells, count(v) AS data_cells, round(avg(v), 6) AS mean FROM (
  SELECT 0 AS zoom, z AS v FROM """ + _boxed("dem_v") + """
  UNION ALL SELECT 1, z FROM """ + _boxed("half") + """) z GROUP BY 1""",
        "dem_v",
        extra={"half": "SELECT (col // 2)::INT AS col, (row // 2)::INT AS row, avg(z) AS z FROM dem_v GROUP BY 1, 2"},
    ),
)
def layer_catalog(spark, d):
    """Two pyramid levels written to a catalog folder by zoom and read back."""
    levels = resampling.pyramid(t.dem(spark, d), 1)
    tiles = None
    for zoom in (0, 1):
        part = layers.to_tiles(levels.filter(F.col("level") == zoom), ORIGIN, PIECE).withColumn("zoom", F.lit(zoom))
        tiles = part if tiles is None else tiles.unionByName(part)
    path = fresh_path(spark, "catalog")
    files.write_layer(tiles, path)
    opened = files.read_layer(spark, path).select("zoom", F.explode("cells").alias("z"))
    return rounded(
        opened.groupBy("zoom").agg(F.count(F.lit(1)).alias("cells"), F.count("z").alias("data_cells"), F.avg("z").alias("mean"))
    )


# --- terrain -----------------------------------------------------------------------------

_PLACES = {"nw": (-1, -1), "n": (0, -1), "ne": (1, -1), "w": (-1, 0), "e": (1, 0), "sw": (-1, 1), "s": (0, 1), "se": (1, 1)}
_AROUND_SQL = (
    "SELECT d.col, d.row, d.z AS c, "
    + ", ".join(f"{n}.z AS {n}" for n in _PLACES)
    + " FROM dem_v d "
    + " ".join(f"LEFT JOIN dem_v {n} ON {n}.col = d.col + ({dc}) AND {n}.row = d.row + ({dr})" for n, (dc, dr) in _PLACES.items())
)
_FILLED_SQL = "SELECT col, row, c, " + ", ".join(f"coalesce({n}, c) AS {n}" for n in _PLACES) + " FROM around WHERE c IS NOT NULL"
_GRADIENT_SQL = f"""SELECT d.col, d.row, ((ne + 2 * e + se) - (nw + 2 * w + sw)) / {8 * CELL}::DOUBLE AS dx,
  ((sw + 2 * s + se) - (nw + 2 * n + ne)) / {8 * CELL}::DOUBLE AS dy FROM dem_v d LEFT JOIN filled f USING (col, row)"""
_SLOPE_SQL = "SELECT col, row, degrees(atan(sqrt(dx * dx + dy * dy))) AS slope FROM gradient"
TERRAIN = {"around": _AROUND_SQL, "filled": _FILLED_SQL, "gradient": _GRADIENT_SQL, "slope_v": _SLOPE_SQL}


@job("slope", t.with_views("SELECT col, row, round(slope, 6) AS slope FROM slope_v", "dem_v", extra=TERRAIN))
def slope(spark, d):
    return rounded(terrain.slope(t.dem(spark, d), CELL))




def _local_around(block: int) -> str:
    joins = " ".join(
        f"LEFT JOIN dem_v {n} ON {n}.col = d.col + ({dc}) AND {n}.row = d.row + ({dr})"
        f" AND {n}.col // {block} = d.col // {block} AND {n}.row // {block} = d.row // {block}"
        for n, (dc, dr) in _PLACES.items()
    )
    return "SELECT d.col, d.row, d.z AS c, " + ", ".join(f"{n}.z AS {n}" for n in _PLACES) + " FROM dem_v d " + joins


@job(
    "slope_per_tile",
    t.with_views("SELECT col, row, round(slope, 6) AS slope FROM slope_v", "dem_v", extra={**TERRAIN, "around": _local_around(PIECE)}),
)
def slope_per_tile(spark, d):
    """Slope of every tile on its own, without its neighbours."""
    return rounded(terrain.slope(t.dem(spark, d), CELL, block=PIECE, tile_local=True))


@job(
    "aspect",
    t.with_views(
        """SELECT col, row, CASE WHEN dx IS NULL THEN NULL WHEN dx = 0 AND dy = 0 THEN -1.0::DOUBLE
  ELSE round((450.0::DOUBLE - degrees(atan2(dy, -dx))) % 360.0::DOUBLE, 6) END AS aspect FROM gradient""",
        "dem_v",
        extra=TERRAIN,
    ),
)
def aspect(spark, d):
    return rounded(terrain.aspect(t.dem(spark, d), CELL))


_SIN, _COS = math.sin(math.radians(315)), math.cos(math.radians(315))
_UP, _FLAT = math.sin(math.radians(45)), math.cos(math.radians(45))


@job(
    "hillshade",
    t.with_views(
        f"""SELECT col, row, round(255 * greatest(0, (-dx * {ps.num(_SIN * _FLAT)} + dy * {ps.num(_COS * _FLAT)} + {ps.num(_UP)})
  / sqrt(dx * dx + dy * dy + 1)), 6) AS hillshade FROM gradient WHERE dx IS NOT NULL
UNION ALL SELECT col, row, NULL FROM gradient WHERE dx IS NULL""",
        "dem_v",
        extra=TERRAIN,
    ),
)
def hillshade(spark, d):
    shaded = terrain.hillshade(t.dem(spark, d), CELL)
    return rounded(shaded)


_ALL = ("c", *_PLACES)


@job(
    "focal_mean",
    t.with_views(
        "SELECT col, row, CASE WHEN c IS NOT NULL THEN round(("
        + " + ".join(f"coalesce({n}, 0)" for n in _ALL)
        + ") / ("
        + " + ".join(f"(({n} IS NOT NULL)::INT)" for n in _ALL)
        + "), 6) END AS focal_mean FROM around",
        "dem_v",
        extra={"around": _AROUND_SQL},
    ),
)
def focal_mean(spark, d):
    return rounded(terrain.focal_mean(t.dem(spark, d)))


# --- surfaces ----------------------------------------------------------------------------

_CLASS_SQL = "CASE WHEN floor(slope) <= 5 THEN 0 WHEN floor(slope) <= 15 THEN 1 WHEN floor(slope) <= 30 THEN 2 ELSE 3 END"
_TILE_CLASS_SQL = f"""SELECT (col // {PIECE})::INT AS tile_col, (row // {PIECE})::INT AS tile_row, {_CLASS_SQL} AS class, count(*) AS n
FROM slope_v WHERE slope IS NOT NULL GROUP BY 1, 2, 3"""
_LABELS = "CASE class WHEN 0 THEN '0-5' WHEN 1 THEN '5-15' WHEN 2 THEN '15-30' ELSE '30-Inf' END"


def _tile_classes(spark, d, truncate=True):
    return surfaces.tile_class_histogram(terrain.slope(t.dem(spark, d), CELL), "slope", truncate=truncate, tile_size=PIECE)


@job(
    "slope_class_histogram",
    t.with_views(f"SELECT class, {_LABELS} AS label, CAST(sum(n) AS BIGINT) AS n FROM h GROUP BY 1", "dem_v", extra={**TERRAIN, "h": _TILE_CLASS_SQL}),
)
def slope_class_histogram(spark, d):
    return surfaces.class_histogram(_tile_classes(spark, d))


@job(
    "slope_class_exact",
    t.with_views(
        f"""SELECT class, {_LABELS} AS label, n FROM (SELECT CASE WHEN slope < 5 THEN 0 WHEN slope < 15 THEN 1 WHEN slope < 30 THEN 2
  ELSE 3 END AS class, count(*) AS n FROM slope_v WHERE slope IS NOT NULL GROUP BY 1)""",
        "dem_v",
        extra=TERRAIN,
    ),
)
def slope_class_exact(spark, d):
    return surfaces.class_histogram(_tile_classes(spark, d, truncate=False))


@job(
    "slope_class_levels",
    t.with_views(
        """SELECT tile_col, tile_row, class, n, round(n / sum(n) OVER (PARTITION BY tile_col, tile_row)::DOUBLE, 6) AS tile_share,
  round(sum(n) OVER (PARTITION BY class)::DOUBLE / sum(n) OVER ()::DOUBLE, 6) AS layer_share FROM h""",
        "dem_v",
        extra={**TERRAIN, "h": _TILE_CLASS_SQL},
    ),
)
def slope_class_levels(spark, d):
    return rounded(surfaces.class_levels(_tile_classes(spark, d)))


@job(
    "cell_statistics",
    t.with_views(
        """SELECT count(z) AS data_cells, round(avg(z), 6) AS mean, round(quantile_cont(z, 0.5), 6) AS median,
  (SELECT round(z, 6) FROM dem_v WHERE z IS NOT NULL GROUP BY z ORDER BY count(*) DESC, z LIMIT 1) AS mode,
  round(stddev_pop(z), 6) AS stddev, round(min(z), 6) AS zmin, round(max(z), 6) AS zmax FROM dem_v""",
        "dem_v",
    ),
)
def cell_statistics(spark, d):
    return rounded(surfaces.cell_statistics(t.dem(spark, d)))


PEAK_SQL = "SELECT col, row, z FROM dem_v WHERE z IS NOT NULL ORDER BY z DESC, row, col LIMIT 1"


@job("peak_cell", t.with_views(f"SELECT col, row, round(z, 6) AS z FROM ({PEAK_SQL})", "dem_v"))
def peak_cell(spark, d):
    return rounded(surfaces.peak_cell(t.dem(spark, d)))


@job(
    "quantile_classes",
    t.with_views(
        """SELECT col, row, round(z, 6) AS z, CASE WHEN z IS NOT NULL THEN len(list_filter(b, lambda x: x < z))::INT END AS class
FROM dem_v, (SELECT quantile_cont(z, [0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875]) AS b FROM dem_v)""",
        "dem_v",
    ),
)
def quantile_classes(spark, d):
    return rounded(surfaces.quantile_classes(t.dem(spark, d), 8))


_RAMP_VALUES = ", ".join(f"({v}::DOUBLE, {r}, {g}, {b})" for v, r, g, b in surfaces.SLOPE_RAMP)
_MIX = "floor(a.{0} + (s.slope - a.v) / (b.v - a.v) * (b.{0} - a.{0}) + 0.5)::INT AS {0}"


@job(
    "color_relief",
    t.with_views(
        f"""SELECT s.col, s.row, {', '.join(_MIX.format(c) for c in 'rgb')} FROM slope_v s
LEFT JOIN (SELECT *, row_number() OVER (ORDER BY v) AS i FROM ramp) a ON greatest(s.slope, 1e-12) > a.v AND a.i < 9
  AND s.slope <= coalesce((SELECT min(v) FROM ramp q WHERE q.v > a.v), 1e9)
LEFT JOIN (SELECT *, row_number() OVER (ORDER BY v) AS i FROM ramp) b ON b.i = a.i + 1""",
        "dem_v",
        extra={**TERRAIN, "ramp(v, r, g, b)": f"VALUES {_RAMP_VALUES}"},
    ),
)
def color_relief(spark, d):
    return surfaces.color_relief(terrain.slope(t.dem(spark, d), CELL), "slope")


@job(
    "local_algebra",
    t.with_views(
        """SELECT col, row, round(2 * (z - lo) / NULLIF(hi - lo, 0), 6) AS z
FROM (SELECT col, row, CASE WHEN z - 3000 >= 0 THEN z - 3000 END AS z FROM dem_v),
  (SELECT min(z - 3000) AS lo, max(z - 3000) AS hi FROM dem_v WHERE z - 3000 >= 0)""",
        "dem_v",
    ),
)
def local_algebra(spark, d):
    """Heights over 3000: negative ones dropped, the rest scaled to 0..1 and doubled."""
    above = t.dem(spark, d).withColumn("z", F.col("z") - 3000.0)
    return rounded(surfaces.scaled(surfaces.normalised(surfaces.drop_negative(above)), 2.0))


# --- resampling --------------------------------------------------------------------------

SMALL = 50


@job(
    "downsample",
    t.with_views(
        f"""SELECT g.col, g.row, round(sum(w * z) / NULLIF(sum(CASE WHEN z IS NOT NULL THEN w END), 0), 6) AS z FROM (
  SELECT c.i::INT AS col, r.i::INT AS row, x.o + floor(c.s)::INT AS sc, y.o + floor(r.s)::INT AS sr,
    (CASE x.o WHEN 0 THEN 1 - (c.s - floor(c.s)) ELSE c.s - floor(c.s) END)
    * (CASE y.o WHEN 0 THEN 1 - (r.s - floor(r.s)) ELSE r.s - floor(r.s) END) AS w
  FROM axis c, down r, range(2) x(o), range(2) y(o)) g JOIN dem_v d ON d.col = g.sc AND d.row = g.sr WHERE w > 0 GROUP BY 1, 2""",
        "dem_v",
        extra={
            name: f"""SELECT i, (i + 0.5::DOUBLE) * (n / t) - 0.5::DOUBLE AS s FROM range({SMALL}) a(i),
  (SELECT (max({axis}) + 1)::DOUBLE AS n, least({SMALL}, max({axis}) + 1)::DOUBLE AS t FROM dem_v) WHERE i < t"""
            for name, axis in (("axis", "col"), ("down", "row"))
        },
    ),
)
def downsample(spark, d):
    return rounded(resampling.downsample(t.dem(spark, d), SMALL, SMALL))


@job(
    "pyramid",
    t.with_views(
        " UNION ALL ".join(
            f"SELECT {k} AS level, (col // {2 ** k})::INT AS col, (row // {2 ** k})::INT AS row, round(avg(z), 6) AS z FROM dem_v GROUP BY 2, 3"
            for k in range(4)
        ),
        "dem_v",
    ),
)
def pyramid(spark, d):
    return rounded(resampling.pyramid(t.dem(spark, d), 3))


UTM45 = TransverseMercator.utm(45)
_CORNER = ps.num(1 / 3600)
_OUTLINE_SQL = f"""SELECT 86.9::DOUBLE + c * {_CORNER} AS lon, 28.03::DOUBLE - r * {_CORNER} AS lat
FROM (SELECT c, e * m AS r FROM (SELECT *, unnest(range(0, n + 1)) AS c FROM side), (VALUES (0), (1)) e(e)
  UNION ALL SELECT e * n AS c, r FROM (SELECT *, unnest(range(0, m + 1)) AS r FROM side), (VALUES (0), (1)) e(e))"""
_XY = ps.tm_xy()
_WARP_VIEWS = {
    "side": "SELECT max(col) + 1 AS n, max(row) + 1 AS m FROM dem_v",
    "outline": f"SELECT {_XY[0]} AS x, {_XY[1]} AS y FROM ({ps.tm_sphere(_OUTLINE_SQL, '87')})",
    "frame": """SELECT x0, y0, ceil((x1 - x0) / 30)::INT AS cols, ceil((y0 - y1) / 30)::INT AS rows FROM (
  SELECT floor(min(x) / 30) * 30 AS x0, ceil(max(y) / 30) * 30 AS y0, max(x) AS x1, min(y) AS y1 FROM outline)""",
    "target": """SELECT c.c::INT AS col, r.r::INT AS row, x0 + (c.c + 0.5::DOUBLE) * 30 AS x, y0 - (r.r + 0.5::DOUBLE) * 30 AS y
FROM frame, (SELECT unnest(range(0, cols)) AS c FROM frame) c, (SELECT unnest(range(0, rows)) AS r FROM frame) r""",
    "degree": ps.tm_inverse("SELECT * FROM target", "87.0::DOUBLE"),
    "placed": f"""SELECT col, row, CASE WHEN ok THEN least(greatest(sx, 0), n - 1) END AS sx, CASE WHEN ok THEN least(greatest(sy, 0), m - 1) END AS sy
FROM (SELECT *, sx >= -0.5 AND sx < n - 0.5 AND sy >= -0.5 AND sy < m - 0.5 AS ok FROM (
  SELECT col, row, (lon - 86.9::DOUBLE) / {_CORNER} - 0.5::DOUBLE AS sx, (28.03::DOUBLE - lat) / {_CORNER} - 0.5::DOUBLE AS sy, n, m
  FROM degree, side))""",
}


def _warped(spark, d, method):
    cells = t.dem(spark, d)
    shape = layers.shape_of(cells)
    geo, target = warping.target_frame(spark, ORIGIN, shape, UTM45, 30.0, "EPSG:32645")
    return warping.warp(cells, ORIGIN, shape, UTM45, geo, target, method)


@job(
    "warp",
    t.with_views(
        """SELECT col, row, CASE WHEN w > 0 THEN round(v / w, 5) END AS z FROM (
  SELECT p.col, p.row, sum(CASE WHEN d.z IS NOT NULL THEN w END) AS w, sum(w * d.z) AS v FROM (
    SELECT *, floor(sx) + x.o AS sc, floor(sy) + y.o AS sr,
      (CASE x.o WHEN 0 THEN 1 - (sx - floor(sx)) ELSE sx - floor(sx) END)
      * (CASE y.o WHEN 0 THEN 1 - (sy - floor(sy)) ELSE sy - floor(sy) END) AS w
    FROM placed, range(2) x(o), range(2) y(o)) p LEFT JOIN dem_v d ON d.col = p.sc AND d.row = p.sr GROUP BY 1, 2)""",
        "dem_v",
        extra=_WARP_VIEWS,
    ),
)
def warp(spark, d):
    return rounded(_warped(spark, d, "bilinear"), 5)


@job(
    "warp_nearest",
    t.with_views(
        """SELECT p.col, p.row, round(d.z, 6) AS z FROM placed p
LEFT JOIN dem_v d ON d.col = floor(p.sx + 0.5) AND d.row = floor(p.sy + 0.5)""",
        "dem_v",
        extra=_WARP_VIEWS,
    ),
)
def warp_nearest(spark, d):
    return rounded(_warped(spark, d, "nearest"))


@job(
    "tile_utm",
    t.with_views(
        f"""SELECT tile_col, tile_row, (32601 + floor((xmin + cols * {_CORNER} / 2 + 180) / 6))::INT AS utm_epsg FROM tiles""",
        "dem_v",
        extra={"tiles": _TILES_SQL},
    ),
)
def tile_utm(spark, d):
    return warping.tile_utm(_tiles(spark, d)).select("tile_col", "tile_row", "utm_epsg")


# The same layer moved so that it lies on both sides of a zone border.
BORDER = layers.Georeference(89.985, 28.03, 1 / 3600, 1 / 3600, "EPSG:4326")
_PIECES_SQL = f"""SELECT (col // {PIECE})::INT AS tile_col, (row // {PIECE})::INT AS tile_row, max(col) - min(col) + 1 AS cols,
  max(row) - min(row) + 1 AS rows, 89.985::DOUBLE + min(col) * {_CORNER} AS xmin, 28.03::DOUBLE - min(row) * {_CORNER} AS ymax
FROM dem_v GROUP BY 1, 2"""
_PIECE_VIEWS = {
    "pieces": f"SELECT *, floor((xmin + cols * {_CORNER} / 2 + 180) / 6) * 6 - 177 AS lon0 FROM ({_PIECES_SQL})",
    "outline": f"""SELECT tile_col, tile_row, {_XY[0]} AS x, {_XY[1]} AS y FROM ({ps.tm_sphere(f"""
  SELECT *, xmin + c * {_CORNER} AS lon, ymax - r * {_CORNER} AS lat FROM (
    SELECT *, e * rows AS r FROM pieces, range(0, {PIECE + 1}) a(c), (VALUES (0), (1)) b(e) WHERE c <= cols
    UNION ALL BY NAME SELECT *, e * cols AS c FROM pieces, range(0, {PIECE + 1}) a(r), (VALUES (0), (1)) b(e) WHERE r <= rows)""", 'lon0')})""",
    "frame": """SELECT *, ceil((x1 - x0) / 30) AS tcols, ceil((y0 - y1) / 30) AS trows FROM (
  SELECT tile_col, tile_row, floor(min(x) / 30) * 30 AS x0, ceil(max(y) / 30) * 30 AS y0, max(x) AS x1, min(y) AS y1 FROM outline GROUP BY 1, 2)""",
    "target": """SELECT p.*, c.c::INT AS col, r.r::INT AS row, x0 + (c.c + 0.5::DOUBLE) * 30 AS x, y0 - (r.r + 0.5::DOUBLE) * 30 AS y
FROM pieces p JOIN frame USING (tile_col, tile_row), (SELECT unnest(range(0, max(tcols)::BIGINT)) AS c FROM frame) c,
  (SELECT unnest(range(0, max(trows)::BIGINT)) AS r FROM frame) r WHERE c.c < tcols AND r.r < trows""",
    "degree": ps.tm_inverse("SELECT * FROM target", "lon0"),
    "placed": f"""SELECT tile_col, tile_row, col, row, CASE WHEN ok THEN least(greatest(sx, 0), cols - 1) END AS sx,
  CASE WHEN ok THEN least(greatest(sy, 0), rows - 1) END AS sy
FROM (SELECT *, sx >= -0.5 AND sx < cols - 0.5 AND sy >= -0.5 AND sy < rows - 0.5 AS ok FROM (
  SELECT *, (lon - xmin) / {_CORNER} - 0.5::DOUBLE AS sx, (ymax - lat) / {_CORNER} - 0.5::DOUBLE AS sy FROM degree))""",
    "warped": f"""SELECT tile_col, tile_row, col, row, CASE WHEN w > 0 THEN v / w END AS z FROM (
  SELECT p.tile_col, p.tile_row, p.col, p.row, sum(CASE WHEN d.z IS NOT NULL THEN w END) AS w, sum(w * d.z) AS v FROM (
    SELECT *, floor(sx) + x.o AS sc, floor(sy) + y.o AS sr,
      (CASE x.o WHEN 0 THEN 1 - (sx - floor(sx)) ELSE sx - floor(sx) END)
      * (CASE y.o WHEN 0 THEN 1 - (sy - floor(sy)) ELSE sy - floor(sy) END) AS w
    FROM placed, range(2) x(o), range(2) y(o)) p
  LEFT JOIN dem_v d ON d.col = p.tile_col * {PIECE} + p.sc AND d.row = p.tile_row * {PIECE} + p.sr AND p.sc < {PIECE} AND p.sr < {PIECE}
  GROUP BY 1, 2, 3, 4)""",
    "around": "SELECT d.tile_col, d.tile_row, d.col, d.row, d.z AS c, " + ", ".join(f"{n}.z AS {n}" for n in _PLACES) + " FROM warped d "
    + " ".join(
        f"LEFT JOIN warped {n} ON {n}.tile_col = d.tile_col AND {n}.tile_row = d.tile_row AND {n}.col = d.col + ({dc}) AND {n}.row = d.row + ({dr})"
        for n, (dc, dr) in _PLACES.items()
    ),
    "filled": _FILLED_SQL.replace("SELECT col", "SELECT tile_col, tile_row, col"),
    "slope_v": f"""SELECT *, degrees(atan(sqrt(dx * dx + dy * dy))) AS slope FROM (
  SELECT tile_col, tile_row, ((ne + 2 * e + se) - (nw + 2 * w + sw)) / 240.0::DOUBLE AS dx,
    ((sw + 2 * s + se) - (nw + 2 * n + ne)) / 240.0::DOUBLE AS dy FROM filled)""",
}


@job("warp_tiles", t.with_views("SELECT tile_col, tile_row, col, row, round(z, 5) AS z FROM warped", "dem_v", extra=_PIECE_VIEWS))
def warp_tiles(spark, d):
    """Every tile reprojected on its own, to the zone of its centre."""
    return rounded(warping.warp_tiles(layers.to_tiles(t.dem(spark, d), BORDER, PIECE), 30.0), 5)


@job(
    "projected_slope_classes",
    t.with_views(f"SELECT tile_col, tile_row, {_CLASS_SQL} AS class, count(*) AS n FROM slope_v GROUP BY 1, 2, 3", "dem_v", extra=_PIECE_VIEWS),
)
def projected_slope_classes(spark, d):
    """Tiles, each reprojected to its own zone, to slopes, to classes, to one histogram per tile."""
    slopes = warping.projected_slopes(layers.to_tiles(t.dem(spark, d), BORDER, PIECE), 30.0)
    return surfaces.tile_class_histogram(slopes, "slope")


# --- zones and regions -------------------------------------------------------------------

_OCTANT = "CASE WHEN dx IS NULL THEN NULL WHEN dx = 0 AND dy = 0 THEN -1 ELSE floor(((450.0::DOUBLE - degrees(atan2(dy, -dx))) % 360.0::DOUBLE) / 45)::INT END"
_ZONED = {
    **TERRAIN,
    "zoned": f"""SELECT s.col, s.row, {_CLASS_SQL} AS zone, {_OCTANT} AS value FROM slope_v s JOIN gradient USING (col, row) WHERE slope IS NOT NULL""",
}


def _octants_and_classes(spark, d):
    both = terrain.slope_and_aspect(t.dem(spark, d), CELL)
    octant = F.when(F.col("aspect") < 0, -1).otherwise(F.floor(F.col("aspect") / 45).cast("int"))
    values = both.select("col", "row", F.when(F.col("aspect").isNotNull(), octant).alias("value"))
    zones = both.select("col", "row", surfaces.break_class(F.col("slope")).alias("zone"))
    return values, zones


@job("zonal_histogram", t.with_views("SELECT zone, value, count(*) AS n FROM zoned GROUP BY 1, 2", "dem_v", extra=_ZONED))
def zonal_histogram(spark, d):
    return zonal.zonal_histogram(*_octants_and_classes(spark, d))


@job(
    "zonal_percentage",
    t.with_views(
        """SELECT col, row, zone, value, round(count(*) OVER (PARTITION BY zone, value) * 100.0::DOUBLE / count(*) OVER (PARTITION BY zone), 6)
  AS percentage FROM zoned""",
        "dem_v",
        extra=_ZONED,
    ),
)
def zonal_percentage(spark, d):
    return rounded(zonal.zonal_percentage(*_octants_and_classes(spark, d)))


_REGION_VIEWS = {
    "open_cells": "SELECT col, row, row::BIGINT * (SELECT max(col) + 1 FROM dem_v) + col AS id FROM slope_v WHERE slope <= 15",
    "touching": """SELECT a.id AS a, b.id AS b FROM open_cells a, (VALUES (1, 0), (-1, 0), (0, 1), (0, -1)) o(dc, dr), open_cells b
WHERE b.col = a.col + dc AND b.row = a.row + dr""",
    "labels(id, region) USING KEY (id)": """SELECT id, id FROM open_cells UNION
SELECT e.b, min(f.region) FROM labels f JOIN touching e ON e.a = f.id JOIN recurring.labels r ON r.id = e.b
WHERE f.region < r.region GROUP BY e.b""",
    "regions": "SELECT col, row, region FROM open_cells JOIN labels USING (id)",
}


@job("slope_regions", t.with_views("SELECT * FROM regions", "dem_v", extra={**TERRAIN, **_REGION_VIEWS}, recursive=True))
def slope_regions(spark, d):
    cells = t.dem(spark, d)
    return regions.slope_regions(terrain.slope(cells, CELL), tile_size=PIECE, shape=layers.shape_of(cells))


_VIEWSHED_VIEWS = {
    "peak": PEAK_SQL,
    "q": "SELECT max(col) AS m, max(row) AS d FROM dem_v",
    "ends": """SELECT c.c - p.col AS dc, r.r - p.row AS dr, greatest(abs(c.c - p.col), abs(r.r - p.row)) AS n, c.c * 100000 + r.r AS ray
FROM q, (SELECT unnest(range(0, m + 1)) AS c FROM q) c, (SELECT unnest(range(0, d + 1)) AS r FROM q) r, peak p
WHERE c.c IN (0, m) OR r.r IN (0, d)""",
    "steps": """SELECT ray, k.k, floor((2.0::DOUBLE * dc * k.k + n) / (2.0::DOUBLE * n))::INT AS dc,
  floor((2.0::DOUBLE * dr * k.k + n) / (2.0::DOUBLE * n))::INT AS dr FROM ends, (SELECT unnest(range(1, greatest(m, d) + 1)) AS k FROM q) k WHERE k.k <= n""",
    "angles": f"""SELECT ray, k, d.col, d.row, (d.z - p.z) / (sqrt((d.col - p.col)::DOUBLE * (d.col - p.col) + (d.row - p.row)::DOUBLE * (d.row - p.row))
  * {CELL}::DOUBLE) AS t FROM steps s, peak p, dem_v d WHERE d.col = p.col + s.dc AND d.row = p.row + s.dr""",
    "viewshed": """SELECT col, row, max(seen)::INT AS visible FROM (
  SELECT col, row, CASE WHEN t IS NOT NULL THEN (h IS NULL OR t >= h)::INT END AS seen FROM (
    SELECT *, max(t) OVER (PARTITION BY ray ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS h FROM angles)
  UNION ALL SELECT col, row, 1 FROM peak) GROUP BY 1, 2""",
}


@job("viewshed", t.with_views("SELECT * FROM viewshed", "dem_v", extra=_VIEWSHED_VIEWS))
def viewshed(spark, d):
    return visibility.peak_viewshed(t.dem(spark, d), CELL)


@job(
    "visible_regions",
    t.with_views(
        """SELECT col, row, region FROM regions WHERE region IN (
  SELECT region FROM regions JOIN viewshed USING (col, row) WHERE visible IS NOT NULL GROUP BY 1 HAVING sum(visible) >= count(*) * 0.05::DOUBLE)""",
        "dem_v",
        extra={**TERRAIN, **_REGION_VIEWS, **_VIEWSHED_VIEWS},
        recursive=True,
    ),
)
def visible_regions(spark, d):
    # noise hides most of the dome, so the share asked for is low
    return visibility.visible_regions(t.dem(spark, d), CELL, min_visible_percent=5.0, tile_size=PIECE)


COARSE = 4


@job(
    "visible_regions_third",
    t.with_views(
        """SELECT col, row, region FROM regions WHERE region IN (
  SELECT region FROM regions JOIN viewshed USING (col, row) WHERE visible IS NOT NULL GROUP BY 1 HAVING sum(visible) >= count(*) * 0.3::DOUBLE)""",
        extra={
            "fine_v": t.DEM_SQL,
            "dem_v": f"SELECT (col // {COARSE})::INT AS col, (row // {COARSE})::INT AS row, round(avg(z), 6) AS z FROM fine_v GROUP BY 1, 2",
            **TERRAIN, **_REGION_VIEWS, **_VIEWSHED_VIEWS,
        },
        recursive=True,
    ),
)
def visible_regions_third(spark, d):
    """The default share of 30 percent, over the raster in coarser cells, whose means are smooth enough to be seen."""
    coarse = lambda c: F.floor(F.col(c) / COARSE).cast("int").alias(c)
    cells = t.dem(spark, d).groupBy(coarse("col"), coarse("row")).agg(F.round(F.avg("z"), 6).alias("z"))
    return visibility.visible_regions(settled(cells, "coarse"), CELL, tile_size=PIECE)


# --- costs -------------------------------------------------------------------------------

MAX_SLOPE, MAX_HEIGHT = 40.0, 3990.0
_COST_VIEWS = {
    **TERRAIN,
    "costs": f"""SELECT col, row, z, CASE WHEN slope <= {MAX_SLOPE} AND z <= {MAX_HEIGHT} THEN 1 + slope * 0.1::DOUBLE END AS cost
FROM slope_v JOIN dem_v USING (col, row)""",
    "passable": "SELECT * FROM costs WHERE cost IS NOT NULL",
    "start": "SELECT col, row FROM passable ORDER BY z DESC, row, col LIMIT 1",
    "moves": f"""SELECT dc, dr, CASE WHEN dc = 0 OR dr = 0 THEN {ps.num(CELL / 2)} ELSE {ps.num(CELL * math.hypot(1, 1) / 2)} END AS half
FROM range(-1, 2) a(dc), range(-1, 2) b(dr) WHERE dc <> 0 OR dr <> 0""",
    "links": """SELECT a.col, a.row, b.col AS to_col, b.row AS to_row, half * (a.cost + b.cost) AS w
FROM passable a, moves, passable b WHERE b.col = a.col + dc AND b.row = a.row + dr""",
    "reach(col, row, distance) USING KEY (col, row)": """SELECT col, row, 0.0::DOUBLE FROM start UNION
SELECT l.to_col, l.to_row, min(f.distance + l.w) FROM reach f JOIN links l ON l.col = f.col AND l.row = f.row
LEFT JOIN recurring.reach r ON r.col = l.to_col AND r.row = l.to_row
WHERE r.distance IS NULL OR f.distance + l.w < r.distance GROUP BY 1, 2""",
    "reached": """SELECT r.col, r.row, r.distance, arg_min(o.col, (o.row, o.col)) AS from_col, arg_min(o.row, (o.row, o.col)) AS from_row
FROM reach r LEFT JOIN (SELECT l.to_col, l.to_row, f.col, f.row, f.distance + l.w AS through FROM reach f JOIN links l ON l.col = f.col AND l.row = f.row) o
  ON o.to_col = r.col AND o.to_row = r.row AND o.through = r.distance GROUP BY 1, 2, 3""",
}


@job("cost_surface", t.with_views("SELECT col, row, round(cost, 6) AS cost FROM costs", "dem_v", extra=_COST_VIEWS, recursive=True))
def cost_surface(spark, d):
    return rounded(_costs(spark, d).drop("z"))


def _costs(spark, d):
    return costs.cost_surface(terrain.slope(t.dem(spark, d), CELL, with_height=True), 0.1, MAX_SLOPE, MAX_HEIGHT)


def _reached(spark, d):
    """Cost distance from the highest passable cell."""
    surface = settled(_costs(spark, d), "surface")
    heights = surface.filter("cost IS NOT NULL").select("col", "row", "z")
    return costs.cost_distance(surface, surfaces.peak_cell(heights), CELL, 8)


@job(
    "cost_distance",
    t.with_views(
        "SELECT col, row, round(distance, 6) AS distance, from_col, from_row FROM reached", "dem_v", extra=_COST_VIEWS, recursive=True
    ),
)
def cost_distance(spark, d):
    return rounded(_reached(spark, d))


_PATH_VIEWS = {
    **_COST_VIEWS,
    "ends": """SELECT (col // 32)::INT AS destination, arg_max(col, (distance, row, col)) AS col, arg_max(row, (distance, row, col)) AS row
FROM reached GROUP BY 1""",
    "path": """SELECT destination, 0 AS step, col, row FROM ends UNION ALL
SELECT p.destination, p.step + 1, r.from_col, r.from_row FROM path p JOIN reached r USING (col, row) WHERE r.from_col IS NOT NULL""",
}


@job("least_cost_paths", t.with_views("SELECT * FROM path", "dem_v", extra=_PATH_VIEWS, recursive=True))
def least_cost_paths(spark, d):
    """The paths from the farthest cell of every band of 32 columns."""
    reached = _reached(spark, d)
    farthest = F.max_by(F.struct("col", "row"), F.struct("distance", "row", "col"))
    band = F.floor(F.col("col") / 32).cast("int").alias("destination")
    ends = reached.groupBy(band).agg(farthest.alias("e")).select("destination", "e.*")
    return costs.least_cost_paths(reached, ends)

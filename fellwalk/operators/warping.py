"""Reprojection of a raster from longitude and latitude to a map projection."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fellwalk.functions.projections import Projection, TransverseMercator, utm_epsg, utm_zone
from fellwalk.operators.layers import Georeference, Shape
from fellwalk.operators.terrain import BLOCK, slope
from fellwalk.session import parallelism, spread

CELLS_PER_TASK = 1_000_000


def target_frame(
    spark: SparkSession, geo: Georeference, shape: Shape, projection: Projection, cell_size: float, crs: str
) -> tuple[Georeference, Shape]:
    """Georeference and shape of the projected layer, on whole multiples of the cell size.

    The outline of the source is projected; its bounds are one row.
    """
    across, down = shape.cols + 1, shape.rows + 1
    i = F.col("id")
    side = i - 2 * across
    col = F.when(i < across, i).when(i < 2 * across, i - across).when(side < down, F.lit(0)).otherwise(F.lit(shape.cols))
    row = F.when(i < across, F.lit(0)).when(i < 2 * across, F.lit(shape.rows)).when(side < down, side).otherwise(side - down)
    outline = spark.range(0, 2 * across + 2 * down).select(
        (geo.xmin + (shape.col0 + col) * geo.cell_width).alias("lon"), (geo.ymax - (shape.row0 + row) * geo.cell_height).alias("lat")
    )
    x, y = projection.forward(F.col("lon"), F.col("lat"))
    placed = outline.select(x.alias("x"), y.alias("y"))
    xmin, ymin, xmax, ymax = placed.agg(F.min("x"), F.min("y"), F.max("x"), F.max("y")).first()
    left, top = math.floor(xmin / cell_size) * cell_size, math.ceil(ymax / cell_size) * cell_size
    cols, rows = math.ceil((xmax - left) / cell_size), math.ceil((top - ymin) / cell_size)
    return Georeference(left, top, cell_size, cell_size, crs), Shape(0, 0, cols, rows)


# ---- sampling by block ----

REQUEST = "cells struct<col:array<int>,row:array<int>,x:array<double>,y:array<double>,sc:array<int>,sr:array<int>>"


def _source_blocks(cells: DataFrame) -> DataFrame:
    """One row for each block of ``BLOCK`` x ``BLOCK`` cells: ``bc``, ``br``, ``source``, with the first column and row after it."""
    home = lambda axis: F.floor(axis / BLOCK).cast("int")
    reach = lambda axis: F.array_distinct(F.array(home(axis - 1), home(axis)))
    placed = cells.select("col", "row", "z", F.explode(reach(F.col("col"))).alias("bc")).select("*", F.explode(reach(F.col("row"))).alias("br"))
    one = F.struct(F.col("col").cast("int").alias("col"), F.col("row").cast("int").alias("row"), F.col("z").cast("double").alias("z"))
    return placed.groupBy("bc", "br").agg(F.collect_list(one).alias("source"))


def _requests(located: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target cells packed by ``keys``: one row for those of an Arrow batch that share them, with arrays as ``cells``.

    ``located`` has the integer ``keys``, the target cell ``col row``, its place in the source ``x y``, and the source cell
    ``sc sr`` that place is counted from.  Neighbouring rows should share their keys; nothing is shuffled.
    """
    keys, names = list(keys), ("col", "row", "x", "y", "sc", "sr")

    def pack(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            by = [batch.column(k).to_numpy() for k in keys]
            values = [batch.column(n).to_numpy() for n in names]
            order = np.lexsort(by[::-1])
            new = np.zeros(len(order), dtype=bool)
            for k in by:
                new[1:] |= k[order][1:] != k[order][:-1]
            starts = np.append(0, np.flatnonzero(new))
            bounds = pa.array(np.append(starts, len(order)), pa.int32())
            kinds = (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.int32())
            lists = [pa.ListArray.from_arrays(bounds, pa.array(v[order], t)) for v, t in zip(values, kinds)]
            yield pa.RecordBatch.from_arrays([*[pa.array(k[order][starts], pa.int32()) for k in by], pa.StructArray.from_arrays(lists, names=list(names))], names=[*keys, "cells"])

    schema = ", ".join([f"{k} int" for k in keys] + [REQUEST])
    return located.select(*[F.col(k).cast("int").alias(k) for k in keys], *names).mapInArrow(pack, schema)


def _mixed(z: np.ndarray, known: np.ndarray, c: np.ndarray, r: np.ndarray, fx: np.ndarray, fy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bilinear values at ``fx``, ``fy`` from the cells ``c``, ``r`` of a grid, over the cells with data, and whether there are any.

    The grid has a column and a row without data after the last, which place -1 means too.
    """
    weight, value = np.zeros(len(c)), np.zeros(len(c))
    for dc, dr, share in ((0, 0, (1 - fx) * (1 - fy)), (1, 0, fx * (1 - fy)), (0, 1, (1 - fx) * fy), (1, 1, fx * fy)):
        here = known[r + dr, c + dc]
        weight = weight + np.where(here, share, 0.0)
        value = value + np.where(here, share * np.where(here, z[r + dr, c + dc], 0.0), 0.0)
    there = weight > 0
    return np.where(there, value, 0.0) / np.where(there, weight, 1.0), there


def _sampled(met: DataFrame, keys: Sequence[str], method: str, whole: bool) -> DataFrame:
    """Values of packed target cells from the source beside them: ``keys``, ``col``, ``row``, ``z``.

    The source is the cells of a block at ``bc``, ``br`` as structs, or with ``whole`` a grid of ``cols`` x ``rows`` values.
    """
    keys = list(keys)

    def sample(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one = lambda name: batch.column(name)[i].as_py()  # noqa: B023, E731
                asked = batch.column("cells").slice(i, 1)
                col, row, x, y, sc, sr = (asked.field(n).flatten().to_numpy() for n in ("col", "row", "x", "y", "sc", "sr"))
                source = batch.column("source").slice(i, 1).flatten()
                if whole:
                    c0 = r0 = 0
                    z, known = np.zeros((one("rows") + 1, one("cols") + 1)), np.zeros((one("rows") + 1, one("cols") + 1), dtype=bool)
                    known[:-1, :-1] = source.is_valid().to_numpy(zero_copy_only=False).reshape(one("rows"), one("cols"))
                    z[:-1, :-1] = source.to_numpy(zero_copy_only=False).reshape(one("rows"), one("cols"))
                else:
                    c0, r0 = one("bc") * BLOCK, one("br") * BLOCK
                    z, known = np.zeros((BLOCK + 1, BLOCK + 1)), np.zeros((BLOCK + 1, BLOCK + 1), dtype=bool)
                    at = source.field("row").to_numpy() - r0, source.field("col").to_numpy() - c0
                    known[at] = source.field("z").is_valid().to_numpy(zero_copy_only=False)
                    z[at] = source.field("z").to_numpy(zero_copy_only=False)
                c, r = sc - c0, sr - r0
                value, there = (z[r, c], known[r, c]) if method == "nearest" else _mixed(z, known, c, r, x - sc, y - sr)
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(np.full(len(col), one(k)), pa.int32()) for k in keys], pa.array(col), pa.array(row), pa.array(value, mask=~there)],
                    names=[*keys, "col", "row", "z"])

    schema = ", ".join([f"{k} int" for k in keys] + ["col int", "row int", "z double"])
    return met.mapInArrow(sample, schema)


def warp(
    cells: DataFrame,
    geo: Georeference,
    shape: Shape,
    projection: Projection,
    target_geo: Georeference,
    target_shape: Shape,
    method: str = "bilinear",
) -> DataFrame:
    """The raster on the target grid: ``col``, ``row``, ``z``.

    Each target cell is placed in the source by the inverse projection.  ``bilinear`` mixes the
    four cells around that place, leaving out those without data; ``nearest`` takes the closest.
    The target grid is generated in parallel, block by block, and its cells are packed by the source block they lie over.
    Packed cells meet the source blocks, a row each, and are read off their arrays in one task.
    """
    if method not in ("bilinear", "nearest"):
        raise ValueError("method is 'bilinear' or 'nearest'")
    spark = cells.sparkSession
    across, down = -(-target_shape.cols // BLOCK), -(-target_shape.rows // BLOCK)
    total = across * down * BLOCK * BLOCK
    tasks = max(parallelism(spark), total // CELLS_PER_TASK + 1)
    block, place = F.floor(F.col("id") / BLOCK**2), F.col("id") % BLOCK**2
    grid = spark.range(0, total, 1, tasks).select(
        (block % across * BLOCK + place % BLOCK).cast("int").alias("col"),
        (F.floor(block / across) * BLOCK + F.floor(place / BLOCK)).cast("int").alias("row"),
    ).filter((F.col("col") < target_shape.cols) & (F.col("row") < target_shape.rows))
    x = target_geo.xmin + (F.col("col") + 0.5) * target_geo.cell_width
    y = target_geo.ymax - (F.col("row") + 0.5) * target_geo.cell_height
    lon, lat = projection.inverse(x, y)
    placed = grid.select("col", "row", lon.alias("lon"), lat.alias("lat")).select(
        "col", "row",
        ((F.col("lon") - geo.xmin) / geo.cell_width - 0.5 - shape.col0).alias("sx"),
        ((geo.ymax - F.col("lat")) / geo.cell_height - 0.5 - shape.row0).alias("sy"),
    )
    covered = (F.col("sx") >= -0.5) & (F.col("sx") < shape.cols - 0.5) & (F.col("sy") >= -0.5) & (F.col("sy") < shape.rows - 0.5)
    clamp = lambda c, n: F.when(covered, F.least(F.greatest(F.col(c), F.lit(0.0)), F.lit(n - 1.0)))
    placed = placed.select("col", "row", clamp("sx", shape.cols).alias("sx"), clamp("sy", shape.rows).alias("sy"))
    nudge = 0.5 if method == "nearest" else 0.0
    # a target cell outside the source has a place far off, where there is no source block; dropping it by a filter would
    # make the planner repeat the whole projection in the filter
    far = lambda c: -F.lit(1 << 28) - F.floor(F.col(c) / BLOCK) * BLOCK
    at = lambda c, first, away: F.coalesce(F.floor(F.col(c) + nudge) + first, far(away)).cast("int")
    located = placed.select(
        "col", "row", (F.col("sx") + shape.col0).alias("x"), (F.col("sy") + shape.row0).alias("y"),
        at("sx", shape.col0, "col").alias("sc"), at("sy", shape.row0, "row").alias("sr"),
    )
    located = located.withColumns({"x": F.coalesce("x", F.col("sc").cast("double")), "y": F.coalesce("y", F.col("sr").cast("double"))})
    over = lambda c: F.floor(F.col(c) / BLOCK).cast("int")
    asked = _requests(located.withColumns({"bc": over("sc"), "br": over("sr")}), ["bc", "br"])
    # cells over blocks without any source cell keep a row without data
    empty = F.array().cast("array<struct<col:int,row:int,z:double>>")
    met = asked.join(_source_blocks(cells), ["bc", "br"], "left").withColumn("source", F.coalesce("source", empty))
    return _sampled(met, [], method, whole=False)


def tile_utm(tiles: DataFrame) -> DataFrame:
    """Tiles in longitude and latitude with the code of the UTM zone of their centre."""
    lon = (F.col("extent.xmin") + F.col("extent.xmax")) / 2
    lat = (F.col("extent.ymin") + F.col("extent.ymax")) / 2
    return tiles.withColumn("utm_epsg", utm_epsg(lon, lat))


TILE = ("tile_col", "tile_row")


def warp_tiles(tiles: DataFrame, cell_size: float) -> DataFrame:
    """Every tile reprojected on its own to the UTM zone of its centre: ``tile_col tile_row col row z``.

    Each tile gets its own target grid, on whole multiples of the cell size around its projected
    outline, with cells counted from its upper left corner.  Tiles do not see each other.  Packed
    target cells meet their tile in a shuffle, whatever their number.
    """
    lon = (F.col("extent.xmin") + F.col("extent.xmax")) / 2
    lat = (F.col("extent.ymin") + F.col("extent.ymax")) / 2
    zoned = tiles.select(
        *TILE, "extent.*", "cols", "rows",
        (utm_zone(lon) * 6.0 - 183.0).alias("lon0"), F.when(lat >= 0, 0.0).otherwise(10000000.0).alias("south"),
    ).withColumns({"width": (F.col("xmax") - F.col("xmin")) / F.col("cols"), "height": (F.col("ymax") - F.col("ymin")) / F.col("rows")})
    utm = TransverseMercator(F.col("lon0"), false_northing=F.col("south"))

    across, down = F.sequence(F.lit(0), F.col("cols")), F.sequence(F.lit(0), F.col("rows"))
    point = lambda c, r: F.struct((F.col("xmin") + c * F.col("width")).alias("lon"), (F.col("ymax") - r * F.col("height")).alias("lat"))
    outline = F.concat(
        F.transform(across, lambda c: point(c, F.lit(0))), F.transform(across, lambda c: point(c, F.col("rows"))),
        F.transform(down, lambda r: point(F.lit(0), r)), F.transform(down, lambda r: point(F.col("cols"), r)),
    )
    x, y = utm.forward(F.col("p.lon"), F.col("p.lat"))
    frame = [*zoned.columns]
    projected = zoned.select(*frame, F.explode(outline).alias("p")).select(*frame, x.alias("x"), y.alias("y"))
    left, top = F.floor(F.min("x") / cell_size) * cell_size, F.ceil(F.max("y") / cell_size) * cell_size
    framed = projected.groupBy(*frame).agg(left.alias("left"), top.alias("top"), F.max("x").alias("right"), F.min("y").alias("bottom"))

    count = lambda low, high: F.ceil((F.col(high) - F.col(low)) / cell_size).cast("int")
    lines = spread(framed, *TILE).select("*", F.explode(F.sequence(F.lit(0), count("bottom", "top") - 1)).alias("row"))
    grid = lines.select("*", F.explode(F.sequence(F.lit(0), count("left", "right") - 1)).alias("col"))
    lon, lat = utm.inverse(F.col("left") + (F.col("col") + 0.5) * cell_size, F.col("top") - (F.col("row") + 0.5) * cell_size)
    kept = [*TILE, "col", "row", "cols", "rows"]
    located = grid.select(*kept, "xmin", "ymax", "width", "height", lon.alias("lon"), lat.alias("lat"))
    placed = located.select(
        *kept,
        ((F.col("lon") - F.col("xmin")) / F.col("width") - 0.5).alias("sx"),
        ((F.col("ymax") - F.col("lat")) / F.col("height") - 0.5).alias("sy"),
    )
    within = lambda c, n: (F.col(c) >= -0.5) & (F.col(c) < F.col(n) - 0.5)
    clamp = lambda c, n: F.when(within("sx", "cols") & within("sy", "rows"), F.least(F.greatest(F.col(c), F.lit(0.0)), F.col(n) - 1.0))
    placed = placed.select(*TILE, "col", "row", clamp("sx", "cols").alias("sx"), clamp("sy", "rows").alias("sy"))
    # a target cell outside its tile lies on the empty margin of the tile's grid
    outside = lambda c: F.coalesce(F.col(c), F.lit(-1.0))
    located = placed.select(
        *TILE, "col", "row", outside("sx").alias("x"), outside("sy").alias("y"),
        F.floor(outside("sx")).cast("int").alias("sc"), F.floor(outside("sy")).cast("int").alias("sr"))
    # the planner knows the size of the frames, a row for each tile, and not that of their cells, so it would broadcast those
    source = tiles.select(*TILE, "cols", "rows", F.col("cells").alias("source")).hint("merge")
    met = _requests(located, TILE).join(source, list(TILE))
    return _sampled(met, TILE, "bilinear", whole=True)


def projected_slopes(tiles: DataFrame, cell_size: float) -> DataFrame:
    """Slope of every cell of every tile, each in the UTM zone of its own centre."""
    return slope(warp_tiles(tiles, cell_size), cell_size, by=TILE)

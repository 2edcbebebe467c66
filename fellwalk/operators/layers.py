"""Raster layers: cell tables, tile tables, and the metadata of a layer.

A *cell table* has one row per cell: ``col``, ``row`` (row 0 at the top) and a value ``z``, NULL
where there is no data.  A *tile table* has one row per square piece of a layer, with the cell
values as an array in row order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

TILE_SIZE = 256


@dataclass(frozen=True)
class Georeference:
    """Upper left corner, cell size and reference system of a layer."""

    xmin: float
    ymax: float
    cell_width: float
    cell_height: float
    crs: str


@dataclass(frozen=True)
class Shape:
    """First column and row of a layer and its number of columns and rows."""

    col0: int
    row0: int
    cols: int
    rows: int


def shape_of(cells: DataFrame) -> Shape:
    """The shape of a cell table: one aggregate, one row to the driver."""
    found = cells.agg(F.min("col"), F.min("row"), F.max("col"), F.max("row")).first()
    if found[0] is None:
        return Shape(0, 0, 0, 0)
    return Shape(found[0], found[1], found[2] - found[0] + 1, found[3] - found[1] + 1)


def to_tiles(cells: DataFrame, geo: Georeference, tile_size: int = TILE_SIZE) -> DataFrame:
    """Cut a cell table into tiles of at most ``tile_size`` cells a side, at its own resolution.

    Tiles on the right and lower edge are clipped to the layer.  Absent cells become NULL.  A
    tile's list is bounded by the tile size, whatever the size of the layer.
    """
    limits = cells.agg(F.struct(F.max("col").alias("col"), F.max("row").alias("row")).alias("b"))
    size = F.lit(tile_size)
    keyed = cells.select(
        F.floor(F.col("col") / size).cast("int").alias("tile_col"),
        F.floor(F.col("row") / size).cast("int").alias("tile_row"),
        "col", "row", "z",
    ).withColumn("b", limits.scalar())
    cols = F.least(size, F.col("b.col") + 1 - F.col("tile_col") * size)
    rows = F.least(size, F.col("b.row") + 1 - F.col("tile_row") * size)
    at = (F.col("row") - F.col("tile_row") * size) * cols + F.col("col") - F.col("tile_col") * size
    grouped = keyed.groupBy("tile_col", "tile_row", cols.alias("cols"), rows.alias("rows")).agg(
        F.sort_array(F.collect_list(F.struct(at.alias("at"), "z"))).alias("e")
    )
    # each entry is followed by as many NULLs as cells are absent before the next one
    n_cells = F.col("cols") * F.col("rows")
    blanks = lambda count: F.array_repeat(F.lit(None).cast("double"), count.cast("int"))
    following = lambda i: F.coalesce(F.get("e", i + 1)["at"], n_cells)
    filled = F.flatten(F.transform("e", lambda x, i: F.concat(F.array(x["z"]), blanks(following(i) - x["at"] - 1))))
    left, top = F.col("tile_col") * size * geo.cell_width, F.col("tile_row") * size * geo.cell_height
    extent = F.struct(
        (F.lit(geo.xmin) + left).alias("xmin"),
        (F.lit(geo.ymax) - top - F.col("rows") * geo.cell_height).alias("ymin"),
        (F.lit(geo.xmin) + left + F.col("cols") * geo.cell_width).alias("xmax"),
        (F.lit(geo.ymax) - top).alias("ymax"),
    )
    return grouped.select(
        "tile_col", "tile_row", extent.alias("extent"), F.lit(geo.crs).alias("crs"), "cols", "rows",
        F.concat(blanks(F.col("e")[0]["at"]), filled).alias("cells"),
    )


def to_cells(tiles: DataFrame, tile_size: int = TILE_SIZE) -> DataFrame:
    """The cell table of a tile table in the floating layout of ``to_tiles``."""
    opened = tiles.select("tile_col", "tile_row", "cols", F.posexplode("cells").alias("at", "z"))
    return opened.select(
        (F.col("tile_col") * tile_size + F.col("at") % F.col("cols")).cast("int").alias("col"),
        (F.col("tile_row") * tile_size + F.floor(F.col("at") / F.col("cols"))).cast("int").alias("row"),
        "z",
    )


def pieces_to_cells(pieces: DataFrame) -> DataFrame:
    """The cell table of pieces that are placed by their extent only, such as files of one archive."""
    layer = pieces.agg(
        F.struct(
            F.min("extent.xmin").alias("xmin"),
            F.max("extent.ymax").alias("ymax"),
            F.max((F.col("extent.xmax") - F.col("extent.xmin")) / F.col("cols")).alias("width"),
            F.max((F.col("extent.ymax") - F.col("extent.ymin")) / F.col("rows")).alias("height"),
        ).alias("l")
    )
    placed = pieces.withColumn("l", layer.scalar()).select(
        F.round((F.col("extent.xmin") - F.col("l.xmin")) / F.col("l.width")).cast("int").alias("c0"),
        F.round((F.col("l.ymax") - F.col("extent.ymax")) / F.col("l.height")).cast("int").alias("r0"),
        "cols",
        F.posexplode("cells").alias("at", "z"),
    )
    return placed.select(
        (F.col("c0") + F.col("at") % F.col("cols")).cast("int").alias("col"),
        (F.col("r0") + F.floor(F.col("at") / F.col("cols"))).cast("int").alias("row"),
        "z",
    )


def layer_metadata(tiles: DataFrame) -> DataFrame:
    """Extent, cell size, reference system, key bounds, tile count and first key: one row, one aggregate.

    Tiles of different reference systems end the job.
    """
    found = tiles.agg(
        F.count(F.lit(1)).alias("tiles"),
        F.min("crs").alias("crs"),
        F.max("crs").alias("_other"),
        *[F.min(f"extent.{c}").alias(c) for c in ("xmin", "ymin")],
        *[F.max(f"extent.{c}").alias(c) for c in ("xmax", "ymax")],
        F.max((F.col("extent.xmax") - F.col("extent.xmin")) / F.col("cols")).alias("cell_width"),
        F.max((F.col("extent.ymax") - F.col("extent.ymin")) / F.col("rows")).alias("cell_height"),
        *[f(c).alias(f"{n}_{c}") for c in ("tile_col", "tile_row") for n, f in (("min", F.min), ("max", F.max))],
        F.min(F.struct("tile_row", "tile_col")).alias("_first"),
        F.sum(F.col("cols").cast("bigint") * F.col("rows")).alias("cells"),
    )
    single = F.when(F.col("crs") == F.col("_other"), F.col("crs")).otherwise(
        F.when(F.col("crs").isNotNull(), F.raise_error(F.lit("the tiles have different reference systems")).cast("string"))
    )
    return found.withColumn("crs", single).select(
        "*", F.col("_first.tile_col").alias("first_tile_col"), F.col("_first.tile_row").alias("first_tile_row")
    ).drop("_other", "_first")


def window_cells(cells: DataFrame, cols: tuple[int, int], rows: tuple[int, int]) -> DataFrame:
    """The cells of a window, both ends included: a small exact sample to check logic on."""
    return cells.filter(F.col("col").between(*cols) & F.col("row").between(*rows))

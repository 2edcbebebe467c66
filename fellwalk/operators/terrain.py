"""Jobs over the 3x3 neighbourhood of each cell: slope, aspect, hillshade, focal mean.

The raster is cut into blocks.  A cell goes to its own block and, on the edge of one, also to the
neighbour blocks that need it.  One shuffle by block then serves the whole job: the vertical
neighbours meet in a grouping and the horizontal ones in a window, and both reuse the block
partitioning.  A block has a bounded number of cells, so no row or column of a large raster ends
up in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK = 64
COMPASS = ("nw", "n", "ne", "w", "c", "e", "sw", "s", "se")


def neighbourhood(cells: DataFrame, block: int = BLOCK, tile_local: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """Each cell with its eight neighbours as columns ``nw n ne w c e sw s se``; ``c`` is the cell.

    A neighbour that is absent or has no data is NULL.  With ``tile_local`` a cell sees only
    neighbours in its own block of ``block`` cells a side, as when tiles are handled alone.
    Rasters with a grid of their own are told apart by the columns ``by``.
    """
    by = list(by)
    keys = [*by, "bc", "br"]
    size = F.lit(block)
    home = lambda axis: F.floor(axis / size).cast("int")
    if tile_local:
        reach = lambda axis: F.array(home(axis))
    else:
        reach = lambda axis: F.array_distinct(F.array(home(axis - 1), home(axis), home(axis + 1)))
    col, row = F.col("col"), F.col("row")
    placed = cells.select(*by, "col", "row", "z", F.explode(reach(col)).alias("bc")).select(
        "*", F.explode(reach(row)).alias("br")
    )
    blocks = placed.repartition(*keys)

    # the cell above, the cell itself and the cell below, gathered at the row they are seen from
    z = F.col("z")
    none = F.lit(None).cast("double")
    roles = F.array(
        F.struct((row - 1).alias("row"), none.alias("n"), none.alias("c"), z.alias("s"), F.lit(False).alias("own")),
        F.struct(row.alias("row"), none.alias("n"), z.alias("c"), none.alias("s"), F.lit(True).alias("own")),
        F.struct((row + 1).alias("row"), z.alias("n"), none.alias("c"), none.alias("s"), F.lit(False).alias("own")),
    )
    seen = blocks.select(*keys, "col", F.explode(roles).alias("r")).select(*keys, "col", "r.*")
    columns = seen.filter(home(F.col("row")) == F.col("br")).groupBy(*keys, "row", "col").agg(
        *[F.max(c).alias(c) for c in ("n", "c", "s", "own")]
    )
    along = Window.partitionBy(*keys, "row").orderBy("col")
    packed = F.struct("col", "n", "c", "s")
    sides = columns.select("*", F.lag(packed).over(along).alias("_w"), F.lead(packed).over(along).alias("_e"))
    adjacent = lambda side, at: F.when(F.col(f"{side}.col") == at, F.col(side)).alias(side)
    own = sides.filter(F.col("own") & (home(col) == F.col("bc"))).select(
        *by, "col", "row", "n", "c", "s", adjacent("_w", col - 1), adjacent("_e", col + 1)
    )
    field = lambda name, side, part: F.col(f"{side}.{part}").alias(name)
    return own.select(
        *by, "col", "row",
        field("nw", "_w", "n"), "n", field("ne", "_e", "n"),
        field("w", "_w", "c"), "c", field("e", "_e", "c"),
        field("sw", "_w", "s"), "s", field("se", "_e", "s"),
    )


def gradient(around: DataFrame, cell_size: float, z_factor: float = 1.0) -> DataFrame:
    """Change of height per unit to the east (``dx``) and to the south (``dy``), by the weighted 3x3 rule.

    A neighbour without data counts as the height of the cell itself; a cell without data has no
    gradient.  The steps are separate projections, so that no expression repeats another.
    """
    ring = [name for name in COMPASS if name != "c"]
    place = [c for c in around.columns if c not in COMPASS]
    filled = around.select(*place, *[F.when(F.col("c").isNotNull(), F.coalesce(n, "c")).alias(n) for n in ring])
    v = {name: F.col(name) for name in ring}
    scale = F.lit(8.0 * cell_size / z_factor)
    to_east = (v["ne"] + 2 * v["e"] + v["se"]) - (v["nw"] + 2 * v["w"] + v["sw"])
    to_south = (v["sw"] + 2 * v["s"] + v["se"]) - (v["nw"] + 2 * v["n"] + v["ne"])
    return filled.select(*place, (to_east / scale).alias("dx"), (to_south / scale).alias("dy"))


def slope(
    cells: DataFrame, cell_size: float, z_factor: float = 1.0, block: int = BLOCK, tile_local: bool = False, by: Sequence[str] = (),
    with_height: bool = False,
) -> DataFrame:
    """Slope of every cell in degrees; NULL where the cell has no data.  ``with_height`` adds the cell's own ``z``."""
    around = neighbourhood(cells, block, tile_local, by)
    height = ["z"] if with_height else []
    change = gradient(around.withColumn("z", F.col("c")) if with_height else around, cell_size, z_factor)
    return change.select(*by, "col", "row", *height, _steepness().alias("slope"))


def _steepness() -> Column:
    return F.degrees(F.atan(F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy"))))


FLAT = -1.0


def aspect(
    cells: DataFrame, cell_size: float, block: int = BLOCK, tile_local: bool = False, by: Sequence[str] = ()
) -> DataFrame:
    """Downhill direction of every cell in degrees clockwise from north; -1 where it is flat."""
    change = gradient(neighbourhood(cells, block, tile_local, by), cell_size)
    return change.select(*by, "col", "row", _heading().alias("aspect"))


def _heading() -> Column:
    heading = F.pmod(F.lit(450.0) - F.degrees(F.atan2(F.col("dy"), -F.col("dx"))), F.lit(360.0))
    return F.when((F.col("dx") == 0) & (F.col("dy") == 0), F.lit(FLAT)).otherwise(heading)


def slope_and_aspect(
    cells: DataFrame, cell_size: float, block: int = BLOCK, tile_local: bool = False, by: Sequence[str] = ()
) -> DataFrame:
    """Both at once, from one pass over the neighbourhoods."""
    change = gradient(neighbourhood(cells, block, tile_local, by), cell_size)
    return change.select(*by, "col", "row", _steepness().alias("slope"), _heading().alias("aspect"))


def hillshade(
    cells: DataFrame, cell_size: float, azimuth: float = 315.0, altitude: float = 45.0, z_factor: float = 1.0, block: int = BLOCK
) -> DataFrame:
    """Light on every cell from 0 to 255 for a sun at ``azimuth`` (clockwise from north) and ``altitude``.

    A cell without data has none.
    """
    sun, height = math.radians(azimuth), math.radians(altitude)
    # the surface normal (-dx, dy, 1) in east, north, up against the direction to the sun
    light = -F.col("dx") * (math.sin(sun) * math.cos(height)) + F.col("dy") * (math.cos(sun) * math.cos(height)) + math.sin(height)
    change = gradient(neighbourhood(cells, block), cell_size, z_factor)
    shade = light / F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy") + 1.0)
    lit = F.when(shade.isNotNull(), F.greatest(shade, F.lit(0.0)) * 255.0)
    return change.select("col", "row", lit.alias("hillshade"))


def focal_mean(cells: DataFrame, block: int = BLOCK) -> DataFrame:
    """Mean of the cells with data in the 3x3 neighbourhood; NULL where the cell has none."""
    zero = F.lit(0.0)
    total = sum((F.coalesce(F.col(n), zero) for n in COMPASS), zero)
    present = sum((F.when(F.col(n).isNotNull(), 1).otherwise(0) for n in COMPASS), F.lit(0))
    around = neighbourhood(cells, block)
    return around.select("col", "row", F.when(F.col("c").isNotNull(), total / present).alias("focal_mean"))

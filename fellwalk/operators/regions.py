"""Connected regions of a raster."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from fellwalk.operators.components import connected_components, merged_roots
from fellwalk.operators.layers import TILE_SIZE, Shape, shape_of
from fellwalk.workspace import settled

LABEL_SCHEMA = "col int, row int, label bigint"


def label_block(col: np.ndarray, row: np.ndarray, diagonal: bool) -> np.ndarray:
    """Index of the first cell (by row, then column) of each cell's region within one block.

    The cells are grouped into horizontal runs, and runs that touch in neighbouring rows merge.
    """
    order = np.lexsort((col, row))
    c, r = col[order] - col.min(), row[order] - row.min()
    starts = np.ones(len(c), dtype=bool)
    starts[1:] = (r[1:] != r[:-1]) | (c[1:] != c[:-1] + 1)
    run = np.cumsum(starts) - 1

    grid = np.full((r.max() + 2, c.max() + 3), -1, dtype=np.int64)
    grid[r, c + 1] = run
    steps = (0, 1, 2) if diagonal else (1,)
    below = np.concatenate([grid[r + 1, c + s] for s in steps])
    above = np.tile(run, len(steps))
    touching = below >= 0
    root = merged_roots(above[touching], below[touching], run[-1] + 1)

    first_cell = np.flatnonzero(starts)
    result = np.empty(len(c), dtype=np.int64)
    result[order] = order[first_cell[root[run]]]
    return result


def label_regions(
    cells: DataFrame, connectivity: int = 4, tile_size: int = TILE_SIZE, shape: Shape | None = None
) -> DataFrame:
    """Region of each cell in ``cells`` (``col``, ``row``); cells touch on 4 or 8 sides.

    A region's id is the smallest ``row * columns + col`` of its cells.  Each tile is labelled
    on its own by one task; labels that meet across a tile edge become edges of a small graph,
    whose components give the final ids.  Only cells on tile edges take part in that join, and a
    label holds at most one tile of cells, so even a region that covers the layer has no hot key.
    """
    if connectivity not in (4, 8):
        raise ValueError("connectivity is 4 or 8")
    diagonal = connectivity == 8
    shape = shape or shape_of(cells)
    width, col0, row0 = shape.cols, shape.col0, shape.row0

    def label(block: pd.DataFrame) -> pd.DataFrame:
        col, row = block["col"].to_numpy(), block["row"].to_numpy()
        first = label_block(col, row, diagonal)
        ids = (row[first].astype(np.int64) - row0) * width + (col[first].astype(np.int64) - col0)
        return pd.DataFrame({"col": col, "row": row, "label": ids})

    tile = lambda axis: F.floor(F.col(axis) / tile_size)
    blocks = cells.select("col", "row", tile("col").alias("tc"), tile("row").alias("tr")).groupBy("tc", "tr")
    labelled = settled(blocks.applyInPandas(label, LABEL_SCHEMA), "labels")

    roots = connected_components(_meetings(labelled, tile_size, diagonal))
    moved = roots.filter(F.col("node") != F.col("root")).select(F.col("node").alias("label"), "root")
    return labelled.join(moved, "label", "left").select("col", "row", F.coalesce("root", "label").alias("region"))


def _meetings(labelled: DataFrame, tile_size: int, diagonal: bool) -> DataFrame:
    """Pairs of labels whose cells touch across a tile edge."""
    near = [(1, 0), (0, 1), *([(1, 1), (-1, 1)] if diagonal else [])]
    edge = lambda axis: (F.pmod(F.col(axis), F.lit(tile_size)) == 0) | (F.pmod(F.col(axis), F.lit(tile_size)) == tile_size - 1)
    border = labelled.filter(edge("col") | edge("row"))
    targets = F.explode(F.array(*[F.struct((F.col("col") + dc).alias("col"), (F.col("row") + dr).alias("row")) for dc, dr in near]))
    outgoing = border.select(F.col("label").alias("a"), "col", "row", targets.alias("t"))
    tile = lambda axis: F.floor(axis / tile_size)
    crossing = (tile(F.col("col")) != tile(F.col("t.col"))) | (tile(F.col("row")) != tile(F.col("t.row")))
    outgoing = outgoing.filter(crossing).select("a", "t.col", "t.row")
    incoming = border.select("col", "row", F.col("label").alias("b"))
    return outgoing.join(incoming, ["col", "row"]).select("a", "b").filter("a <> b").dropDuplicates()


def slope_regions(
    slopes: DataFrame, max_slope: float = 15.0, connectivity: int = 4, tile_size: int = TILE_SIZE, shape: Shape | None = None
) -> DataFrame:
    """Regions of cells (``col``, ``row``, ``slope``) that are not steeper than ``max_slope``.

    Pass the ``shape`` of the layer where it is known: without it the slopes are scanned once more.
    """
    gentle = slopes.filter(F.col("slope") <= max_slope).select("col", "row")
    return label_regions(gentle, connectivity, tile_size, shape or shape_of(slopes))

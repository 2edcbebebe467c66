"""Which cells of an elevation raster can be seen from one cell."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from fellwalk.operators import zonal
from fellwalk.operators.layers import TILE_SIZE, Shape, shape_of
from fellwalk.operators.regions import slope_regions
from fellwalk.operators.surfaces import peak_cell
from fellwalk.operators.terrain import slope
from fellwalk.workspace import settled

BLOCK = 64
MOST_STEPS = 1 << 20  # steps of sight lines that a task holds at once

BLOCK_ROWS = "bc int, br int, cells array<struct<col:int,row:int,z:double>>"


class Lines:
    """The sight lines from an observer to every border cell, and the steps they make in a block.

    A line is known by its number: the upper border from left to right, the lower one, then the left and the right one
    without corners.  Step ``k`` of a line of ``n`` steps is the cell nearest to the line at ``k / n`` of its length.
    """

    def __init__(self, shape: Shape, col: int, row: int):
        self.west, self.north = shape.col0 - col, shape.row0 - row
        self.east, self.south = self.west + shape.cols - 1, self.north + shape.rows - 1
        self.down = max(shape.rows - 2, 0)
        across = shape.cols
        # first number, whether the border is a row, its offset, and where the other offset starts and how many there are
        self.borders = [(0, True, self.north, self.west, across)]
        if shape.rows > 1:
            self.borders += [
                (across, True, self.south, self.west, across),
                (2 * across, False, self.west, self.north + 1, self.down), (2 * across + self.down, False, self.east, self.north + 1, self.down)]

    def near(self, west: int, north: int, east: int, south: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers and ends of lines that may pass the block of these offsets, few others among them."""
        found = []
        for first, level, fixed, start, count in self.borders:
            (a0, a1), (b0, b1) = ((north, south), (west, east)) if level else ((west, east), (north, south))
            low, high = start, start + count - 1
            if fixed:  # shares of the way to the border at which a line is beside the block, with a cell to spare
                shares = sorted(((a0 - 1) / fixed, (a1 + 1) / fixed))
                if shares[1] < 0 or shares[0] > 1:
                    continue
                if shares[0] > 0:
                    wide = [edge / share for edge in (b0 - 1, b1 + 1) for share in (shares[0], min(1.0, shares[1]))]
                    low, high = max(low, math.floor(min(wide))), min(high, math.ceil(max(wide)))
            if low <= high:
                other = np.arange(low, high + 1)
                ends = np.full(len(other), fixed), other
                found.append((first + other - start, *(ends[::-1] if level else ends)))
        if not found:
            none = np.zeros(0, dtype=np.int64)
            return none, none, none
        number, dc, dr = (np.concatenate(part) for part in zip(*found))
        return number, dc, dr

    def steps(self, west: int, north: int, east: int, south: int):
        """Lines that pass a block, in runs of equal direction: their numbers, the steps beside the block in order, the column
        and row offsets in the block of every line's steps, and whether a step is in it."""
        number, dc, dr = self.near(west, north, east, south)
        n = np.maximum(np.abs(dc), np.abs(dr))
        flat = np.abs(dc) >= np.abs(dr)
        for level in (True, False):
            main, other = (dc, dr) if level else (dr, dc)
            (m0, m1), (o0, o1) = ((west, east), (north, south)) if level else ((north, south), (west, east))
            for sign in (1, -1):
                ks = np.arange(max(1, min(sign * m0, sign * m1)), max(sign * m0, sign * m1) + 1)
                some = np.flatnonzero((flat == level) & (n > 0) & (np.sign(main) == sign))
                run = max(1, MOST_STEPS // max(1, len(ks)))
                for at in range(0, len(some) if len(ks) else 0, run):
                    here = some[at : at + run]
                    size = n[here][:, None]
                    beside = np.floor((2.0 * other[here][:, None] * ks + size) / (2.0 * size)).astype(np.int64)
                    inside = (beside >= o0) & (beside <= o1) & (ks <= size)
                    kept = inside.any(axis=1)
                    along = np.broadcast_to(sign * ks - m0, inside.shape)[kept]
                    aside = np.where(inside, beside - o0, 0)[kept]
                    yield number[here][kept], ks, along if level else aside, aside if level else along, inside[kept]


def _blocks(cells: DataFrame) -> DataFrame:
    """One row for each block of ``BLOCK`` x ``BLOCK`` cells."""
    block = lambda c: F.floor(F.col(c) / BLOCK).cast("int")
    one = F.struct(F.col("col").cast("int").alias("col"), F.col("row").cast("int").alias("row"), F.col("z").cast("double").alias("z"))
    return cells.groupBy(block("col").alias("bc"), block("row").alias("br")).agg(F.collect_list(one).alias("cells"))


def _sights(lines: Lines, col: int, row: int, height: float, cell_size: float, bc: int, br: int, cells):
    """For the runs of :meth:`Lines.steps` in one block: line numbers, steps, cell places, and the tangent of each step (NaN without data)."""
    place = cells.flatten()
    at = (place.field("row").to_numpy() - br * BLOCK) * BLOCK + place.field("col").to_numpy() - bc * BLOCK
    z = np.full(BLOCK * BLOCK, np.nan)
    z[at] = place.field("z").to_numpy(zero_copy_only=False)
    dx, dy = np.meshgrid(np.arange(BLOCK) + float(bc * BLOCK - col), np.arange(BLOCK) + float(br * BLOCK - row))
    with np.errstate(invalid="ignore", divide="ignore"):
        tangent = (z - height) / (np.sqrt(dx * dx + dy * dy).ravel() * cell_size)
    west, north = bc * BLOCK - col, br * BLOCK - row
    for number, ks, x, y, inside in lines.steps(west, north, west + BLOCK - 1, north + BLOCK - 1):
        cell = y * BLOCK + x
        yield number, ks, cell, inside, np.where(inside, tangent[cell], np.nan)


def viewshed(cells: DataFrame, col: int, row: int, cell_size: float, shape: Shape | None = None) -> DataFrame:
    """1 for every cell seen from the cell at ``col``, ``row``, else 0; NULL without data.

    Along each sight line a cell is seen if its angle is not below any nearer one; a cell is
    visible if any line sees it.  Angles are compared by their tangent.

    A block of cells is one row.  Its lines are made in the task that holds it, and only the largest tangent of a line in
    a block leaves it: the lines put these in order and hand each block the largest one before it.  So a line's rows
    are the blocks it passes, not its steps.
    """
    shape = shape or shape_of(cells)
    height = cells.filter((F.col("col") == col) & (F.col("row") == row)).agg(F.max("z")).first()[0]
    own = cells.filter((F.col("col") == col) & (F.col("row") == row)).select(
        F.col("col").cast("int").alias("col"), F.col("row").cast("int").alias("row"), F.when(F.col("z").isNotNull(), 1).alias("visible")
    )
    lines, height = Lines(shape, col, row), math.nan if height is None else float(height)
    blocks = settled(_blocks(cells.filter((F.col("col") != col) | (F.col("row") != row)).select("col", "row", "z")), "blocks")

    def highest(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                bc, br = batch.column("bc")[i].as_py(), batch.column("br")[i].as_py()
                for number, ks, _, inside, tangent in _sights(lines, col, row, height, cell_size, bc, br, batch.column("cells").slice(i, 1)):
                    top = np.fmax.reduce(tangent, axis=1, initial=-np.inf)
                    known = np.flatnonzero(~np.isnan(tangent).all(axis=1))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(known), bc), pa.int32()), pa.array(np.full(len(known), br), pa.int32()), pa.array(number[known]),
                         pa.array(ks[inside.argmax(axis=1)][known]), pa.array(top[known])], names=["bc", "br", "line", "step", "top"])

    tops = blocks.mapInArrow(highest, "bc int, br int, line bigint, step bigint, top double")
    nearer = Window.partitionBy("line").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    before = tops.withColumn("before", F.max("top").over(nearer)).filter("before IS NOT NULL")
    handed = before.groupBy("bc", "br").agg(F.collect_list(F.struct("line", "before")).alias("handed"))

    def seen(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                bc, br, own_cells = batch.column("bc")[i].as_py(), batch.column("br")[i].as_py(), batch.column("cells").slice(i, 1)
                given = batch.column("handed").slice(i, 1).flatten()
                line, value = given.field("line").to_numpy(), given.field("before").to_numpy()
                order = np.argsort(line)
                line, value = np.append(line[order], -1), np.append(value[order], -np.inf)
                met, visible = np.zeros(BLOCK * BLOCK, dtype=bool), np.zeros(BLOCK * BLOCK, dtype=bool)
                for number, _, cell, inside, tangent in _sights(lines, col, row, height, cell_size, bc, br, own_cells):
                    at = np.searchsorted(line[:-1], number)
                    start = np.where(line[at] == number, value[at], -np.inf)
                    before_ = np.fmax.accumulate(np.concatenate([start[:, None], tangent[:, :-1]], axis=1), axis=1)
                    met[cell[inside]] = True
                    visible[cell[inside & (tangent >= before_)]] = True
                place = own_cells.flatten()
                c, r = place.field("col").to_numpy(), place.field("row").to_numpy()
                at = (r - br * BLOCK) * BLOCK + c - bc * BLOCK
                known = place.field("z").is_valid().to_numpy(zero_copy_only=False) & (not math.isnan(height))
                on = met[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[on]), pa.array(r[on]), pa.array(visible[at][on].astype(np.int32), mask=~known[on])], names=["col", "row", "visible"])

    others = blocks.join(handed, ["bc", "br"], "left").withColumn("handed", F.coalesce("handed", F.expr("cast(array() AS array<struct<line:bigint,before:double>>)")))
    return others.mapInArrow(seen, "col int, row int, visible int").unionByName(own)


def peak_viewshed(cells: DataFrame, cell_size: float, shape: Shape | None = None) -> DataFrame:
    """The viewshed from the highest cell; the peak is one row, read by the driver."""
    peak = peak_cell(cells).first()
    return viewshed(cells, peak["col"], peak["row"], cell_size, shape)


def visible_regions(
    cells: DataFrame,
    cell_size: float,
    max_slope: float = 15.0,
    min_visible_percent: float = 30.0,
    connectivity: int = 4,
    tile_size: int = TILE_SIZE,
) -> DataFrame:
    """Gentle regions of which enough cells are seen from the peak: ``col``, ``row``, ``region``.

    Slope, regions, viewshed, the histogram of visibility per region and the share threshold,
    end to end.
    """
    shape = shape_of(cells)
    regions = slope_regions(slope(cells, cell_size), max_slope, connectivity, tile_size, shape)
    zones = regions.withColumnRenamed("region", "zone")
    seen = peak_viewshed(cells, cell_size, shape).withColumnRenamed("visible", "value")
    kept = zonal.zones_with_share(zonal.zonal_histogram(seen, zones), 1, min_visible_percent)
    return zonal.keep_zones(zones, kept).filter(F.col("zone").isNotNull()).withColumnRenamed("zone", "region")

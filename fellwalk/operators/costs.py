"""Cost surfaces, cost distance from a source, and least-cost paths.

The raster is kept as one row per block: its traversal costs with a rim of one cell from the
neighbour blocks.  A round solves the blocks that received better arrivals, and sends the results
on their edges to their neighbours.  Only arrivals on rims are kept between rounds, so the number
of rounds follows the blocks crossed, not the cells, and the state is a small part of the raster.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from fellwalk.operators.joins import salted_lookup
from fellwalk.operators.layers import TILE_SIZE
from fellwalk.workspace import drop_table, fresh_path, settled, settled_at

STRAIGHT = ((0, -1), (-1, 0), (1, 0), (0, 1))
DIAGONAL = ((-1, -1), (1, -1), (-1, 1), (1, 1))
ARRIVAL_SCHEMA = "bc int, br int, col int, row int, distance double"
CELL_SCHEMA = "col int, row int, distance double, from_col int, from_row int"


def cost_surface(
    slopes: DataFrame, per_degree: float = 0.1, max_slope: float | None = None, max_height: float | None = None
) -> DataFrame:
    """Cost of crossing each cell: 1 on the flat, more with slope; NULL where a cell may not be entered.

    ``slopes`` has ``col``, ``row``, ``slope`` and the height ``z``, which is passed on.  Cells
    without data, steeper than ``max_slope`` or higher than ``max_height`` are forbidden.
    """
    allowed = F.col("slope").isNotNull() & F.col("z").isNotNull()
    if max_slope is not None:
        allowed = allowed & (F.col("slope") <= max_slope)
    if max_height is not None:
        allowed = allowed & (F.col("z") <= max_height)
    return slopes.select("col", "row", "z", F.when(allowed, 1.0 + F.col("slope") * per_degree).alias("cost"))


def _moves(connectivity: int) -> tuple[tuple[int, int], ...]:
    if connectivity not in (4, 8):
        raise ValueError("connectivity is 4 or 8")
    return STRAIGHT if connectivity == 4 else (*STRAIGHT, *DIAGONAL)


def _blocks(costs: DataFrame, size: int) -> DataFrame:
    """One row per block: ``bc``, ``br`` and the costs of its cells and rim, no entry as infinity."""
    reach = lambda axis: F.array_distinct(F.array(*[F.floor((F.col(axis) + d) / size).cast("int") for d in (-1, 0, 1)]))
    open_cells = costs.filter(F.col("cost").isNotNull())
    placed = open_cells.select("col", "row", "cost", F.explode(reach("col")).alias("bc"))
    placed = placed.select("*", F.explode(reach("row")).alias("br"))

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        bc, br = int(block["bc"].iloc[0]), int(block["br"].iloc[0])
        grid = np.full((size + 2, size + 2), np.inf)
        grid[block["row"] - br * size + 1, block["col"] - bc * size + 1] = block["cost"]
        packed = pd.DataFrame({"bc": [bc], "br": [br], "grid": [grid.tobytes()]})
        return packed if np.isfinite(grid[1:-1, 1:-1]).any() else packed.iloc[:0]

    return placed.groupBy("bc", "br").applyInPandas(pack, "bc int, br int, grid binary")


def solve_block(cost: np.ndarray, at: np.ndarray, arrival: np.ndarray, moves, cell_size: float) -> np.ndarray:
    """Distances in one block with rim, from the given arrivals; rim cells only pass theirs on.

    Improved cells are expanded in bands of distance, nearest first, until none is left.  The
    rim also keeps offsets that leave the array sideways from reaching an inner cell.
    """
    width = cost.shape[1]
    enterable = np.isfinite(cost)
    enterable[[0, -1], :] = enterable[:, [0, -1]] = False
    enterable, flat_cost = enterable.ravel(), cost.ravel()
    offset = np.array([dy * width + dx for dx, dy in moves])
    half = np.array([cell_size * np.hypot(dx, dy) / 2 for dx, dy in moves])
    usual = flat_cost[enterable].mean() if enterable.any() else 1.0
    band = 2 * cell_size * usual

    distance = np.full(cost.size, np.inf)
    np.minimum.at(distance, at, arrival)
    improved = np.zeros(cost.size, dtype=bool)
    improved[at] = True
    while True:
        front = np.flatnonzero(improved)
        if not front.size:
            return distance.reshape(cost.shape)
        reached = distance[front]
        front = front[reached <= reached.min() + band]
        improved[front] = False
        target = (front[:, None] + offset).ravel()
        source, share = np.repeat(front, len(offset)), np.tile(half, len(front))
        valid = (target >= 0) & (target < cost.size)
        valid[valid] = enterable[target[valid]]
        target, source, share = target[valid], source[valid], share[valid]
        offer = distance[source] + share * (flat_cost[source] + flat_cost[target])
        better = offer < distance[target]
        np.minimum.at(distance, target[better], offer[better])
        improved[target[better]] = True


def _opened(batches: Iterator[pd.DataFrame], size: int, moves, cell_size: float):
    """Each block row of the batches with its costs and solved distances."""
    for batch in batches:
        for bc, br, grid, arrivals in zip(batch["bc"], batch["br"], batch["grid"], batch["arrivals"]):
            cost = np.frombuffer(grid).reshape(size + 2, size + 2)
            col = np.array([a["col"] for a in arrivals]) - bc * size + 1
            row = np.array([a["row"] for a in arrivals]) - br * size + 1
            value = np.array([a["distance"] for a in arrivals])
            yield bc, br, cost, solve_block(cost, row * (size + 2) + col, value, moves, cell_size)


def _edge_results(size: int, moves, cell_size: float):
    """Solve blocks and send what reached their edge cells to the blocks whose rim holds them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for bc, br, _, distance in _opened(batches, size, moves, cell_size):
            own = distance[1:-1, 1:-1]
            edge = np.zeros(own.shape, dtype=bool)
            edge[[0, -1], :] = edge[:, [0, -1]] = True
            row, col = np.nonzero(edge & np.isfinite(own))
            for dy in (-1, 0, 1):
                for dx in (-1, 0, 1):
                    near = {-1: col == 0, 0: col >= 0, 1: col == size - 1}[dx] & {-1: row == 0, 0: row >= 0, 1: row == size - 1}[dy]
                    if (dx or dy) and near.any():
                        c, r = col[near], row[near]
                        yield pd.DataFrame(
                            {"bc": bc + dx, "br": br + dy, "col": c + bc * size, "row": r + br * size, "distance": own[r, c]}
                        )

    return run


def _cell_results(size: int, moves, cell_size: float):
    """Solve blocks and report every reached cell with the neighbour it is best reached from.

    Of equally good neighbours the first by row, then column, is taken.
    """
    ordered = sorted(moves, key=lambda m: (m[1], m[0]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for bc, br, cost, distance in _opened(batches, size, moves, cell_size):
            row, col = np.nonzero(np.isfinite(distance[1:-1, 1:-1]))
            row, col = row + 1, col + 1
            here = distance[row, col]
            from_col, from_row = np.full(len(col), -1), np.full(len(col), -1)
            for dx, dy in ordered:
                r, c = row + dy, col + dx
                through = distance[r, c] + cell_size * np.hypot(dx, dy) / 2 * (cost[r, c] + cost[row, col])
                best = (from_col < 0) & (through == here) & (distance[r, c] < here)
                from_col[best], from_row[best] = c[best], r[best]
            shift_c, shift_r = bc * size - 1, br * size - 1
            unknown = from_col < 0
            origin = lambda v, shift: pd.arrays.IntegerArray((v + shift).astype(np.int32), unknown.copy())
            yield pd.DataFrame(
                {
                    "col": col + shift_c,
                    "row": row + shift_r,
                    "distance": here,
                    "from_col": origin(from_col, shift_c),
                    "from_row": origin(from_row, shift_r),
                }
            )

    return run


def cost_distance(
    costs: DataFrame, sources: DataFrame, cell_size: float = 1.0, connectivity: int = 8, block: int = TILE_SIZE, max_rounds: int | None = None
) -> DataFrame:
    """Least accumulated cost from the nearest source to every reachable cell, and where it comes from.

    Costs are positive.  A step between neighbours costs its length times the mean cost of the two cells.  Columns
    ``col``, ``row``, ``distance``, ``from_col``, ``from_row`` (NULL at a source).  Forbidden or
    unreachable cells are absent.
    """
    moves = _moves(connectivity)
    keys = ["bc", "br", "col", "row"]
    costs = settled(costs.select("col", "row", "cost"), "costs")
    blocks = settled(_blocks(costs, block), "blocks")
    open_sources = sources.select("col", "row").join(costs.filter(F.col("cost").isNotNull()), ["col", "row"], "left_semi")
    home = lambda axis: F.floor(F.col(axis) / block).cast("int")
    starts = open_sources.dropDuplicates().select(home("col").alias("bc"), home("row").alias("br"), "col", "row")
    arrivals, path = settled_at(starts.select("*", F.lit(0.0).alias("distance"), F.lit(True).alias("fresh")), "arrivals")
    for _ in itertools.count() if max_rounds is None else range(max_rounds):
        active = arrivals.filter("fresh").select("bc", "br").dropDuplicates()
        if active.isEmpty():
            return _with_arrivals(blocks, arrivals).mapInPandas(_cell_results(block, moves, cell_size), CELL_SCHEMA)
        ready = _with_arrivals(blocks, arrivals.join(active, ["bc", "br"], "left_semi"))
        sent = ready.mapInPandas(_edge_results(block, moves, cell_size), ARRIVAL_SCHEMA)
        known = arrivals.select(*keys, F.col("distance").alias("old"), F.lit(None).cast("double").alias("offer"))
        offered = sent.select(*keys, F.lit(None).cast("double").alias("old"), F.col("distance").alias("offer"))
        best = known.unionByName(offered).groupBy(*keys).agg(F.min("old").alias("old"), F.min("offer").alias("offer"))
        fresh = F.coalesce(F.col("offer") < F.col("old"), F.col("old").isNull())
        old = path
        arrivals, path = settled_at(best.select(*keys, F.least("old", "offer").alias("distance"), fresh.alias("fresh")), "arrivals")
        drop_table(costs.sparkSession, old)
    raise RuntimeError(f"cost distance did not settle in {max_rounds} rounds")


def _with_arrivals(blocks: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Blocks with the list of their arrivals; a block has at most its rim and own sources."""
    listed = arrivals.groupBy("bc", "br").agg(F.collect_list(F.struct("col", "row", "distance")).alias("arrivals"))
    return blocks.join(listed, ["bc", "br"])


def least_cost_paths(reached: DataFrame, destinations: DataFrame, block: int = TILE_SIZE, max_rounds: int | None = None) -> DataFrame:
    """The cells from each destination back to its source: ``destination``, ``step``, ``col``, ``row``.

    ``reached`` is a cost-distance result, ``destinations`` has ``destination``, ``col``, ``row``.
    Within a block, the way from an entry cell to the cell where it leaves the block is followed by one
    task and shared by all paths that enter there; a round moves every path by one block.  A
    destination that was not reached has no rows.
    """
    home = lambda axis: F.floor(F.col(axis) / block).cast("int")
    moves = settled(reached.select("col", "row", "from_col", "from_row", home("col").alias("bc"), home("row").alias("br")), "reached")
    heads = destinations.select("destination", "col", "row").join(moves.select("col", "row"), ["col", "row"], "left_semi")
    heads, old = heads.withColumn("step", F.lit(0)), None
    heads = settled(heads, "heads")
    # every round adds its part to one folder, so the plan does not grow with the rounds
    folder, schema = fresh_path(reached.sparkSession, "paths"), heads.select("destination", "step", "col", "row").schema
    heads.select("destination", "step", "col", "row").limit(0).write.parquet(folder)
    for _ in itertools.count() if max_rounds is None else range(max_rounds):
        if heads.isEmpty():
            break
        entries = heads.select("col", "row", home("col").alias("bc"), home("row").alias("br")).dropDuplicates()
        ways = entries.groupBy("bc", "br").cogroup(
            moves.join(entries.select("bc", "br").dropDuplicates(), ["bc", "br"], "left_semi").groupBy("bc", "br")
        ).applyInPandas(
            lambda starts, cells: _ways(starts, cells, block), "entry_col int, entry_row int, k int, col int, row int, leaves boolean"
        )
        renamed = heads.withColumnsRenamed({"col": "entry_col", "row": "entry_row"})
        packed = ways.groupBy("entry_col", "entry_row").agg(F.collect_list(F.struct("k", "col", "row", "leaves")).alias("way"))
        walked = salted_lookup(renamed, packed, ["entry_col", "entry_row"], F.col("destination"))
        walked, walked_path = settled_at(
            walked.select("destination", "step", F.explode("way").alias("w")).select(
                "destination", (F.col("step") + F.col("w.k")).alias("step"), "w.col", "w.row", "w.leaves"
            ),
            "walked",
        )
        walked.filter(~F.col("leaves")).select("destination", "step", "col", "row").write.mode("append").parquet(folder)
        drop_table(reached.sparkSession, old)
        heads, old = walked.filter("leaves").select("destination", "col", "row", "step"), walked_path
    else:
        raise RuntimeError(f"paths did not reach their source in {max_rounds} rounds")
    return reached.sparkSession.read.schema(schema).parquet(folder)


def _ways(starts: pd.DataFrame, cells: pd.DataFrame, block: int) -> pd.DataFrame:
    """The way from each start to the source or to the first cell of the next block (``leaves``)."""
    columns = ["entry_col", "entry_row", "k", "col", "row", "leaves"]
    if starts.empty:
        return pd.DataFrame(columns=columns)
    bc, br = int(starts["bc"].iloc[0]), int(starts["br"].iloc[0])
    to_col, to_row = np.full((block, block), -1, dtype=np.int64), np.full((block, block), -1, dtype=np.int64)
    known = cells[cells["from_col"].notna()]
    at = (known["row"].to_numpy() - br * block, known["col"].to_numpy() - bc * block)
    to_col[at], to_row[at] = known["from_col"].to_numpy(dtype=np.int64), known["from_row"].to_numpy(dtype=np.int64)
    # all starts advance together; one that has left or arrived drops out
    entry_col, entry_row = starts["col"].to_numpy(), starts["row"].to_numpy()
    col, row, k, parts = entry_col.copy(), entry_row.copy(), 0, []
    while len(col):
        inside = (col // block == bc) & (row // block == br)
        parts.append(pd.DataFrame(dict(zip(columns, (entry_col, entry_row, k, col, row, ~inside)))))
        entry_col, entry_row, col, row = entry_col[inside], entry_row[inside], col[inside], row[inside]
        next_col, next_row = to_col[row - br * block, col - bc * block], to_row[row - br * block, col - bc * block]
        going = next_col >= 0
        entry_col, entry_row, col, row = entry_col[going], entry_row[going], next_col[going], next_row[going]
        k += 1
    return pd.concat(parts, ignore_index=True)

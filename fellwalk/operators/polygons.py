"""Polygon jobs: bounds, tile cover, sample grids, points within polygons, rasterising.

A region is one row with all of its rings, as in a feature file.  The jobs work on its *edge
table*: ``region``, ``seq``, ``x1``, ``y1``, ``x2``, ``y2``, one row per side, with the
region's bounding box in ``xmin``, ``ymin``, ``xmax``, ``ymax``.

No job pairs all points or boxes with all sides.  A grid is filled line by line: every side is
sent to the grid lines it crosses, the crossings of a line are counted per grid position, and the
positions between an odd and an even crossing are inside.  The work grows with the length of the
outline and the size of the result, and one large region is spread over its lines.
"""

from __future__ import annotations

import functools
import math
import operator

from pyspark.sql import Column, DataFrame, Window, functions as F

from fellwalk.operators.joins import balanced_lookup, salted_lookup
from fellwalk.session import spread
from fellwalk.workspace import settled

BOX = ("xmin", "ymin", "xmax", "ymax")
SIDES = ("x1", "y1", "x2", "y2")


def ring_edges(regions: DataFrame, rings: str = "rings") -> DataFrame:
    """The edge table of regions whose column ``rings`` is an array of rings of ``(x, y)`` structs.

    A ring may be closed or not.  The bounding box comes from the row itself.  Sides are spread
    over the cluster, because a few long ones can become many grid lines.
    """
    points = F.flatten(rings)
    axis = lambda name: F.transform(points, lambda p: p[name])
    box = [F.array_min(axis("x")), F.array_min(axis("y")), F.array_max(axis("x")), F.array_max(axis("y"))]

    def sides(ring: Column) -> Column:
        start = lambda i: F.get(ring, i)
        end = lambda i: F.get(ring, (i + 1) % F.size(ring))
        return F.transform(
            F.sequence(F.lit(0), F.size(ring) - 1),
            lambda i: F.struct(
                start(i)["x"].alias("x1"), start(i)["y"].alias("y1"), end(i)["x"].alias("x2"), end(i)["y"].alias("y2")
            ),
        )

    boxed = regions.select("region", rings, *[c.alias(n) for c, n in zip(box, BOX)])
    whole = F.filter(rings, lambda ring: F.size(ring) > 1)
    edges = boxed.select("region", *BOX, F.posexplode(F.flatten(F.transform(whole, sides))).alias("seq", "s"))
    edges = edges.select("region", "seq", "s.*", *BOX).filter((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))
    return spread(edges, "region", "seq")


def vertex_edges(vertices: DataFrame) -> DataFrame:
    """The edge table of closed rings given as ``region``, ``seq``, ``x``, ``y`` rows.

    Each vertex meets the next by an equi-join on its number, so a long ring is not sorted by
    one task; the box of a region is looked up with a salt.
    """
    start = vertices.select("region", "seq", F.col("x").alias("x1"), F.col("y").alias("y1"))
    end = vertices.select("region", (F.col("seq") - 1).alias("seq"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    box = vertices.groupBy("region").agg(
        F.min("x").alias("xmin"), F.min("y").alias("ymin"), F.max("x").alias("xmax"), F.max("y").alias("ymax")
    )
    edges = start.join(end, ["region", "seq"])
    return salted_lookup(edges, box, ["region"], F.col("seq")).select("region", "seq", *SIDES, *BOX)


def bounds(edges: DataFrame, *by: str) -> DataFrame:
    """Bounding box per region, or of all regions together."""
    return edges.groupBy(*by).agg(*[F.min(c).alias(c) for c in BOX[:2]], *[F.max(c).alias(c) for c in BOX[2:]])


def _first_beyond(x: Column, origin: Column, step: Column) -> Column:
    """Number of the first grid position that is greater than ``x``, by comparing the positions themselves."""
    near = F.floor((x - origin) / step)
    past = lambda k: origin + (near + k) * step > x
    return F.when(past(-1), near - 1).when(past(0), near).when(past(1), near + 1).otherwise(near + 2)


def _side_at(y: Column) -> Column:
    """Where a side is at a height, exact at its ends; NULL for a level side between them."""
    x1, y1, x2, y2 = (F.col(c) for c in SIDES)
    along = x1 + F.try_divide((y - y1) * (x2 - x1), y2 - y1)
    clamped = F.when(along.isNotNull(), F.least(F.greatest(along, F.least(x1, x2)), F.greatest(x1, x2)))
    return F.when(y == y1, x1).when(y == y2, x2).otherwise(clamped)


GRID = ("gx", "gdx", "gnx", "gy", "gdy", "gny")


def with_grid(edges: DataFrame, gx, gdx, gnx, gy, gdy, gny) -> DataFrame:
    """The edges with a grid: position ``i`` lies at ``gx + i * gdx`` for ``i`` below ``gnx``, likewise ``j``."""
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    kinds = ("double", "double", "bigint") * 2
    values = zip(GRID, (gx, gdx, gnx, gy, gdy, gny), kinds)
    return edges.select("*", *[as_column(v).cast(kind).alias(name) for name, v, kind in values])


def grid_inside(gridded: DataFrame, strict: bool = True) -> DataFrame:
    """Grid positions inside each region: ``region``, ``i``, ``j`` and the grid columns.

    With ``strict`` positions exactly on the outline are left out.
    """
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    left, right = F.least("x1", "x2"), F.greatest("x1", "x2")
    line = lambda y: F.floor((y - F.col("gy")) / F.col("gdy"))
    first, last = F.greatest(line(low) - 1, F.lit(0)), F.least(line(high) + 1, F.col("gny") - 1)
    swept = gridded.filter(first <= last).select("region", *SIDES, *GRID, F.explode(F.sequence(first, last)).alias("j"))
    swept = swept.withColumn("y", F.col("gy") + F.col("j") * F.col("gdy")).filter(F.col("y").between(low, high))
    rise = F.col("y2") - F.col("y1")
    crossed = swept.withColumn("x", F.when(rise != 0, _side_at(F.col("y")))).withColumn("open", (rise != 0) & (F.col("y") < high))

    # an event changes sides at a position, or marks a position that lies on the outline
    column = lambda x: F.floor((x - F.col("gx")) / F.col("gdx"))
    position = lambda i: F.col("gx") + i * F.col("gdx")
    beyond = F.least(F.greatest(_first_beyond(F.col("x"), F.col("gx"), F.col("gdx")), F.lit(0)), F.col("gnx"))
    event = lambda i, turns, on: F.struct(i.cast("bigint").alias("i"), F.lit(turns).alias("turns"), F.lit(on).alias("on"))
    turn = F.when(F.col("open"), F.array(event(beyond, 1, False)))
    events = turn
    if strict:
        lo_x, hi_x = F.coalesce(F.col("x"), left), F.coalesce(F.col("x"), right)
        reach = F.sequence(F.greatest(column(lo_x) - 1, F.lit(0)), F.greatest(F.least(column(hi_x) + 1, F.col("gnx") - 1), F.lit(0)))
        on_side = F.transform(F.filter(reach, lambda i: position(i).between(lo_x, hi_x)), lambda i: event(i, 0, True))
        events = F.concat(F.coalesce(turn, F.array().cast("array<struct<i:bigint,turns:int,on:boolean>>")), on_side)
    placed = crossed.select("region", "j", *GRID, F.explode(events).alias("e")).select("region", "j", *GRID, "e.*")

    merged = placed.groupBy("region", "j", "i", *GRID).agg((F.sum("turns") % 2).alias("turns"), F.max("on").alias("on"))
    along = Window.partitionBy("region", "j").orderBy("i")
    spans = merged.filter((F.col("turns") == 1) | F.col("on")).select(
        "region", "j", *GRID, (F.sum("turns").over(along) % 2).alias("inside"),
        (F.col("i") + F.when(F.col("on"), 1).otherwise(0)).alias("start"), (F.lead("i").over(along) - 1).alias("stop"),
    )
    filled = spans.filter((F.col("inside") == 1) & (F.col("start") <= F.col("stop")))
    filled = spread(filled.select("region", "j", *GRID, "start", "stop"), "region", "j", "start")
    return filled.select("region", F.explode(F.sequence("start", "stop")).alias("i"), "j", *GRID)


ARANGE_MARGIN = 1e-12


def sample_grid(edges: DataFrame, step: float) -> DataFrame:
    """The edges with the sample grid of their region: ``step`` degrees from its lower left corner.

    Positions follow the floating-point rule of a half-open numeric range up to the upper bound
    plus a small margin, which is what decides whether the last line counts as inside.
    """
    if step <= 0:
        raise ValueError("the step must be positive")
    length = lambda lo, hi: F.greatest(F.ceil((F.col(hi) + ARANGE_MARGIN - F.col(lo)) / step), F.lit(0))
    spacing = lambda lo: (F.col(lo) + step) - F.col(lo)
    return with_grid(
        edges, F.col("xmin"), spacing("xmin"), length("xmin", "xmax"), F.col("ymin"), spacing("ymin"), length("ymin", "ymax")
    )


def region_samples(edges: DataFrame, step: float, require_points: bool = False) -> DataFrame:
    """Sample points strictly inside each region: ``region``, ``lon``, ``lat``.

    With ``require_points`` the job fails where no point of any region falls inside.
    """
    points = grid_inside(sample_grid(edges, step)).select(
        "region",
        (F.col("gx") + F.col("i") * F.col("gdx")).alias("lon"),
        (F.col("gy") + F.col("j") * F.col("gdy")).alias("lat"),
    )
    if require_points and points.isEmpty():
        raise ValueError("no sample point falls inside the regions; try a smaller step")
    return points


def united_samples(regions: DataFrame, step: float) -> DataFrame:
    """Sample points of whole region files: ``document``, ``lon``, ``lat``.

    ``regions`` has ``document``, ``region`` and ``rings``, as region files are read.  The grid of a file
    starts at the lower left corner of all its features; a point counts once, if it lies strictly
    inside any of them.
    """
    edges = ring_edges(regions.select(F.struct("document", "region").alias("region"), "rings"))
    placed = edges.drop(*BOX).withColumn("document", F.col("region.document"))
    boxed = salted_lookup(placed, bounds(edges.withColumn("document", F.col("region.document")), "document"), ["document"], F.col("seq"))
    inside = grid_inside(sample_grid(boxed, step)).withColumn("document", F.col("region.document"))
    points = inside.dropDuplicates(["document", "i", "j"])
    return points.select(
        "document", (F.col("gx") + F.col("i") * F.col("gdx")).alias("lon"), (F.col("gy") + F.col("j") * F.col("gdy")).alias("lat")
    )


def sample_counts(edges: DataFrame, step: float) -> DataFrame:
    """Grid candidates and points inside, per region."""
    gridded = sample_grid(edges, step)
    candidates = gridded.groupBy("region").agg(F.first(F.col("gnx") * F.col("gny")).alias("candidates"))
    inside = grid_inside(gridded).groupBy("region").agg(F.count(F.lit(1)).alias("inside"))
    return candidates.join(inside, "region", "left").select("region", "candidates", F.coalesce("inside", F.lit(0)).alias("inside"))


def _walk(edges: DataFrame, size: float, parts: int = 0) -> DataFrame:
    """Each side with every tile of the given size that it touches, as ``tx`` and ``ty``.

    With ``parts`` the sides have a tile already, of ``parts`` times the size, and only its own parts are walked.
    """
    def touch(low: Column, high: Column, tile: str) -> Column:
        first, last = F.ceil(low / size) - 1, F.floor(high / size)
        if parts:
            first, last = F.greatest(first, F.col(tile) * parts), F.least(last, F.col(tile) * parts + parts - 1)
        return F.when(first <= last, F.sequence(first, last))

    left, right = F.least("x1", "x2"), F.greatest("x1", "x2")
    outer = [f"_{t}" for t in ("tx", "ty") if parts]
    edges = edges.withColumnsRenamed({t: f"_{t}" for t in ("tx", "ty")}) if parts else edges
    walked = edges.select("*", F.explode(touch(left, right, "_tx")).alias("tx"))
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")

    def height_at(x: Column) -> Column:
        along = F.col("y1") + F.try_divide((x - F.col("x1")) * (F.col("y2") - F.col("y1")), F.col("x2") - F.col("x1"))
        within = F.least(F.greatest(along, low), high)
        return F.when(x == F.col("x1"), F.col("y1")).when(x == F.col("x2"), F.col("y2")).otherwise(within)

    upright = F.col("x1") == F.col("x2")
    enter, leave = F.greatest(left, F.col("tx") * size), F.least(right, (F.col("tx") + 1) * size)
    ya = F.when(upright, F.col("y1")).otherwise(height_at(enter))
    yb = F.when(upright, F.col("y2")).otherwise(height_at(leave))
    heights = walked.withColumn("_a", ya).withColumn("_b", yb)
    return heights.select("*", F.explode(touch(F.least("_a", "_b"), F.greatest("_a", "_b"), "_ty")).alias("ty")).drop("_a", "_b", *outer)


def tile_cover(edges: DataFrame) -> DataFrame:
    """The 1-degree tiles that touch each region: ``region``, ``lon``, ``lat`` of the lower left corner.

    Tiles on the outline come from walking each side through the tiles it touches; tiles
    without outline are inside or outside as a whole and are decided at their centre.  Tiles
    beyond the rounded bounds of the region, which it can only touch, are left out.
    """
    outline = _walk(edges, 1.0).filter(
        (F.col("tx") >= F.floor("xmin")) & (F.col("tx") < F.ceil("xmax"))
        & (F.col("ty") >= F.floor("ymin")) & (F.col("ty") < F.ceil("ymax"))
    )
    west, south = F.floor("xmin"), F.floor("ymin")
    centred = with_grid(edges, west + 0.5, 1.0, F.ceil("xmax") - west, south + 0.5, 1.0, F.ceil("ymax") - south)
    filled = grid_inside(centred, strict=False).select(
        "region", F.floor(F.col("gx") + F.col("i")).alias("tx"), F.floor(F.col("gy") + F.col("j")).alias("ty")
    )
    tiles = outline.select("region", "tx", "ty").unionByName(filled).dropDuplicates()
    return tiles.select("region", F.col("tx").cast("int").alias("lon"), F.col("ty").cast("int").alias("lat"))


def missing_tiles(tiles: DataFrame, present: DataFrame) -> DataFrame:
    """Tiles whose name is not among the names present."""
    return tiles.join(present.select("tile").dropDuplicates(), "tile", "left_anti")


def tile_rings(tiles: DataFrame) -> DataFrame:
    """Tiles with the closed ring of their box as a coordinate array, for a GeoJSON sink."""
    corner = lambda dx, dy: F.array((F.col("lon") + dx).cast("double"), (F.col("lat") + dy).cast("double"))
    return tiles.withColumn("ring", F.array(*[corner(dx, dy) for dx, dy in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))]))


# A tile is split into 8 x 8 parts while more sides touch it, down to parts so small that only a common corner can be left.
SIDES_MOST, PARTS, LEVELS = 64, 8, 7
TILE = ("tx", "ty")


def _spans(y: Column) -> Column:
    """Whether a side crosses a height, its upper end left out."""
    y1, y2 = F.col("y1"), F.col("y2")
    return (y1 != y2) & (F.least(y1, y2) <= y) & (y < F.greatest(y1, y2))


def _with_way(sides: DataFrame, edge_x: Column, base_y: Column, y: Column) -> DataFrame:
    """Sides with ``here``, where they are at the height ``y``, and ``climbs``, whether they are crossed on the way up along the
    left edge of a tile, from ``base_y`` to ``y``.

    What is used more than once is a column of its own, so the plan holds it once.
    """
    x1, y1, x2, y2 = (F.col(c) for c in SIDES)
    edge, base, top, start, stop = (F.col(c) for c in ("_edge", "_base", "_top", "_start", "_stop"))
    ends = sides.withColumns({"_edge": edge_x, "_base": base_y, "_top": y}).withColumns(
        {"_start": F.greatest(base, F.least(y1, y2)), "_stop": F.least(top, F.greatest(y1, y2))})
    placed = ends.withColumns({"here": _side_at(top), "_from": _side_at(start), "_to": _side_at(stop)})
    climbs = F.when(y1 == y2, (base < y1) & (y1 <= top) & ((x1 < edge) != (x2 < edge))).otherwise(
        (start <= stop) & ((F.col("_from") < edge) != (F.col("_to") < edge)))
    return placed.withColumn("climbs", climbs).drop("_edge", "_base", "_top", "_start", "_stop", "_from", "_to")


def _corner_turns(sides: DataFrame, size: float) -> DataFrame:
    """For each region and tile 64 bits, one for the lower left corner of each part: whether an odd number of sides is crossed on
    the way there from the tile's own.

    ``size`` is that of a part.  The way goes up along the left edge and then across, so the bits of a row of parts are
    turned as a whole by the climb, and from the first part beyond the crossing on.  Each side is a row for each row of parts.
    """
    every = (1 << PARTS) - 1
    rows = sides.select("*", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("j"))
    rows = rows.withColumns({"edge_x": F.col("tx") * PARTS * size, "base_y": F.col("ty") * PARTS * size})
    rows = rows.withColumn("y", F.col("base_y") + F.col("j") * size)
    edge_x, here = F.col("edge_x"), F.col("here")
    rows = _with_way(rows, edge_x, F.col("base_y"), F.col("y")).withColumn("beyond", _first_beyond(here, edge_x, F.lit(size)))
    beyond = F.least(F.greatest("beyond", F.lit(0)), F.lit(PARTS)).cast("int")
    crossed = F.when(_spans(F.col("y")) & (here >= edge_x), F.call_function("shiftleft", F.lit(every), beyond).bitwiseAND(every)).otherwise(0)
    row = crossed.bitwiseXOR(F.when(F.col("climbs"), every).otherwise(0)).cast("bigint")
    turns = F.call_function("shiftleft", row, F.col("j") * PARTS)
    return rows.groupBy("region", *TILE).agg(F.bit_xor(turns).alias("turns"), F.max("parts").alias("parts"))


def _states(corners: DataFrame, sides: DataFrame) -> DataFrame:
    """The tiles of each region whose corner is inside or that a side touches, with ``corner`` and ``touched``."""
    marked = lambda df, corner, touched: df.select("region", *TILE, F.lit(corner).alias("corner"), F.lit(touched).alias("touched"))
    both = marked(corners, 1, False).unionByName(marked(sides, 0, True))
    return both.groupBy("region", *TILE).agg(F.max("corner").alias("corner"), F.max("touched").alias("touched"))


def side_tree(points: DataFrame, edges: DataFrame, size: float = 0.25, most: int = SIDES_MOST) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """A quadtree over the sides of regions, where there are points: the points with every tile they are in, the number of points
    of these tiles, the sides of the leaves, and the whole leaves.

    The tiles of level 0 have ``size`` (a power of two), those of the next level an eighth of it.  A tile with points that more than
    ``most`` sides touch is split; its sides go on to the parts that they touch and that hold points, and the sides crossed on the
    way to the corner of a part tell whether that is inside.  Sides that lie over each other are so followed to the places of
    points and no further.  Leaves have ``level``, ``tx``, ``ty``, ``region``, the side, and ``corner``, the state of
    the lower left corner; whole leaves are inside and touched by no side of that region.
    """
    if math.frexp(size)[0] != 0.5:
        raise ValueError("the size must be a power of two")
    west, south = F.floor(F.col("xmin") / size), F.floor(F.col("ymin") / size)
    across, up = F.floor(F.col("xmax") / size) - west + 1, F.floor(F.col("ymax") / size) - south + 1
    corners = grid_inside(with_grid(edges, west * size, size, across, south * size, size, up), strict=False).select(
        "region", F.round(F.col("gx") / size + F.col("i")).cast("bigint").alias("tx"),
        F.round(F.col("gy") / size + F.col("j")).cast("bigint").alias("ty"),
    )
    sides = _walk(edges, size).select("region", *SIDES, *TILE)
    here = points.select("point", "x", "y")
    part = lambda *tile: functools.reduce(operator.add, [F.pmod(t, F.lit(PARTS)) * PARTS**i for i, t in enumerate(tile)])
    holds = lambda parts, k: F.call_function("getbit", parts, k) == 1
    reached, peopled, leaves, wholes = [], [], [], []
    for level in range(LEVELS + 1):
        at = F.lit(level).alias("level")
        tile = lambda axis, size=size: F.floor(F.col(axis) / F.lit(size)).cast("bigint")
        inner_tile = [tile(axis, size / PARTS) for axis in ("x", "y")]
        placed = here.select(at, "point", "x", "y", *[tile(axis).alias(name) for axis, name in zip(("x", "y"), TILE)])
        one = F.call_function("shiftleft", F.lit(1).cast("bigint"), part(*inner_tile).cast("int"))
        places = settled(placed.groupBy(*TILE).agg(F.count(F.lit(1)).alias("n"), F.bit_or(one).alias("parts")), "places")
        reached.append(placed)
        peopled.append(places.select(at, *TILE, "n"))

        sides = settled(sides, "sides")
        states = settled(_states(corners, sides), "states")
        wholes.append(states.filter(~F.col("touched")).select(at, *TILE, "region"))
        outline = states.filter("touched").select("region", *TILE, "corner")
        counted = sides.groupBy(*TILE).agg(F.count(F.lit(1)).alias("n"))
        busy = (F.col("n") > most) & F.lit(level < LEVELS)
        tiles = settled(counted.withColumn("busy", busy).join(places.select(*TILE, "parts").hint("merge"), [*TILE]), "tiles")
        flagged = balanced_lookup(sides, tiles.drop("n"), TILE, F.struct(*SIDES), counts=tiles.select(*TILE, "n"), hint="merge")
        kept = flagged.filter(~F.col("busy")).select("region", *SIDES, *TILE)
        leaves.append(kept.join(outline.hint("merge"), ["region", *TILE]).select(at, *TILE, "region", *SIDES, "corner"))
        split = tiles.filter("busy").select(*TILE)
        if split.isEmpty():
            break
        size /= PARTS
        inner = settled(flagged.filter("busy").select("region", *SIDES, *TILE, "parts"), "split-sides")
        turned = outline.join(_corner_turns(inner, size).hint("merge"), ["region", *TILE]).withColumn(
            "inside", F.col("turns").bitwiseXOR(F.when(F.col("corner") == 1, -1).otherwise(0).cast("bigint")).bitwiseAND(F.col("parts")))
        parts = turned.select("region", *TILE, "inside", F.explode(F.sequence(F.lit(0), F.lit(PARTS**2 - 1))).alias("k")).filter(holds(F.col("inside"), F.col("k")))
        corners = parts.select(
            "region", (F.col("tx") * PARTS + F.col("k") % PARTS).alias("tx"), (F.col("ty") * PARTS + F.floor(F.col("k") / PARTS)).alias("ty"))
        sides = _walk(inner, size, PARTS).filter(holds(F.col("parts"), part(*map(F.col, TILE)).cast("int"))).select("region", *SIDES, *TILE)
        deeper = balanced_lookup(placed, split, TILE, F.col("point"), counts=places.select(*TILE, "n"), hint="merge")
        here = settled(deeper.select("point", "x", "y"), "points")
    union = lambda frames: functools.reduce(DataFrame.unionByName, frames)
    return union(reached), union(peopled), union(leaves), union(wholes)


def points_and_sides(points: DataFrame, edges: DataFrame, size: float = 0.25, most: int = SIDES_MOST) -> tuple[DataFrame, DataFrame]:
    """Points with the sides in their leaf of the :func:`side_tree` and its corner's state, and points with the regions that
    cover their tile.  A point meets at most ``most`` sides, unless more meet in one corner."""
    placed, counts, leaves, wholes = side_tree(points, edges, size, most)
    meet = lambda lookup: balanced_lookup(placed, lookup, ["level", *TILE], F.col("point"), counts=counts, hint="merge")
    return meet(leaves), meet(wholes).select("point", "region")


def points_within(points: DataFrame, edges: DataFrame, size: float = 0.25, most: int = SIDES_MOST) -> DataFrame:
    """Pairs of point and region where the point is strictly inside: ``point``, ``region``.

    ``points`` has ``point``, ``x``, ``y``.  Points and sides meet in the leaves of a quadtree over the sides, so a
    point sees few sides however fine the outlines are.  Whether the lower left corner of a leaf is
    inside is known for each region; going from there along the left edge of the leaf to the
    height of the point, and then across to the point, every side that is crossed changes the
    answer.  A leaf that no side touches is inside as a whole or not at all.  The points of a
    busy tile are salted.
    """
    met, certain = points_and_sides(points, edges, size, most)
    x, y, x1, y1, x2, y2, here = (F.col(c) for c in ("x", "y", *SIDES, "here"))
    extent = F.lit(size) / F.pow(F.lit(float(PARTS)), F.col("level"))
    crosses = _spans(y) & (here >= F.col("tx") * extent) & (here < x)
    on_side = F.when(y1 == y2, (y == y1) & x.between(F.least(x1, x2), F.greatest(x1, x2))).otherwise(
        y.between(F.least(y1, y2), F.greatest(y1, y2)) & (here == x))
    # the way to the point keeps left of it and below
    near = met.filter((F.col("corner") == 1) | ((F.least(x1, x2) <= x) & (F.least(y1, y2) <= y)))
    passed = _with_way(near, F.col("tx") * extent, F.col("ty") * extent, y).select(
        "point", "region", "corner", (F.col("climbs") != F.coalesce(crosses, F.lit(False))).alias("turns"), on_side.alias("on"))
    # a side that is not crossed says nothing about a region whose corner is outside
    telling = passed.filter((F.col("corner") == 1) | F.col("turns") | F.col("on"))
    verdict = telling.groupBy("point", "region").agg(F.max("corner").alias("corner"), F.count_if("turns").alias("turns"), F.max("on").alias("on"))
    inside = ((F.col("corner") + F.col("turns")) % 2 == 1) & ~F.col("on")
    return verdict.filter(inside).select("point", "region").unionByName(certain)


def rasterised(edges: DataFrame, cols: int, rows: int) -> DataFrame:
    """Cells of a layer whose centre lies in a region: ``region``, ``col``, ``row``.

    Coordinates of the edges are in cells, from the upper left corner of the layer.
    """
    inside = grid_inside(with_grid(edges, 0.5, 1.0, cols, 0.5, 1.0, rows))
    return inside.select("region", F.col("i").cast("int").alias("col"), F.col("j").cast("int").alias("row"))


def line_cells(lines: DataFrame, cols: int, rows: int) -> DataFrame:
    """Distinct cells of a layer that lines pass through, for lines given as an edge table in cells.

    Only the steps of a line near the layer are made, and lines are dealt out before that.
    """
    cell = lambda c: F.floor(c).cast("int")
    ends = lines.select(
        cell(F.col("x1")).alias("c1"), cell(F.col("y1")).alias("r1"),
        (cell(F.col("x2")) - cell(F.col("x1"))).alias("dc"), (cell(F.col("y2")) - cell(F.col("y1"))).alias("dr"),
    ).withColumn("n", F.greatest(F.abs("dc"), F.abs("dr")))

    def reach(start: str, delta: str, size: int) -> tuple[Column, Column]:
        """First and last step near the layer along one axis, with a cell to spare."""
        step = F.col("n") / F.abs(delta)
        before = F.when(F.col(delta) > 0, -1 - F.col(start)).otherwise(F.col(start) - size) * step
        behind = F.when(F.col(delta) > 0, size - F.col(start)).otherwise(F.col(start) + 1) * step
        still = F.col(delta) == 0
        return F.when(still, 0).otherwise(F.floor(before) - 1), F.when(still, F.col("n")).otherwise(F.ceil(behind) + 1)

    (col_from, col_to), (row_from, row_to) = reach("c1", "dc", cols), reach("r1", "dr", rows)
    ends = ends.withColumns({"k1": F.greatest(F.lit(0), col_from, row_from).cast("int"), "k2": F.least("n", col_to, row_to).cast("int")})
    near = spread(ends.filter("k1 <= k2"), "c1", "r1", "dc", "dr")
    stepped = near.select("*", F.explode(F.sequence("k1", "k2")).alias("k"))
    share = F.greatest(F.col("n"), F.lit(1))
    at = lambda start, delta: (F.col(start) + F.floor((2.0 * F.col(delta) * F.col("k") + share) / (2.0 * share))).cast("int")
    cells = stepped.select(at("c1", "dc").alias("col"), at("r1", "dr").alias("row"))
    inside = F.col("col").between(0, cols - 1) & F.col("row").between(0, rows - 1)
    return cells.filter(inside).dropDuplicates()


def zone_statistics(slopes: DataFrame, zones: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """Mean and variance of the height, the largest slope, and the rank by roughness per region, roughest first.

    Regions of equal variance (to nine places) share a rank.  With ``regions`` (column ``region``)
    those without a cell are kept, with a count of 0 and the last rank.  ``slopes`` has the
    height ``z`` beside the slope, ``zones`` is the result of :func:`rasterised`; they meet by
    the cell, which no region can skew.  The heights of a region are gathered line by line, so a row
    holds at most one line of the layer.
    """
    # the planner knows the size of the outlines and not that of the cells in them, so it would broadcast those
    joined = zones.join(slopes.select("col", "row", "z", "slope").hint("merge"), ["col", "row"])
    # sums run line by line, each in the order of its cells, so regions of the same cells have the same variance to the last bit
    total = lambda values, of: F.aggregate(values, F.lit(0.0), lambda s, x: s + of(x))
    gathered = lambda there, *names: F.sort_array(F.collect_list(F.when(there, F.struct(*names))))
    lines = joined.groupBy("region", "row").agg(
        gathered(F.col("z").isNotNull(), "col", F.col("z").cast("double").alias("z")).alias("cells"), F.max("slope").alias("max_slope"))
    lines = lines.withColumn("n", F.size("cells")).withColumn("mean", F.when(F.col("n") > 0, total("cells", lambda c: c["z"]) / F.col("n")))
    lines = lines.withColumn("squares", total("cells", lambda c: (c["z"] - F.col("mean")) * (c["z"] - F.col("mean"))))
    whole = lines.groupBy("region").agg(
        gathered(F.col("n") > 0, "row", "n", "mean", "squares").alias("lines"), F.sum("n").alias("n"), F.max("max_slope").alias("max_slope"))
    whole = whole.withColumn("mean_z", F.when(F.col("n") > 0, total("lines", lambda k: k["n"] * k["mean"]) / F.col("n")))
    squares = total("lines", lambda k: k["squares"] + k["n"] * (k["mean"] - F.col("mean_z")) * (k["mean"] - F.col("mean_z")))
    stats = whole.select("region", "n", "mean_z", F.when(F.col("n") > 0, squares / F.col("n")).alias("var_z"), "max_slope")
    if regions is not None:
        stats = regions.select("region").dropDuplicates().join(stats, "region", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    # one row per region, so the window is as small as the result
    rank = F.rank().over(Window.orderBy(F.round("var_z", 9).desc_nulls_last())).alias("rank")
    return stats.select("*", rank).orderBy("rank", "region")

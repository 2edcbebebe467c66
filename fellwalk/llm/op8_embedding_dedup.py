"""Embedding near-deduplication by a robust-pruned flat graph, label by label.

1. Equal vectors of a label are one **class**; a class stands for its copies from here on.
2. **Overlapping shards.** A label with more than ``SPLIT_FROM`` classes is parted by pivots, classes drawn by hash, and every
   class joins its ``OVERLAP`` nearest pivots; a shard that still has more than ``SHARD_MOST`` is parted again. Of pivots within
   ``THIN`` of each other one stays, so a dense group is not cut between its own members; a shard whose parts would not take
   clearly fewer comparisons (``PART_GAIN``) stays whole.
3. **Graph.** In a shard every class gets its nearest and some random classes as candidates; robust pruning keeps one unless a
   kept one is nearer to it by the factor ``ALPHA``, which leaves long edges between clusters. The lists of all shards are united, and edges lead both ways.
4. **Search.** In every shard, each class walks the united graph from the shard's medoids to its own neighbourhood, best first,
   and then expands every class found in range until no new one turns up. All cosines are taken in double precision, so a
   link is verified as it is found. A pair that shares several shards counts in the first of them. Whole shards of more than
   ``SHARD_MOST`` classes have no graph: they are compared block by block, a task for every two blocks of ``COMPARED``.
5. Counts are summed per class, a shard gives a spanning forest of its links, and connected components close them.
6. :func:`audit` holds the links of hash-drawn classes against all classes of their label and gives the recall.

Pairs are counted where they are found and never written out.

Nulls and odd input: a null label, and vectors that are null, empty, zero or hold null or non-finite components, link with
nothing; vectors of different lengths do not link; rows that share a ``vec_id`` are vectors of their own, and a row with a null
one counts as a partner; an empty table gives no rows; columns of other names are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fellwalk.llm.common import lean, rooted, runs_of, settle_llm, width
from fellwalk.llm.vectors import cosines, matrix, unit, usable
from fellwalk.operators.components import connected_components
from fellwalk.workspace import settled

SIMILAR = 0.93
SPLIT_FROM, SHARD_MOST, SHARD_AIM, OVERLAP = 896, 4096, 128, 5
NEAR, RANDOM, DEGREE, ALPHA = 32, 8, 16, 1.2
BEAM, MEDOIDS = 12, 24
ASSIGN_ROWS = 8192
THIN, PART_GAIN = 0.6, 0.25
COMPARED = 8192  # classes of a block of a dense shard
REACH = float(np.sqrt(2 - 2 * SIMILAR))  # between unit vectors


def _classes(df: DataFrame) -> DataFrame:
    """``label, vector, dim, node, copies``: one row per different vector of a label."""
    rows = df.filter(F.col("label").isNotNull() & usable(F.col("embedding")))
    rows = rows.select(F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("vector"))
    grouped = rows.groupBy("label", "vector").agg(F.count(F.lit(1)).alias("copies"))
    return grouped.select(F.xxhash64("label", "vector").alias("node"), "label", F.size("vector").alias("dim"), "vector", "copies")


def _thinned(pivots: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pivots, in the order of their names, that are not within ``THIN`` of one before."""
    order, kept = np.argsort(names), []
    likeness = pivots @ pivots.T
    for i in order:
        if not kept or likeness[i, kept].max() < THIN:
            kept.append(i)
    return pivots[kept], names[kept]


def _nearest_pivots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, cell``: the new shards of each class; a group's pivots come before its classes."""
    group, pivots, names, around = None, [], [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(n).to_numpy() for n in ("cell", "salt", "kind")], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for start, end in zip(cuts, cuts[1:]):
            some = batch.slice(start, end - start)
            if tuple(keys[start, :2]) != group:
                group, pivots, names, around = tuple(keys[start, :2]), [], [], None
            vectors, nodes = unit(matrix(some.column("vector"))), some.column("node").to_numpy()
            if not keys[start, 2]:
                pivots.append(vectors)
                names.append(nodes)
                continue
            if pivots:
                if len(pivots) > 1 or around is None:
                    around, called = _thinned(np.concatenate(pivots), np.concatenate(names))
                    pivots, names = [around], [called]
                wanted = min(OVERLAP, len(called))
                likeness = vectors @ around.T
                nearest = np.argsort(-likeness, axis=1, kind="stable")[:, :wanted]
                # with every pivot at hand, one is joined only if a partner can be nearest to it: by the distance to the plane between
                joined = np.ones(nearest.shape, dtype=bool)
                if wanted == len(called):
                    there = np.take_along_axis(likeness, nearest, axis=1)
                    apart = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * around @ around.T))[nearest[:, :1], nearest]
                    joined = there[:, :1] - there <= REACH * apart + 1e-9
                row, place = np.nonzero(joined)
                cells = called[nearest[row, place]]
            else:  # no pivot was drawn: the shard stays whole
                row, cells = np.arange(len(nodes)), np.zeros(len(nodes), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(nodes[row]), pa.array(keys[start:end, 0][row]), pa.array(cells)],
                names=["node", "cell", "pivot"])


def _shards(classes: DataFrame) -> DataFrame:
    """``node, cell, size``: the overlapping shards of every class, and how many classes each shard has."""
    spark = classes.sparkSession
    placed, done = classes.select("node", F.xxhash64("label", "dim").alias("cell")), []
    most = SPLIT_FROM
    while True:
        sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("_size"))
        sized = settled(placed.join(sizes, "cell"), "cells")
        largest = sized.agg(F.max("_size")).first()[0] or 0
        if largest <= most:
            done.append(sized)
            break
        done.append(sized.filter(F.col("_size") <= most))
        large = sized.filter(F.col("_size") > most)
        crowded = large.join(classes.select("node", "vector"), "node")
        salts = F.ceil(F.col("_size") / ASSIGN_ROWS).cast("int")
        drawn = F.pmod(F.xxhash64(F.lit(len(done)), "node"), F.lit(1 << 30)) < F.lit(float(1 << 30)) * F.least(F.lit(256.0), F.col("_size") / SHARD_AIM) / F.col("_size")
        pivots = crowded.filter(drawn).select("cell", F.explode(F.sequence(F.lit(0).cast("long"), salts.cast("long") - 1)).alias("salt"), F.lit(0).cast("long").alias("kind"), "node", "vector")
        members = crowded.select("cell", F.pmod(F.xxhash64("node"), salts).cast("long").alias("salt"), F.lit(1).cast("long").alias("kind"), "node", "vector")
        dealt = pivots.unionByName(members).repartition(width(spark), "cell", "salt").sortWithinPartitions("cell", "salt", "kind")
        assigned = settled(dealt.mapInArrow(_nearest_pivots, "node bigint, cell bigint, pivot bigint"), "assigned")
        # a shard stays whole unless its parts take clearly fewer comparisons, so every round makes shards smaller
        parts = assigned.groupBy("cell", "pivot").agg(F.count(F.lit(1)).cast("double").alias("n")).groupBy("cell").agg(F.sum(F.col("n") * F.col("n")).alias("cost"))
        whole = parts.join(sizes, "cell").filter(F.col("cost") > PART_GAIN * F.col("_size") * F.col("_size")).select("cell")
        done.append(large.join(whole, "cell", "left_semi"))
        placed, most = assigned.join(whole, "cell", "left_anti").select("node", F.xxhash64("cell", "pivot").alias("cell")), SHARD_MOST
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("node", "cell", F.col("_size").alias("size")).dropDuplicates()


def pruned_neighbours(points: np.ndarray) -> np.ndarray:
    """Up to ``DEGREE`` neighbours of every unit vector by robust pruning; -1 fills short rows."""
    n = len(points)
    if n < 2:
        return np.full((n, 1), -1)
    near, rng = min(NEAR, n - 1), np.random.default_rng(n)
    candidates = np.empty((n, near + RANDOM), dtype=np.int64)
    rows = max(1, (1 << 22) // n)
    for start in range(0, n, rows):
        likeness = points[start : start + rows] @ points.T
        likeness[np.arange(len(likeness)), np.arange(start, start + len(likeness))] = -np.inf
        candidates[start : start + rows, :near] = np.argpartition(-likeness, near - 1, axis=1)[:, :near]
    candidates[:, near:] = rng.integers(0, n, size=(n, RANDOM))
    out = np.full((n, DEGREE), -1)
    for start in range(0, n, 512):
        own = np.arange(start, min(n, start + 512))
        some = candidates[own]
        to_own = 1.0 - np.einsum("nd,ncd->nc", points[own], points[some])
        order = np.argsort(to_own, axis=1, kind="stable")
        some, to_own = np.take_along_axis(some, order, axis=1), np.take_along_axis(to_own, order, axis=1)
        alive = some != own[:, None]
        between = 1.0 - np.einsum("ncd,nkd->nck", points[some], points[some])
        for k in range(DEGREE):
            left = alive.any(axis=1)
            if not left.any():
                break
            best = np.argmax(alive, axis=1)
            out[own[left], k] = some[np.arange(len(own)), best][left]
            covered = ALPHA * np.take_along_axis(between, best[:, None, None], axis=1)[:, 0] <= to_own
            alive &= ~covered
            alive[np.arange(len(own)), best] = False
    return out


def _graph(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, neighbours`` of every class of each shard."""
    for table in runs_of(batches, ["cell"]):
        nodes = table.column("node").to_numpy()
        found = pruned_neighbours(unit(matrix(table.column("vector"))))
        lists = [nodes[row[row >= 0]].tolist() for row in found]
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(lists, pa.list_(pa.int64()))], names=["node", "neighbours"])


def in_range(points: np.ndarray, start: np.ndarray, neighbours: np.ndarray, queries: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Cosines of the ``queries`` (rows of ``points``) to the rows their walks have met; -inf elsewhere.

    Row ``i`` has the neighbours ``neighbours[start[i] : start[i + 1]]``. From the entries on, a walk expands what is among the
    ``BEAM`` best it has met, and whatever is in range, until it has expanded all of them.
    """
    count, n = len(queries), len(points)
    seen = np.full((count, n), -np.inf)
    open_ = np.zeros((count, n), dtype=bool)
    seen[:, entries] = cosines(points[queries], points[entries])
    open_[:, entries] = True
    beam, active = max(0, n - BEAM), np.arange(count)
    while len(active):
        some = seen[active]
        border = np.partition(some, beam, axis=1)[:, beam]
        row, node = np.nonzero(open_[active] & ((some >= border[:, None]) | (some >= SIMILAR)))
        if not len(row):
            break
        open_[active[row], node] = False
        degree = np.diff(start)[node]
        new = np.zeros((len(active), n), dtype=bool)
        cuts = np.searchsorted(np.cumsum(degree), np.arange(0, int(degree.sum()) + 1, 1 << 20))
        for a, b in zip(cuts, [*cuts[1:], len(node)]):
            d = degree[a:b]
            met = neighbours[np.repeat(start[node[a:b]] - (np.cumsum(d) - d), d) + np.arange(int(d.sum()))]
            new[np.repeat(row[a:b], d), met] = True
        who, met = np.nonzero(new & np.isneginf(some))
        who = active[who]
        for at in range(0, len(who), 1 << 15):
            a, b = who[at : at + (1 << 15)], met[at : at + (1 << 15)]
            seen[a, b] = np.einsum("nd,nd->n", points[queries[a]], points[b])
        open_[who, met] = True
        active = active[np.unique(row)]
    return seen


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``node, root, n``: the copies linked to a class in this shard, and a tree of the shard's links."""
    for table in runs_of(batches, ["cell"]):
        n, cell = table.num_rows, table.column("cell")[0].as_py()
        if n < 2:
            continue
        nodes, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        points = unit(matrix(table.column("vector")))
        order = np.argsort(nodes)
        lists = table.column("neighbours").combine_chunks()
        flat, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        place = np.clip(np.searchsorted(nodes[order], flat), 0, n - 1)
        here = nodes[order][place] == flat  # neighbours of other shards are not here
        owner = np.repeat(np.arange(n), np.diff(ends))[here]
        local = order[place][here]
        # both directions, so that no class is without a way in
        edges = np.unique(np.concatenate([owner * n + local, local * n + owner]))
        start, neighbours = np.searchsorted(edges, np.arange(n + 1) * n), edges % n
        # medoids: the class nearest to the middle, and those nearest to the middles of hash-like slices
        slices = np.array_split(np.argsort(nodes * 1), min(MEDOIDS, n))
        middles = np.stack([points.mean(axis=0), *[points[s].mean(axis=0) for s in slices]])
        entries = np.unique(np.append(np.argmax(middles @ points.T, axis=1), [s[0] for s in slices]))
        # other shards that a class is in: a pair counts in the smallest shard of both
        others = table.column("cells").to_pylist()
        earlier = [frozenset(c for c in cells if c < cell) for cells in others]
        kinds = {e: i for i, e in enumerate(set(earlier))}
        kind = np.asarray([kinds[e] for e in earlier])
        names = sorted(kinds, key=kinds.get)
        counted = np.asarray([[not (a & b) for b in names] for a in names])
        linked, first, second = np.zeros(n, dtype=np.int64), [], []
        rows = max(1, min(512, (1 << 22) // n))
        for first_query in range(0, n, rows):
            queries = np.arange(first_query, min(n, first_query + rows))
            near = in_range(points, start, neighbours, queries, entries) >= SIMILAR
            near[np.arange(len(queries)), queries] = False
            linked[queries] = (near & counted[kind[queries]][:, kind]) @ copies
            a, b = np.nonzero(near)
            if len(a):
                node, root = rooted(nodes[queries[a]], nodes[b])
                first.append(node[node != root])
                second.append(root[node != root])
        if first:
            node, root = rooted(np.concatenate(first), np.concatenate(second))
            yield pa.RecordBatch.from_arrays([pa.array(node[node != root]), pa.array(root[node != root]), pa.nulls(int((node != root).sum()), pa.int64())], names=["node", "root", "n"])
        some = np.flatnonzero(linked)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.nulls(len(some), pa.int64()), pa.array(linked[some])], names=["node", "root", "n"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """As :func:`_search`, for two blocks of a dense shard: every class of one against every class of the other."""
    for table in runs_of(batches, ["cell", "first", "second"]):
        cell, one, two = (table.column(n)[0].as_py() for n in ("cell", "first", "second"))
        block = table.column("block").to_numpy()
        nodes, copies = table.column("node").to_numpy(), table.column("copies").to_numpy().astype(float)
        points = unit(matrix(table.column("vector")))
        left, right = np.flatnonzero(block == one), np.flatnonzero(block == two)
        earlier = [[c for c in cells if c < cell] for cells in table.column("cells").to_pylist()]
        columns = {c: i for i, c in enumerate(sorted({c for cells in earlier for c in cells}))}
        in_earlier = np.zeros((len(nodes), len(columns)), dtype=np.float32)
        for i, cells in enumerate(earlier):
            in_earlier[i, [columns[c] for c in cells]] = 1
        linked, group = np.zeros(len(nodes)), np.arange(len(nodes))
        others, other_copies = points[right], copies[right]
        for start in range(0, len(left), 512):
            own = left[start : start + 512]
            likeness = points[own] @ others.T
            near = likeness >= SIMILAR
            a, b = np.nonzero(np.abs(likeness - SIMILAR) < 1e-9)  # summed in the order of all other cosines
            near[a, b] = np.einsum("nd,nd->n", points[own[a]], others[b]) >= SIMILAR
            if one == two:
                near[np.arange(len(own)), np.arange(start, start + len(own))] = False
            a, b = np.nonzero(near & (group[own][:, None] != group[right][None, :]))
            if len(a):
                name, root = rooted(group[own[a]], group[right[b]])
                new = np.arange(len(nodes))
                new[name] = root
                group = new[group]
            if columns:  # a pair that shares an earlier shard counts there
                near &= (in_earlier[own] @ in_earlier[right].T) == 0
            near = near.astype(float)
            linked[own] += near @ other_copies
            if one != two:
                linked[right] += copies[own] @ near
        apart, some = np.flatnonzero(group != np.arange(len(nodes))), np.flatnonzero(linked)
        yield pa.RecordBatch.from_arrays([pa.array(nodes[apart]), pa.array(nodes[group[apart]]), pa.nulls(len(apart), pa.int64())], names=["node", "root", "n"])
        yield pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.nulls(len(some), pa.int64()), pa.array(linked[some].astype(np.int64))], names=["node", "root", "n"])


def class_links(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``node, n`` (copies of other classes linked to each class) and ``node, root`` (components of the links)."""
    spark = classes.sparkSession
    placed = settled(_shards(classes), "shards")
    small, dense = placed.filter(F.col("size") <= SHARD_MOST), placed.filter(F.col("size") > SHARD_MOST)
    in_shards = small.join(classes.select("node", "vector", "copies"), "node")
    dealt = in_shards.select("cell", "node", "vector").repartition(width(spark), "cell").sortWithinPartitions("cell")
    lists = dealt.mapInArrow(lean(_graph), "node bigint, neighbours array<bigint>")
    united = lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours"))
    cells = placed.groupBy("node").agg(F.collect_list("cell").alias("cells"))
    described = classes.select("node", "vector", "copies").join(cells, "node")
    blocks = F.ceil(F.col("size") / COMPARED).cast("int")
    blocked = dense.join(described, "node").withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    paired = blocked.withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "cell", F.least("block", "_other").alias("first"), F.greatest("block", "_other").alias("second"), "block", "node", "vector", "copies", "cells")
    facing = paired.repartition(width(spark), "cell", "first", "second").sortWithinPartitions("cell", "first", "second")
    compared = facing.mapInArrow(lean(_compare), "node bigint, root bigint, n bigint")
    described = described.join(united, "node", "left")
    filled = described.withColumn("neighbours", F.coalesce("neighbours", F.array().cast("array<bigint>")))
    full = small.join(filled, "node").select("cell", "node", "vector", "copies", "cells", "neighbours")
    searched = full.repartition(width(spark), "cell").sortWithinPartitions("cell").mapInArrow(lean(_search), "node bigint, root bigint, n bigint")
    found = settled(searched.unionByName(compared), "found")
    counts = found.filter("n IS NOT NULL").groupBy("node").agg(F.sum("n").alias("n"))
    edges = found.filter("root IS NOT NULL").select(F.col("node").alias("a"), F.col("root").alias("b"))
    return counts, connected_components(edges)


def groups(df: DataFrame) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    settle_llm(df.sparkSession)
    classes = settled(_classes(df), "classes")
    counts, roots = class_links(classes)
    described = classes.select("node", "copies").join(counts, "node", "left").join(roots, "node", "left").select(
        "node", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("_component"))
    part = F.col("label").isNotNull() & usable(F.col("embedding"))
    rows = df.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.when(part, F.xxhash64(F.col("label").cast("string"), F.col("embedding").cast("array<double>"))).alias("node"))
    marked = rows.filter("node IS NOT NULL").join(described, "node")
    smallest = marked.groupBy("_component").agg(F.min("vec_id").alias("component_id"))
    linked = marked.join(smallest, "_component").select("vec_id", "n_links", "component_id")
    alone = rows.filter("node IS NULL").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def audit(df: DataFrame, found: DataFrame, share: float = 0.01) -> float:
    """Recall of the links of hash-drawn vectors: theirs in ``found`` against a comparison with all of their label, in blocks."""
    spark = settle_llm(df.sparkSession)
    rows = df.filter(F.col("label").isNotNull() & usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    rows = rows.select(F.xxhash64(F.col("label").cast("string"), F.size("embedding")).alias("cell"), "vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    salts = 16
    asked = rows.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < share * (1 << 20)).select(
        "cell", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("kind"), "vec_id", "vector")
    others = rows.select("cell", F.pmod(F.xxhash64("vec_id"), F.lit(salts)).cast("int").alias("salt"), F.lit(1).alias("kind"), "vec_id", "vector")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs_of(batches, ["cell", "salt"]):
            kind, names, points = table.column("kind").to_numpy(), table.column("vec_id").to_numpy(), unit(matrix(table.column("vector")))
            near = (cosines(points[kind == 0], points[kind == 1]) >= SIMILAR) & (names[kind == 0][:, None] != names[kind == 1][None, :])
            yield pa.RecordBatch.from_arrays([pa.array(names[kind == 0]), pa.array(near.sum(axis=1).astype(np.int64))], names=["vec_id", "n"])

    dealt = asked.unionByName(others).repartition(width(spark), "cell", "salt").sortWithinPartitions("cell", "salt")
    true = dealt.mapInArrow(count, "vec_id bigint, n bigint").groupBy("vec_id").agg(F.sum("n").alias("n"))
    both = true.join(found.select("vec_id", "n_links"), "vec_id").agg(F.sum("n"), F.sum(F.least("n", "n_links"))).first()
    return both[1] / both[0] if both[0] else 1.0

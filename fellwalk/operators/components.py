"""Connected components of a graph given as edges."""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import DataFrame, functions as F

from fellwalk.operators.joins import salted_lookup
from fellwalk.workspace import drop_table, settled, settled_at

def merged_roots(first: np.ndarray, second: np.ndarray, count: int) -> np.ndarray:
    """Smallest member of each group when ``first[i]`` and ``second[i]`` belong together."""
    root = np.arange(count)
    while True:
        a, b = root[first], root[second]
        apart = a != b
        if not apart.any():
            return root
        np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (root[root] != root).any():
            root = root[root]


def connected_components(edges: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """Columns ``node`` and ``root``, the smallest node of its component, for every node of an edge.

    ``edges`` has ``a`` and ``b``.  Every round contracts the graph: each node hangs under the neighbour that comes first in
    an order drawn anew for the round, or stays if it comes first itself, and paths are halved.  Edges are renamed to what
    their ends hang under, loops go and repeated edges become one, so nodes and edges fall by a constant factor
    a round whatever the shape, and what is settled is not read again.  Afterwards the rounds are
    resolved from the last to the first, each over its own nodes only.  Popular nodes are looked up with
    a salt, and neighbours are combined before the shuffle.  Every round is written out, which cuts the lineage.
    Rounds go on until no edge is left, or for ``max_rounds`` if given.
    """
    spark = edges.sparkSession
    pair = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    graph, path = settled_at(edges.select(*pair("a", "b")).dropDuplicates(), "edges")
    alone = graph.filter("a = b").select("a").dropDuplicates()
    left, maps = graph.filter("a <> b"), []
    for round_ in itertools.count():
        if left.isEmpty():
            break
        if max_rounds is not None and round_ >= max_rounds:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        place = lambda node: F.struct(F.xxhash64(node, F.lit(round_)).alias("place"), F.col(node).alias("node"))  # noqa: B023, E731
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = both.groupBy("a").agg(F.min(place("b")).alias("first"))
        hung = first.select(F.col("a").alias("node"), F.least(place("a"), F.col("first")).alias("f")).select("node", F.col("f.node").alias("up"))
        above = hung.select(F.col("node").alias("up"), F.col("up").alias("top"))
        maps.append(settled(salted_lookup(hung, above, ["up"], F.col("node")).select("node", F.col("top").alias("up")), "hung"))
        ends = lambda side, to: maps[-1].select(F.col("node").alias(side), F.col("up").alias(to))
        renamed = salted_lookup(salted_lookup(left, ends("a", "x"), ["a"], F.col("b")), ends("b", "y"), ["b"], F.col("a"))
        old = path
        left, path = settled_at(renamed.filter("x <> y").select(*pair("x", "y")).dropDuplicates(), "edges")
        if round_:
            drop_table(spark, old)
    if not maps:
        return alone.select(F.col("a").alias("node"), F.col("a").alias("root"))
    found = maps[-1]
    for earlier in reversed(maps[:-1]):
        # a node of a round hangs under one that later rounds know, or that was settled with it
        later = found.select(F.col("node").alias("up"), F.col("up").alias("top"))
        found = settled(salted_lookup(earlier, later, ["up"], F.col("node"), "left").select("node", F.coalesce("top", "up").alias("up")), "resolved")
    smallest = found.groupBy("up").agg(F.min("node").alias("root"))
    rooted = salted_lookup(found, smallest, ["up"], F.col("node")).select("node", "root")
    loops = alone.select(F.col("a").alias("node")).join(found.select("node"), "node", "left_anti").withColumn("root", F.col("node"))
    return settled(rooted.unionByName(loops), "roots")

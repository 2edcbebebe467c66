"""Approximate nearest neighbours by vantage-point trees, one per shard.

Vectors are dealt evenly over shards of about ``SHARD_ROWS``. A task builds the tree of a shard (a vantage point, the median
distance to it, the nearer and the farther half, and so on down to leaves), then streams all queries past it in blocks and
gives the ``k`` best of the shard; the best over all shards are merged. Distances are chords of unit vectors, which order as
cosines do and obey the triangle inequality.

A query at distance d from a vantage point with median m needs the other half only if the sphere of its k-th best distance t
crosses the border: ``|d - m| <= factor * t``. Factor one is exact; a smaller one skips halves the sphere only just reaches.
All of a block's queries walk the tree together, each node with the queries that still need it.

Nulls and odd input: vectors that are null, empty, zero or hold null or non-finite components, and rows without ``vec_id``, take
no part, neither as query nor as candidate; vectors of different lengths are not compared; rows that share a ``vec_id`` are
one vector, by their best score, and never their own neighbour; equal scores go to the smaller ``vec_id``; fewer candidates
than ``k`` give fewer rows; an empty table gives none; columns of other names are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from fellwalk.llm.common import settle_llm, width
from fellwalk.llm.vectors import cosines, matrix, unit, usable_vectors
from fellwalk.workspace import settled

SHARD_ROWS = 4096
LEAF = 128
FACTOR = 0.9
QUERY_BLOCK = 512
ROUNDING = 1e-7  # chords of nearly equal vectors lose about half the digits


class VantageTree:
    """A tree over unit vectors sorted by id: ``(vantage, median, nearer, farther)``, or the rows of a leaf."""

    def __init__(self, points: np.ndarray, ids: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.points, self.ids = points[order], ids[order]
        self.root = self._build(np.random.default_rng(1).permutation(len(points)))
        self.compared = 0

    def _build(self, rows: np.ndarray):
        if len(rows) <= LEAF:
            return rows
        vantage, rest = rows[0], rows[1:]
        distance = chords(cosines(self.points[rest], self.points[vantage : vantage + 1])[:, 0])
        middle = np.median(distance)
        near = distance <= middle
        if near.all():  # more than half are equally far
            return rows
        return vantage, middle, self._build(rest[near]), self._build(rest[~near])

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the ``k`` best for each query, best first; -inf where there are fewer. ``own`` ids are left out."""
        scores = np.full((len(queries), k), -np.inf)
        found = np.full((len(queries), k), np.iinfo(np.int64).max)

        def offer(active: np.ndarray, rows: np.ndarray) -> None:
            self.compared += len(active) * len(rows)
            # a fast product finds what may enter the best; the scores that are kept are summed in one order for all
            row, col = np.nonzero(queries[active] @ self.points[rows].T >= scores[active, -1:] - ROUNDING)
            others = own[active[row]] != self.ids[rows[col]]
            row, col = row[others], col[others]
            if not len(row):
                return
            exact = np.einsum("nd,nd->n", queries[active[row]], self.points[rows[col]])
            hit, place = np.unique(row, return_inverse=True)
            count = np.bincount(place)
            wide = (len(hit), k + int(count.max()))
            all_scores, all_ids = np.full(wide, -np.inf), np.full(wide, np.iinfo(np.int64).max)
            all_scores[:, :k], all_ids[:, :k] = scores[active[hit]], found[active[hit]]
            at = k + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            all_scores[place, at], all_ids[place, at] = exact, self.ids[rows[col]]
            best = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
            scores[active[hit]] = np.take_along_axis(all_scores, best, axis=1)
            found[active[hit]] = np.take_along_axis(all_ids, best, axis=1)

        def visit(node, active: np.ndarray) -> None:
            if not len(active):
                return
            if isinstance(node, np.ndarray):
                for start in range(0, len(node), 1024):
                    offer(active, node[start : start + 1024])
                return
            vantage, middle, near, far = node
            offer(active, np.asarray([vantage]))
            distance = chords(cosines(queries[active], self.points[vantage : vantage + 1])[:, 0])
            inside = distance <= middle
            visit(near, active[inside])
            visit(far, active[~inside])
            reach = np.where(np.isinf(scores[active, -1]), np.inf, factor * chords(scores[active, -1])) + ROUNDING
            crossed = np.abs(distance - middle) <= reach
            visit(far, active[inside & crossed])
            visit(near, active[~inside & crossed])

        visit(self.root, np.arange(len(queries)))
        return scores, found


def chords(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * np.where(np.isinf(cosine), -1.0, cosine)))


def search(vectors: DataFrame, queries: DataFrame, k: int, factor: float = FACTOR, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of ``vectors`` for each of ``queries`` (both ``vec_id, embedding``)."""
    spark = settle_llm(vectors.sparkSession)
    usable = settled(usable_vectors(vectors), "vectors")
    shards = max(1, -(-usable.count() // shard_rows))
    # dealt row by row: no id or value can fill a shard; written, so that every later run sees the same deal
    indexed = settled(usable.repartition(shards).withColumn("shard", F.spark_partition_id()), "shards")
    asked = usable_vectors(queries).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, points, ids, tree = None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(n).to_numpy() for n in ("shard", "dim", "asks")], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for start, end in zip(cuts, cuts[1:]):
                some = batch.slice(start, end - start)
                if tuple(keys[start, :2]) != group:
                    group, points, ids, tree = tuple(keys[start, :2]), [], [], None
                vectors_, names = unit(matrix(some.column("vector"))), some.column("vec_id").to_numpy()
                if not keys[start, 2]:
                    points.append(vectors_)
                    ids.append(names)
                    continue
                if not points:
                    continue
                tree = tree or VantageTree(np.concatenate(points), np.concatenate(ids))
                for first in range(0, len(names), QUERY_BLOCK):
                    part = slice(first, first + QUERY_BLOCK)
                    scores, found = tree.search(vectors_[part], names[part], k, factor)
                    real = np.isfinite(scores)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(names[part], k)[real.ravel()]), pa.array(found[real]), pa.array(scores[real])],
                        names=["query_id", "vec_id", "score"])

    rows = indexed.select("shard", "dim", F.lit(0).alias("asks"), "vec_id", "vector").unionByName(
        asked.select("shard", "dim", F.lit(1).alias("asks"), "vec_id", "vector"))
    dealt = rows.repartition(width(spark), "shard", "dim").sortWithinPartitions("shard", "dim", "asks")
    found = dealt.mapInArrow(find, "query_id bigint, vec_id bigint, score double")
    single = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return single.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def recall(vectors: DataFrame, queries: DataFrame, found: DataFrame, k: int) -> float:
    """Share of the true ``k`` best scores of some queries that ``found`` reaches; the queries go in blocks past all rows."""
    exact = search(vectors, queries, k, factor=float("inf"))
    both = exact.select("query_id", "rank", F.col("score").alias("_true")).join(found.select("query_id", "rank", "score"), ["query_id", "rank"], "left")
    hit = F.coalesce(F.col("score") >= F.col("_true") - 1e-12, F.lit(False)).cast("int")
    return both.agg(F.avg(hit)).first()[0] or 0.0

import numpy as np
import pytest
from pyspark.sql import functions as F

from fellwalk.llm import op5_vantage_search as op
from fellwalk.llm.vectors import unit

SCHEMA = "vec_id bigint, embedding array<float>, label int, shard int, rank string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 2, "x") for i, v in rows], SCHEMA)


def brute(rows, queries, k):
    points = {i: np.asarray(v, dtype=np.float32).astype(float) for i, v in rows}
    out = {}
    for q in queries:
        score = {i: float(p @ points[q] / np.sqrt((p @ p) * (points[q] @ points[q]))) for i, p in points.items() if i != q}
        out[q] = sorted(score.items(), key=lambda x: (-round(x[1], 12), x[0]))[:k]
    return out


def clustered(n, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 16))
    return [(i, centres[i % 12] + 0.3 * rng.normal(size=16)) for i in range(n)]


@pytest.mark.parametrize("shard_rows", [100, 10_000])
def test_factor_one_is_exact(spark, shard_rows):
    rows = clustered(900)
    rows += [(5000 + i, rows[7][1]) for i in range(12)] + [(6000, 2 * rows[7][1])]
    queries = [i for i, _ in rows if i % 50 == 0]
    vectors = frame(spark, rows)
    got = {}
    for r in op.search(vectors, vectors.filter("vec_id % 50 = 0"), 5, 1.0, shard_rows).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for q, best in brute(rows, queries, 5).items():
        assert [i for i, _ in got[q]] == [i for i, _ in best]
        assert np.allclose([s for _, s in got[q]], [s for _, s in best], atol=1e-12)


def test_smaller_factors_compare_less_and_keep_recall():
    rows = clustered(3000, 1)
    points, ids = unit(np.stack([v for _, v in rows])), np.asarray([i for i, _ in rows])
    tree, compared, scores = op.VantageTree(points, ids), {}, {}
    for factor in (1.0, 0.9, 0.5):
        tree.compared = 0
        scores[factor], _ = tree.search(points[:200], ids[:200], 5, factor)
        compared[factor] = tree.compared
    assert compared[0.5] < compared[0.9] < compared[1.0] < 0.8 * 200 * 3000
    assert (scores[0.9] >= scores[1.0] - 1e-12).mean() >= 0.9


def test_recall_on_the_given_vectors(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    queries = vectors.filter("vec_id % 50 = 0")
    assert op.recall(vectors, queries, op.search(vectors, queries, 5), 5) >= 0.9


def test_odd_rows(spark):
    rows = [(0, [1, 0]), (1, [1, 0]), (1, [1, 0]), (2, [0, 1]), (3, None), (4, []), (5, [0, 0]), (6, [None, 1]), (7, [float("nan"), 1]), (8, [float("inf"), 1]),
            (None, [1, 0]), (50, [1, 0, 0]), (100, [0, 3]), (150, [0, 0])]
    vectors = frame(spark, rows)
    got = [(r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in op.search(vectors, vectors.filter("vec_id % 50 = 0"), 5).collect()]
    assert sorted(got) == [(0, 1, 1, 1.0), (0, 2, 2, 0.0), (0, 3, 100, 0.0), (100, 1, 2, 1.0), (100, 2, 0, 0.0), (100, 3, 1, 0.0)]
    assert op.search(vectors.limit(0), vectors.limit(0), 5).collect() == []
    assert op.search(vectors, vectors.filter(F.lit(False)), 5).collect() == []

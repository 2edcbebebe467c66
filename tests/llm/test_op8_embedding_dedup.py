import numpy as np
import pytest

from fellwalk.llm import op8_embedding_dedup as op
from fellwalk.llm.vectors import unit

SCHEMA = "vec_id bigint, embedding array<float>, label int, node int, cell string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], label, 3, "x") for i, v, label in rows], SCHEMA)


def brute(rows):
    """Links and components by holding every vector against every other of its label."""
    out = {}
    for label in {r[2] for r in rows}:
        some = [r for r in rows if r[2] == label]
        points = unit(np.stack([r[1] for r in some]).astype(np.float32).astype(float))
        near = points @ points.T >= op.SIMILAR
        ids = np.asarray([r[0] for r in some])
        least = ids.copy()
        while True:
            new = np.where(near, least[None, :], np.iinfo(np.int64).max).min(axis=1)
            if (new == least).all():
                break
            least = new
        out |= {int(i): (int(n) - 1, int(c)) for i, n, c in zip(ids, near.sum(axis=1), least)}
    return out


def planted(n=2500, dim=32, seed=3):
    """Random vectors, near copies, a dense group, a chain, and equal vectors."""
    rng = np.random.default_rng(seed)
    rows = [rng.normal(size=dim) for _ in range(n)]
    rows += [rows[i] + 0.2 * rng.normal(size=dim) for i in range(0, n, 6)]
    rows += [rows[5] + 0.12 * rng.normal(size=dim) for _ in range(300)]
    rows += [rows[9]] * 40
    axis = np.eye(dim)
    rows += [np.cos(a) * axis[0] + np.sin(a) * axis[1] for a in np.arange(0, 3, 0.3)]
    return [(7 * i, v, i % 3) for i, v in enumerate(rows)]


@pytest.mark.parametrize("most", [4096, 300])
def test_links_agree_with_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(op, "SPLIT_FROM", most)
    monkeypatch.setattr(op, "SHARD_MOST", most)
    monkeypatch.setattr(op, "SHARD_AIM", most // 5)
    rows = planted()
    expected, frame_ = brute(rows), frame(spark, rows)
    result = op.groups(frame_)
    got = {r.vec_id: (r.n_links, r.component_id) for r in result.collect()}
    wrong = [i for i in expected if got[i] != expected[i]]
    assert len(got) == len(rows) and len(wrong) <= (0 if most == 4096 else 0.01 * len(rows))
    assert all(got[i][0] <= expected[i][0] for i in expected)
    assert op.audit(frame_, result, 0.2) >= 0.99


@pytest.mark.parametrize("n", [5000, 20000])
def test_a_label_of_near_copies_loses_no_link(spark, monkeypatch, n):
    monkeypatch.setattr(op, "COMPARED", 3000)
    rng = np.random.default_rng(n)
    centre = rng.normal(size=64)
    points = (centre + 0.27 * rng.normal(size=(n, 64))).astype(np.float32)
    frame_ = spark.createDataFrame([(i, v.tolist(), 1, 3, "x") for i, v in enumerate(points)], SCHEMA).repartition(8)
    found = op.groups(frame_).cache()
    units, expected = unit(points.astype(float)), 0
    for start in range(0, n, 1000):
        expected += int((units[start : start + 1000] @ units.T >= op.SIMILAR).sum())
    got = found.agg({"n_links": "sum"}).first()[0]
    assert 0.9 * (expected - n) <= got <= expected - n and expected > 20 * n
    assert op.audit(frame_, found, 0.05) >= 0.9


def test_odd_rows(spark):
    rows = [(0, [1, 0], 1), (1, [2, 0], 1), (2, [1, 0], 1), (2, [1, 0], 1), (3, [1, 0], 2), (4, [1, 0], None), (5, None, 1), (6, [], 1), (7, [0, 0], 1), (8, [None, 1], 1),
            (9, [float("nan"), 0], 1), (10, [float("-inf"), 0], 1), (11, [1, 0, 0], 1), (None, [1, 0], 2)]
    got = sorted((-1 if r.vec_id is None else r.vec_id, r.n_links, r.component_id, r.kept) for r in op.groups(frame(spark, rows)).collect())
    assert got == sorted([(0, 3, 0, True), (1, 3, 0, False), (2, 3, 0, False), (2, 3, 0, False), (3, 1, 3, True), (-1, 1, 3, False)] + [(i, 0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11)])
    assert op.groups(frame(spark, [])).collect() == []


def test_recall_on_the_given_vectors(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    assert op.audit(vectors, op.groups(vectors), 1.0) == 1.0

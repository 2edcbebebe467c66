import random
import re

import pytest

from fellwalk.llm import op4_mixing as op

SCHEMA = "doc_id bigint, text string, source string, size string, copies int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 9) for r in rows], SCHEMA)


def expected_targets(sizes, weights=(3.0, 1.0, 2.0)):
    """Shares by weight, capped, the excess given to the others again and again."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        rest, left = total - sum(fixed.values()), [s for s in names if s not in fixed]
        part = {s: rest * weight[s] / sum(weight[t] for t in left) for s in left}
        over = {s: 2.0 * sizes[s] for s in left if part[s] > 2 * sizes[s]}
        if not over:
            return fixed | part
        fixed |= over


@pytest.mark.parametrize("seed", range(4))
def test_targets_and_copies(spark, seed):
    rng = random.Random(seed)
    sources = [None, "b", "a", "é", "\U0001F600", "B", "empty", "src 1"][: 8 - seed]
    rows = [(None if i % 50 == 0 else i, "w\t\x0bé " * rng.randrange(1, 60), rng.choice(sources[: 1 + i % len(sources)])) for i in range(1500)]
    rows = [(i, None if s == "empty" or i == 7 else t, s) for i, t, s in rows] + rows[:5]
    docs = frame(spark, rows)
    got = op.shares(docs).collect()
    assert len(got) == len(rows)
    size_of = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size_of(t)
    targets = expected_targets(sizes)
    by_target = {}
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size)
        by_target.setdefault((r.source_size, r.target), []).append(r.taken)
    for s, target in targets.items():
        near = [(k, v) for k, v in by_target.items() if k[0] == sizes[s] and abs(k[1] - target) <= 1e-6 * max(1, target)]
        assert near and abs(sum(near[0][1]) - target) <= max(0.05 * target, 60)
    assert sorted(map(str, got)) == sorted(map(str, op.shares(docs.repartition(7)).collect()))
    mixed = op.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.taken // r.size for r in got if r.size) + sum(
        1 for r in mixed.collect() if size_of(r.text) == 0)


def test_empty_and_wordless_tables(spark):
    assert op.shares(frame(spark, [])).collect() == [] and op.mix(frame(spark, [])).collect() == []
    assert [(r.size, r.taken) for r in op.shares(frame(spark, [(1, None, None), (2, " \n", "a")])).collect()] == [(0, 0), (0, 0)]

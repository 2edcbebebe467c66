"""The prefix trie against a trie built turn by turn in memory."""

import collections
import hashlib
import zlib

import numpy as np
import pytest

from fellwalk.llm import op11_prefix_trie as op11

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    made = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 9, c - (abs(c) % 5) * (1 if c >= 0 else -1)
        made[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = collections.Counter(path[:-1] for path in members if path)
    leaves, saved = collections.Counter(), collections.Counter()
    for path, convs in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += children[path] == 0
            saved[path[:d]] += (len(convs) - 1) * len(path[-1][1].encode()) if path else 0
    return sorted(
        (min(convs), len(path), min(members[path[:-1]]) if path else -1, len(convs), children[path], leaves[path], saved[path],
         hashlib.sha256(",".join(map(str, sorted(c for c in convs if len(made[c]) == len(path)))).encode()).hexdigest())
        for path, convs in members.items())


def found(spark, rows, **more):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = op11.prefix_trie(frame, **more).collect()
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in out)


ODD = [
    (0, 0, "user", "a"), (0, 1, "assistant", "é" * 40), (0, 2, None, None), (1, 0, "user", "a"), (1, None, "user", "first"), (1, 1, "assistant", "b"),
    (2, 5, "user", "a"), (2, 5, "user", "a"), (2, 5, "assistant", "a"), (3, None, None, None), (4, 0, "user", "x" * 50_000), (7, 0, "user", "a"), (8, 0, "", ""),
    (9, 0, "user", "a"), (9, 1, "user", "b"), (-1, 0, "user", "a"), (-3, 0, "user", "a"), (-5, 0, "user", "z"), (-6, 0, "user", "q"), (None, 0, "user", "gone"),
    (2**62, 0, "user", "a"), (2**62 + 1, 0, "user", "a"), (2**62 + 1, 1, "user", "b"),
]


def made(seed, count, longest=7):
    """Conversations that share starts, at random and by a hot first turn, some of them copies."""
    draw = np.random.default_rng(seed)
    rows = []
    for c in range(count):
        copy = draw.random() < 0.3
        for turn in range(4 if copy else int(draw.integers(1, longest))):
            text = "hot" if turn == 0 and draw.random() < 0.6 else f"t{draw.integers(0, 3)}"
            rows.append((c * 3 - count, turn, "user" if turn % 2 == 0 else "assistant", f"copy{turn}" if copy else text))
    return rows


@pytest.mark.parametrize("limit", [None, 1, 2])
def test_odd_rows_ties_and_repeated_rows(spark, limit):
    assert found(spark, ODD, limit=limit) == brute(ODD)


@pytest.mark.parametrize("limit, most", [(None, 1 << 20), (3, 1 << 20), (40, 5)])
def test_shared_starts_at_every_limit_and_with_spilled_queues(spark, limit, most):
    rows = made(1, 300)
    assert found(spark, rows, limit=limit, most=most) == brute(rows)


def test_a_long_conversation_over_partitions_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(op11, "BLOCK", 16)
    rows = [(c, t, "user", f"w{t % 5}") for c in (5, 6, 10) for t in range(120)] + made(2, 20)
    assert found(spark, rows, limit=2) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA + ", depth int, pos int")
    assert op11.prefix_trie(empty).collect() == []
    assert op11.prefix_trie(spark.createDataFrame([(None, 1, "user", "a", 1, 1)], empty.schema)).collect() == []
    one = op11.prefix_trie(spark.createDataFrame([(5, 0, "user", "ab", 7, 8)], empty.schema))
    assert sorted((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens) for r in one.collect()) == [
        (5, 0, None, 1, 1, 1, 0), (5, 1, 5, 1, 0, 1, 0)]


def test_queue_spills_and_leaves_no_file(tmp_path):
    folder = f"file://{tmp_path}/queues"
    queue = op11.Messages(folder, 10)
    draw = np.random.default_rng(3)
    sent = [(draw.integers(0, 50, 8), draw.integers(0, 9, (8, 2))) for _ in range(20)]
    for parent, values in sent:
        queue.push(parent, values)
    assert len(list((tmp_path / "queues").iterdir())) > 3
    queue.next_level()
    nodes, totals = np.arange(50), np.zeros((50, 2), dtype=np.int64)
    for at in range(0, 50, 7):
        queue.take(nodes[at : at + 7], totals[at : at + 7])
    queue.take(np.asarray([99]), np.zeros((1, 2), dtype=np.int64))
    expected = np.zeros((50, 2), dtype=np.int64)
    for parent, values in sent:
        np.add.at(expected, parent, values)
    assert (totals == expected).all()
    assert list((tmp_path / "queues").iterdir()) == []

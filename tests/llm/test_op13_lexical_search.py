"""Ranked lexical search against a plain evaluation of every document."""

import collections
import math
import re

import numpy as np
import pyarrow as pa
import pytest

from fellwalk.llm import op13_lexical_search as op13

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
CAPITALS = {i: i + 32 for i in range(65, 91)}


def brute(docs, items, limit):
    words = [TERM.findall((text or "").translate(CAPITALS)) for _, text in docs]
    total, length = sum(1 for w in words if w), sum(map(len, words))
    holding = collections.Counter(t for w in words for t in set(w))
    asked = collections.defaultdict(list)
    for item, text in items:
        asked[item] += TERM.findall((text or "").translate(CAPITALS))
    out = []
    for item, terms in asked.items():
        found = []
        for (doc, _), has in zip(docs, words):
            tf = collections.Counter(has)
            m = 100 - 25 + (25 * len(has) * total) // max(1, length)
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * holding[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 12 * m)) for t in terms if tf[t])
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, rank, None if null else doc, -score) for rank, (score, null, doc) in enumerate(sorted(found)[:limit], 1)]
    return sorted(out, key=repr)


def searched(spark, docs, items, **more):
    left = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    right = spark.createDataFrame(items, "item_id bigint, text string")
    return sorted((tuple(r) for r in op13.search(left, right, **more).collect()), key=repr)


ODD = [
    (1, None), (2, ""), (3, " .,;\n"), (4, "Straße STRASSE straße"), (5, "ÀÉ àé Àé"), (6, "a1 b2 c3 a1"), (None, "a1 a1 b2"), (7, "x" * 70_000 + " a1"),
    (8, "a1 b2 c3"), (8, "a1 b2 c3"), (9, "A1-B2_C3"), (10, "日本 a1 日本"), (11, "tail\x7fa1\x00b2"), (12, "word " * 3000 + "b2"),
]
ASKED = [(1, "a1 b2 A1"), (2, None), (3, "..."), (4, "straße àé 日本"), (None, "word c3"), (5, "nothing here"), (6, "a1"), (6, "b2"), (7, "x" * 70_000)]


def test_odd_rows_ties_and_repeated_rows(spark):
    assert searched(spark, ODD, ASKED) == brute(ODD, ASKED, 20)


def test_items_in_many_blocks(spark):
    assert searched(spark, ODD, ASKED, block_bytes=20_000) == brute(ODD, ASKED, 20)


def made(seed, count, vocabulary, longest):
    draw = np.random.default_rng(seed)
    return [(i, " ".join(f"t{int(w)}" for w in np.minimum(draw.zipf(1.3, draw.integers(0, longest)), vocabulary))) for i in range(count)]


@pytest.mark.parametrize("limit", [1, 5, 20])
def test_many_documents_in_small_chunks(spark, monkeypatch, limit):
    monkeypatch.setattr(op13, "CHUNK_DOCS", 50)
    docs = made(1, 900, 300, 80)
    items = made(2, 12, 300, 20) + [(50, " ".join(f"t{i}" for i in range(1, 200)))]  # more terms than one word of a mask
    assert searched(spark, docs, items, limit=limit) == brute(docs, items, limit)


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, rank int, score double, item_id string")
    items = spark.createDataFrame([(1, "a", 5)], "item_id bigint, text string, doc_id int")
    assert op13.search(docs, items).collect() == []
    full = spark.createDataFrame([(3, "a b", 1, 0.5, "x")], docs.schema)
    assert [tuple(r)[:3] for r in op13.search(full, items).collect()] == [(1, 1, 3)]
    assert op13.search(full, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    assert op13.search(full, items.limit(0)).collect() == []


def test_groups_are_masks_and_evaluation_stops():
    """Groups are the documents with equal masks; with a full list, groups that cannot enter are not evaluated."""
    n = 4000
    codes = [[0] if i % 100 else [0, 1] for i in range(n)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(n)), pa.array([10] * n), pa.array(codes, pa.list_(pa.int32())), pa.array([[1] * len(c) for c in codes], pa.list_(pa.int64()))],
        names=["doc_id", "n", "codes", "tfs"])
    chunk = op13.Chunk([batch], np.asarray([5, 900]), n, 10 * n)
    terms, times = np.asarray([0, 1]), np.asarray([1, 1])
    docs, starts, most = chunk.masks(terms, times)
    sizes = np.diff(np.append(starts, len(docs)))
    assert sorted(sizes.tolist()) == [n // 100, n - n // 100]
    best = op13.Best(20)
    assert op13.best_of_chunk(chunk, terms, times, np.zeros(2, dtype=np.int64), best) == n // 100
    assert best.rows[0].tolist() == list(range(0, 2000, 100))

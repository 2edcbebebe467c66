"""Packing and token files against the library, one text at a time."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fellwalk.llm import op9_packing, op10_token_files
from fellwalk.llm.queries import vocabulary
from fellwalk.workspace import fresh_path

SCHEMA = "doc_id bigint, text string, part int, length string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    texts = [None, "", "a", "b " * 9000, "word " * 4095, "word " * 4096, "x" * 20_000] + [" ".join(str(rng.randrange(10**6)) for _ in range(rng.randrange(400))) for _ in range(150)]
    rng.shuffle(texts)
    return [(7 * i - 100, t) for i, t in enumerate(texts)] + [(5, "twice")] * 3 + [(None, "no id"), (None, None)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA).repartition(5)


def ids_of(rows):
    tokenizer = Tokenizer.from_file(vocabulary())
    return [np.asarray([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4") for _, t in rows]


def test_files_hold_the_stream(spark, rows):
    got = op10_token_files.token_files(frame(spark, rows), vocabulary(), 64).collect()
    expected = sorted((-(10**9) if d is None else d, len(x), zlib.crc32(x)) for (d, _), x in zip(rows, ids_of(rows)))
    assert sorted((-(10**9) if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == expected
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0] + [r.n_tokens for r in ordered])[:-1].tolist()
    assert [-(10**9) if r.doc_id is None else r.doc_id for r in ordered] == [d for d, _, _ in expected]


def test_sequences_can_be_mapped_and_masks_cover_the_padding(spark, rows):
    folder = f"file://{fresh_path(spark, 'files').removeprefix('file:')}"
    index = op10_token_files.write_tokens(frame(spark, rows), vocabulary(), folder, 64)
    sums = {r.part: r["sum(n_tokens)"] for r in index.groupBy("part").sum("n_tokens").collect()}
    ids = {(r.doc_id, r.n_tokens): r.ids for r in op10_token_files.read_tokens(index, folder, tokens=True).collect()}
    for (d, _), x in zip(rows, ids_of(rows)):
        assert ids[d, len(x)] == x.tolist()
    for part, total in sums.items():
        reader = pa.ipc.open_file(pa.memory_map(f"{folder.removeprefix('file://')}/part-{part:06d}.arrow"))
        before = pa.total_allocated_bytes()
        masks = [reader.get_batch(k).column("mask").flatten() for k in range(reader.num_record_batches)]
        assert pa.total_allocated_bytes() == before  # mapped, not copied
        assert sum(m.true_count for m in masks) == total and sum(len(m) for m in masks) == -(-total // 64) * 64


def test_packing_is_best_fit_decreasing(spark, rows):
    got = op9_packing.pack(frame(spark, rows), vocabulary()).collect()
    expected = [((d, k, s, len(x[s : s + 4096]), zlib.crc32(x[s : s + 4096]))) for (d, _), x in zip(rows, ids_of(rows)) for k, s in enumerate(range(0, len(x), 4096))]
    key = lambda r: tuple(-(10**9) if v is None else v for v in r)
    assert sorted(map(key, expected)) == sorted(key((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in got)
    filled = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    bins = []
    for length in sorted((len_ for *_, len_, _ in expected), reverse=True):
        fit = min((b for b in bins if b[0] >= length), default=None, key=lambda b: b[0])
        if fit is None:
            bins.append(fit := [4096])
        fit[0] -= length
    assert len(filled) == len(bins) and max(filled.values()) <= 4096


def test_segment_tree_finds_the_tightest():
    rng = random.Random(1)
    for capacity in (1, 7, 64, 100):
        lengths = sorted((rng.randint(1, capacity) for _ in range(300)), reverse=True)
        sequences, offsets, count = op9_packing.best_fit_decreasing(lengths, capacity)
        left = []
        for length, sequence, offset in zip(lengths, sequences, offsets):
            fit = [b for b in left if b >= length]
            if sequence == len(left):
                assert not fit
                left.append(capacity)
            else:
                assert left[sequence] == min(fit)
            assert offset == capacity - left[sequence]
            left[sequence] -= length
        assert len(left) == count


def test_empty_tables(spark):
    assert op10_token_files.token_files(frame(spark, []), vocabulary()).collect() == []
    assert op9_packing.pack(frame(spark, []), vocabulary()).collect() == []


def test_parts_follow_the_bytes_of_the_texts(spark, monkeypatch):
    """More text makes more parts, also where one doc_id holds half of it."""
    docs = spark.createDataFrame([(i if i % 2 else 4, f"text number {i} " * 20, 1, "x") for i in range(400)], SCHEMA)
    size = sum(len(r.text) for r in docs.collect())
    monkeypatch.setattr(op10_token_files, "PART_BYTES", size // 40)
    folder = fresh_path(spark, "many-parts")
    index = op10_token_files.write_tokens(docs, vocabulary(), f"file://{folder.removeprefix('file:')}")
    per_part = [r["n"] for r in index.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()]
    assert len(per_part) >= 30 and max(per_part) < 5 * sum(per_part) / len(per_part)
    assert index.filter("doc_id = 4").select("part").distinct().count() > 10

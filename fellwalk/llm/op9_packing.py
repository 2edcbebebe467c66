"""Best-fit packing: documents into as few sequences of a fixed length as best-fit decreasing finds.

A document is its token ids and the end id. Documents longer than a sequence are cut into whole sequences and a rest; all
other documents stay whole. Whole sequences need no search. The other pieces are dealt evenly over shards of
``SHARD_PIECES``, each packed alone by best-fit decreasing: pieces from long to short, each into the tightest open sequence
that takes it. A segment tree over the remaining capacities finds that sequence in logarithmic time per piece. Shards cost
at most about one sequence each, and their number grows with the input while their size does not.

Nulls, ties and odd input: a null text is the empty text, one end id; null or repeated ``doc_id`` are packed row by row;
equal lengths are taken in order of ``doc_id``, then piece; an empty table gives no rows; columns of other names are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fellwalk.llm.common import lean, settle_llm
from fellwalk.llm.tokens import END_ID, encoder_of, pieces_of
from fellwalk.workspace import settled

SEQUENCE = 4096
SHARD_PIECES = 8192
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PACKED = PIECES + ", sequence_id bigint, offset bigint"


class OpenSequences:
    """Open sequences by remaining capacity: a segment tree of counts, and the sequences of every capacity."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, remaining: int, sequence: int) -> None:
        self.at[remaining].append(sequence)
        node = self.leaves + remaining
        while node:
            self.counts[node] += 1
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """Remaining capacity and number of the tightest open sequence that takes ``length``; it is no longer open."""
        counts, node = self.counts, self.leaves + length
        if not counts[node]:
            while not (node & 1 == 0 and counts[node + 1]):  # up, until something larger lies to the right
                node >>= 1
                if node <= 1:
                    return None
            node += 1
            while node < self.leaves:  # down, to the smallest
                node = 2 * node if counts[2 * node] else 2 * node + 1
        remaining = node - self.leaves
        while node:
            counts[node] -= 1
            node >>= 1
        return remaining, self.at[remaining].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int], int]:
    """Sequence and offset of each length, given from long to short, and the number of sequences."""
    opened, sequences, offsets, count = OpenSequences(capacity), [], [], 0
    for length in lengths:
        found = opened.take(length)
        if found is None:
            remaining, sequence = capacity, count
            count += 1
        else:
            remaining, sequence = found
        sequences.append(sequence)
        offsets.append(capacity - remaining)
        if remaining > length:
            opened.add(remaining - length, sequence)
    return sequences, offsets, count


def cut_documents(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32``."""
    get = encoder_of(tokenizer)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = get()
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
            out = []
            for run in pieces_of(texts):
                for i, ids_ in zip(run, encoder.encode([texts[i] for i in run])):
                    tokens = np.append(ids_, end_id).astype("<u4")
                    for k, start in enumerate(range(0, len(tokens), sequence)):
                        some = tokens[start : start + sequence]
                        out.append((ids[i], k, start, len(some), zlib.crc32(some)))
            columns = list(zip(*out)) if out else [()] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    settle_llm(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(lean(pieces), PIECES)


def pack(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``, one row per piece."""
    cut = settled(cut_documents(docs, tokenizer, sequence), "pieces")
    whole = cut.filter(F.col("length") == sequence)
    rest = cut.filter(F.col("length") < sequence)
    shards = max(1, -(-rest.count() // SHARD_PIECES))

    def pack_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = list(batches)
        if not sum(b.num_rows for b in held):
            return
        shard = pa.Table.from_batches(held).sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        sequences, offsets, _ = best_fit_decreasing(shard.column("length").to_pylist(), sequence)
        base = TaskContext.get().partitionId() << 32
        out = shard.append_column("sequence_id", pa.array(np.asarray(sequences, dtype=np.int64) + base))
        yield from out.append_column("offset", pa.array(offsets, pa.int64())).combine_chunks().to_batches()

    # dealt row by row, not by a key, so every shard has its share whatever the ids are; the deal is repeatable
    packed = rest.repartition(shards).mapInArrow(lean(pack_shard), PACKED)
    alone = whole.select("*", (F.lit(1 << 62) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return packed.unionByName(alone)

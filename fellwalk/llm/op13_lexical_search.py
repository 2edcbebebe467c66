"""Ranked lexical search: the best documents of every item by an integer tf-idf score, found by presence-mask grouping.

Terms are the maximal runs of ASCII letters, digits and all signs beyond ASCII; only A-Z are lower-cased. A document's score
for an item is the sum, over the item's terms with repeats, of ``w * ((10**9 * tf) div (1000 * tf + 12 * m))``: ``w`` falls with
the documents that hold the term, ``m`` grows with the document's length (:func:`weight`, :func:`length_norm`).

1. *Postings.* Every text is read whole, once for each block of items: its number of terms, and how often it holds each term
   of the block's items. A block's terms travel with the task; a block holds about ``BLOCK_BYTES`` of them, whatever the number
   of items, which are dealt over blocks by hash. Document frequencies are counted from the postings.
2. *Masks.* A task takes documents in chunks and holds, per term, a bitmap of the chunk's documents. The bitmaps of an item's
   terms, turned, are the documents' presence masks, and equal masks make a group. A mask's maximum score is the sum of the
   largest parts that its terms reach in the chunk. Groups are evaluated exactly by descending maximum until it falls below the
   worst score kept for the item. What is kept goes from chunk to chunk, so later chunks evaluate few groups.
3. *Best of all tasks.* Each task gives its best rows per item; they are ranked together.

The work is linear in the texts; a task gives at most ``limit`` rows per item, however many documents match.

Nulls and odd input: a null or termless text matches nothing and does not count as a document; an item without terms has no
rows; rows that share an ``item_id`` (null too) are one item with the terms of all; rows that share a ``doc_id`` are documents
of their own; a null ``doc_id`` follows all others among equal scores; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from fellwalk.llm.common import lean, settle_llm
from fellwalk.workspace import settled

LIMIT = 20
BLOCK_BYTES = 4 << 20
CHUNK_DOCS, CHUNK_POSTINGS = 8192, 2 << 20
TERM_SIGNS = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))

POSTINGS = "doc_id bigint, n bigint, codes array<int>, tfs array<bigint>"
FOUND = "item_id bigint, doc_id bigint, score bigint"


# ---- terms ----


def _signs() -> bytes:
    """For each byte, its lower case if it belongs to a term, else a space. UTF-8 has no ASCII byte inside other signs."""
    return bytes((c + 32 if 0x41 <= c <= 0x5A else c) if c in TERM_SIGNS else 0x20 for c in range(256))


def split_terms(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The pieces between separators of all texts (empty ones among them), and how many each text has."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    plain = pa.py_buffer(data.to_pybytes().translate(_signs()) if data is not None else b"")
    mapped = pa.Array.from_buffers(pa.large_string(), len(texts), [None, offsets, plain], offset=texts.offset)
    pieces = pc.split_pattern(mapped, " ")
    return pieces.flatten().dictionary_encode(), pc.list_value_length(pieces).to_numpy()


def term_counts(texts: pa.Array, vocabulary: pa.Array | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Terms per text, then text, code and count of every term of the vocabulary (of all terms, if None) in it."""
    pieces, sizes = split_terms(texts)
    words = pieces.dictionary
    vocabulary = words if vocabulary is None else vocabulary
    code = pc.fill_null(pc.index_in(words, value_set=vocabulary), -1).to_numpy().astype(np.int64)
    empty = pc.equal(words, "").to_numpy(zero_copy_only=False)
    code[empty] = -2
    at = code[pieces.indices.to_numpy()] if len(words) else np.zeros(0, dtype=np.int64)
    text = np.repeat(np.arange(len(sizes)), sizes)
    n = np.bincount(text[at != -2], minlength=len(sizes))
    keys, counts = np.unique(text[at >= 0] * len(vocabulary) + at[at >= 0], return_counts=True)
    return n, keys // max(1, len(vocabulary)), keys % max(1, len(vocabulary)), counts, vocabulary


def _lists(values: np.ndarray, rows: np.ndarray, count: int, kind: pa.DataType) -> pa.ListArray:
    bounds = np.searchsorted(rows, np.arange(count + 1))
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, term, times`` of items ``item_id, text``; items that share an id are one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, text, code, times, words = term_counts(batch.column("text"), None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id").take(pa.array(text)), words.take(pa.array(code)).cast(pa.string()), pa.array(times)], names=["item_id", "term", "times"])

    shown = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    counted = shown.mapInArrow(lean(run), "item_id bigint, term string, times bigint")
    return counted.groupBy("item_id", "term").agg(F.sum("times").alias("times"))


def postings(docs: DataFrame, terms: list[str]) -> DataFrame:
    """``doc_id, n, codes, tfs`` of every document with a term: its terms, and which of ``terms`` it holds how often."""
    carried = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(carried.value, pa.large_string())
        for batch in batches:
            n, text, code, times, _ = term_counts(batch.column("text"), vocabulary)
            out = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), _lists(code, text, len(n), pa.int32()), _lists(times, text, len(n), pa.int64())],
                names=["doc_id", "n", "codes", "tfs"])
            yield out.filter(pa.array(n > 0))

    shown = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return shown.mapInArrow(lean(run), POSTINGS)


# ---- scores ----


def weight(total: int, holding: int) -> int:
    """The weight of a term that ``holding`` of ``total`` documents hold."""
    return math.floor(1000 * math.log((2 * total + 2) / (2 * holding + 1)))


def length_norm(n: np.ndarray, total: int, length: int) -> np.ndarray:
    """100 for a document of mean length, 75 for a very short one."""
    return 100 - 25 + (25 * n * total) // length


class Chunk:
    """Some documents with the exact part of the score that each of their terms gives (once, before repeats)."""

    def __init__(self, batches: list[pa.RecordBatch], weights: np.ndarray, total: int, length: int):
        table = pa.Table.from_batches(batches).combine_chunks()
        one = lambda name: table.column(name).chunk(0)
        self.ids, self.null = pc.fill_null(one("doc_id"), 0).to_numpy(), pc.is_null(one("doc_id")).to_numpy(zero_copy_only=False)
        codes, n = one("codes"), one("n").to_numpy()
        sizes = pc.list_value_length(codes).to_numpy().astype(np.int64)
        self.starts, self.sizes = np.cumsum(sizes) - sizes, sizes
        self.code, tf = codes.flatten().to_numpy().astype(np.int64), one("tfs").flatten().to_numpy()
        m = np.repeat(length_norm(n, total, length), sizes)
        self.part = weights[self.code] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
        doc = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(self.code, kind="stable")
        self.terms, first = np.unique(self.code[order], return_index=True)
        self.most = np.maximum.reduceat(self.part[order], first) if len(first) else first
        present = np.zeros((len(self.terms), -(-len(sizes) // 8) * 8), dtype=bool)
        present[np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order)))), doc[order]] = True
        self.bitmaps = np.packbits(present, axis=1)

    def masks(self, terms: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct presence masks over an item's terms: documents by mask, where each mask starts, its maximum score."""
        at = np.minimum(np.searchsorted(self.terms, terms), max(0, len(self.terms) - 1))
        there = self.terms[at] == terms if len(self.terms) else np.zeros(len(terms), dtype=bool)
        rows, most = at[there], (self.most[at] * times)[there] if len(self.terms) else times[:0]
        count = len(self.sizes)
        words, bounds = [], np.zeros(count)
        for first in range(0, len(rows), 64):
            bits = np.unpackbits(self.bitmaps[rows[first : first + 64]], axis=1, count=count)
            bounds += most[first : first + 64].astype(np.float64) @ bits
            packed = np.zeros((count, 8), dtype=np.uint8)
            packed[:, : -(-len(bits) // 8)] = np.packbits(bits, axis=0).T
            words.append(packed.view(np.uint64)[:, 0])
        if not words:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), bounds[:0]
        order = np.lexsort(words) if len(words) > 1 else np.argsort(words[0], kind="stable")
        new = np.zeros(count, dtype=bool)
        for word in words:
            new[1:] |= word[order][1:] != word[order][:-1]
        new[:1] = True
        starts = np.flatnonzero(new)
        # the sums of doubles are exact below 2 ** 53; beyond it the margin keeps them above every score of the mask
        return order, starts, bounds[order[starts]] * (1 + 1e-9)

    def scores(self, docs: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Exact scores of documents, with ``times`` the repeats of every term in the item."""
        size = self.sizes[docs]
        ends = np.cumsum(size)
        at = np.repeat(self.starts[docs] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        parts = np.append(self.part[at] * times[self.code[at]], 0)
        return np.where(size > 0, np.add.reduceat(parts, np.minimum(ends - size, len(parts) - 1)), 0)


class Best:
    """The best documents of one item so far."""

    def __init__(self, limit: int):
        self.limit, self.rows = limit, (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool), np.zeros(0, dtype=np.int64))

    def floor(self) -> int:
        """No score below this is wanted."""
        return int(self.rows[2][-1]) if len(self.rows[2]) == self.limit else 1

    def add(self, ids: np.ndarray, null: np.ndarray, score: np.ndarray) -> None:
        good = score >= self.floor()
        ids, null, score = (np.concatenate([a, b[good]]) for a, b in zip(self.rows, (ids, null, score)))
        order = np.lexsort((ids, null, -score))[: self.limit]
        self.rows = ids[order], null[order], score[order]


def best_of_chunk(chunk: Chunk, terms: np.ndarray, times: np.ndarray, repeats: np.ndarray, best: Best) -> int:
    """Evaluate the groups of one item by descending maximum until none can enter; returns the documents evaluated."""
    docs, starts, most = chunk.masks(terms, times)
    ends = np.append(starts[1:], len(docs))
    groups = np.flatnonzero(most >= best.floor())
    groups = groups[np.argsort(-most[groups], kind="stable")]
    below = np.cumsum(ends[groups] - starts[groups])
    repeats[terms] = times
    evaluated, at, step = 0, 0, best.limit
    while at < len(groups) and most[groups[at]] >= best.floor():
        end = max(at + 1, int(np.searchsorted(below, (below[at - 1] if at else 0) + step, side="right")))  # groups of about so many documents at once
        some = groups[at:end]
        at, step = end, step * 2
        some = some[most[some] >= best.floor()]
        size = ends[some] - starts[some]
        offsets = np.cumsum(size) - size
        chosen = docs[np.repeat(starts[some] - offsets, size) + np.arange(size.sum())]
        best.add(chunk.ids[chosen], chunk.null[chosen], chunk.scores(chosen, repeats))
        evaluated += len(chosen)
    repeats[terms] = 0
    return evaluated


def _search_block(docs: DataFrame, rows: list, limit: int) -> DataFrame:
    """``item_id, doc_id, score``: the best rows of each task for the items whose terms are ``rows``."""
    spark = docs.sparkSession
    terms = sorted({r.term for r in rows})
    code = {t: i for i, t in enumerate(terms)}
    found = settled(postings(docs, terms), "postings")
    sums = found.agg(F.count(F.lit(1)).alias("total"), F.sum("n").alias("length")).first()
    holding = np.zeros(len(terms), dtype=np.int64)
    for r in found.select(F.explode("codes").alias("code")).groupBy("code").count().collect():  # as many as the block has terms
        holding[r["code"]] = r["count"]
    total, length = sums["total"], sums["length"] or 1
    weights = np.asarray([weight(total, int(h)) for h in holding], dtype=np.int64)
    per_item: dict[int | None, list[tuple[int, int]]] = {}
    for r in rows:
        per_item.setdefault(r.item_id, []).append((code[r.term], r.times))
    items = [(k, *map(np.asarray, zip(*sorted(v)))) for k, v in per_item.items()]
    carried = spark.sparkContext.broadcast((items, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items_, weights_ = carried.value
        best = [Best(limit) for _ in items_]
        repeats = np.zeros(len(weights_), dtype=np.int64)

        def take(held: list[pa.RecordBatch]) -> None:
            chunk = Chunk(held, weights_, total, length)
            for (_, terms_, times), kept in zip(items_, best):
                best_of_chunk(chunk, terms_, times, repeats, kept)

        held, docs_, held_postings = [], 0, 0
        for batch in batches:
            for first in range(0, batch.num_rows, CHUNK_DOCS):
                some = batch.slice(first, CHUNK_DOCS)
                held.append(some)
                docs_, held_postings = docs_ + some.num_rows, held_postings + len(some.column("codes").flatten())
                if docs_ >= CHUNK_DOCS or held_postings >= CHUNK_POSTINGS:
                    take(held)
                    held, docs_, held_postings = [], 0, 0
        if docs_:
            take(held)
        for (item, _, _), kept in zip(items_, best):
            ids, null, score = kept.rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([item] * len(ids), pa.int64()), pa.array(ids, pa.int64(), mask=null), pa.array(score, pa.int64())], names=["item_id", "doc_id", "score"])

    return found.mapInArrow(lean(run), FOUND)


def search(docs: DataFrame, items: DataFrame, limit: int = LIMIT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The operator: ``item_id, rank, doc_id, score`` of the ``limit`` best of ``docs`` for every one of ``items``."""
    spark = settle_llm(docs.sparkSession)
    terms = settled(item_terms(items), "item-terms")
    size = terms.agg(F.sum(F.octet_length("term") + 24)).first()[0] or 0
    dealt = terms.withColumn("_block", F.pmod(F.xxhash64("item_id"), F.lit(max(1, -(-size // block_bytes)))))
    blocks = sorted(r[0] for r in dealt.select("_block").distinct().collect())
    found = [_search_block(docs, dealt.filter(F.col("_block") == b).drop("_block").orderBy("item_id", "term").collect(), limit) for b in blocks]
    if not found:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = functools.reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= limit).select("item_id", "rank", "doc_id", "score")

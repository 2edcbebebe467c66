"""Token-ID output: documents as one stream of ids, in Arrow files of fixed-size lists that can be mapped without copying.

The stream is the documents in ascending ``doc_id`` order, each ending in the end id, cut into sequences of equal length. A
part file is an Arrow IPC file of record batches with two fixed-size-list columns, ``ids`` and ``mask`` (false over the
padding of a part's last sequence), so sequence ``i`` of a part lies at a computable place and is read without copying. The
ids are two bytes wide when the vocabulary allows it. A table beside the files says where each document lies.

Nulls, ties and odd input: a null text is the empty text (its end id alone); a null ``doc_id`` comes first; rows that share a
``doc_id`` follow one another by a hash of their texts; an empty table gives no files and no rows; columns of other names are
ignored. Texts are encoded whole, a few at a time.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from fellwalk.llm.common import lean, settle_llm, width
from fellwalk.llm.tokens import END_ID, encoder_of, pieces_of
from fellwalk.workspace import fresh_path, settled

SEQUENCE = 2048
SEQUENCES_PER_BATCH = 64
PART_BYTES = 256 << 20  # of text
INDEX = "part int, doc_id bigint, at bigint, n_tokens bigint"


def _parts(docs: DataFrame) -> int:
    """Part files for a corpus: one for each ``PART_BYTES`` of text, and at least one for each core."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(width(docs.sparkSession), -(-size // PART_BYTES))


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` (``doc_id``, ``text``) to part files under ``folder``, a URI all executors can write to.

    Returns ``part, doc_id, at, n_tokens``: the part file of each document, its first id there, and its ids with the end
    id. The frame is settled, so the files are written when this returns. Parts are ranges of ``doc_id``; rows that share
    one are dealt over parts by their text where they fill several. A part is written under a name of its attempt and
    then renamed, so a task that runs again leaves the same files.
    """
    settle_llm(docs.sparkSession)
    get = encoder_of(tokenizer)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        encoder, number = get(), TaskContext.get().partitionId()
        store, root = fs.FileSystem.from_uri(folder)
        kind, end = pa.from_numpy_dtype(encoder.kind), np.asarray([end_id], dtype=encoder.kind)
        schema = pa.schema([("ids", pa.list_(kind, sequence)), ("mask", pa.list_(pa.bool_(), sequence))])
        writer = sink = part = None
        waiting, count, at = [], 0, 0

        def flush(last: bool) -> None:
            nonlocal waiting, count
            ids = np.concatenate([*waiting, end[:0]])
            batch_ids = sequence * SEQUENCES_PER_BATCH
            whole = len(ids) if last else len(ids) // batch_ids * batch_ids  # all batches but the last are equally long
            rows = -(-whole // sequence)
            for first in range(0, rows, SEQUENCES_PER_BATCH):
                some = ids[first * sequence : min(whole, (first + SEQUENCES_PER_BATCH) * sequence)]
                full = np.zeros(-(-len(some) // sequence) * sequence, dtype=encoder.kind)
                full[: len(some)] = some
                mask = np.arange(len(full)) < len(some)
                writer.write_batch(pa.record_batch([
                    pa.FixedSizeListArray.from_arrays(pa.array(full), sequence),
                    pa.FixedSizeListArray.from_arrays(pa.array(mask), sequence),
                ], schema=schema))
            waiting, count = [ids[whole:]], len(ids) - whole

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("doc_id", "text")]
            index = []
            if columns[0] and part is None:
                part = number
                store.create_dir(root, recursive=True)
                attempt = f"{root}/_{part}-{uuid.uuid4().hex}"
                sink = store.open_output_stream(attempt)
                writer = pa.ipc.new_file(sink, schema)
            texts = [t or "" for t in columns[1]]
            for run in pieces_of(texts):
                for i, ids in zip(run, encoder.encode([texts[i] for i in run])):
                    n = len(ids) + 1
                    waiting += [ids, end]
                    index.append((part, columns[0][i], at, n))
                    at += n
                    count += n
                if count >= sequence * SEQUENCES_PER_BATCH:
                    flush(False)
            if index:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*index), (pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=["part", "doc_id", "at", "n_tokens"])
        if writer is not None:
            flush(True)
            writer.close()
            sink.close()
            store.move(attempt, f"{root}/part-{part:06d}.arrow")

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(_parts(rows), *order).sortWithinPartitions(*order)
    return settled(dealt.mapInArrow(lean(write), INDEX), "token-index")


def stream_starts(rows: DataFrame, index: DataFrame) -> DataFrame:
    """``rows`` with ``start``, the ids of all documents before each one: those of the parts before (one row per part) and ``at``."""
    sums = index.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sums.select("part", before.alias("_before"))
    return rows.join(F.broadcast(offsets), "part").withColumn("start", F.col("_before") + F.col("at")).drop("_before")


def read_tokens(index: DataFrame, folder: str, tokens: bool = False) -> DataFrame:
    """Read documents back from the part files: ``part, doc_id, at, n_tokens, ids_crc32``, and ``ids`` if ``tokens``.

    ``index`` is what :func:`write_tokens` returned. Each task opens the file of its part and takes its documents in order
    of place, a few record batches at a time; a file that can be mapped is not copied.
    """
    parts = "part int, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * tokens
    names = [p.split()[0] for p in parts.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        part, reader, held = None, None, {}

        def ids_between(start: int, end: int) -> np.ndarray:
            width_ = reader.schema.field("ids").type.list_size * SEQUENCES_PER_BATCH
            wanted = range(start // width_, (end - 1) // width_ + 1)
            for old in [k for k in held if k < wanted.start]:
                del held[old]
            for k in wanted:
                if k not in held:
                    held[k] = reader.get_batch(k).column(0).flatten().to_numpy()
            joined = held[wanted.start] if len(wanted) == 1 else np.concatenate([held[k] for k in wanted])
            return joined[start - wanted.start * width_ : end - wanted.start * width_]

        for batch in batches:
            rows, out = batch.to_pydict(), {n: [] for n in names}
            for p, doc, at, n in zip(rows["part"], rows["doc_id"], rows["at"], rows["n_tokens"]):
                if p != part:
                    path = f"{root}/part-{p:06d}.arrow"
                    local = isinstance(store, fs.LocalFileSystem)
                    reader = pa.ipc.open_file(pa.memory_map(path) if local else store.open_input_file(path))
                    part, held = p, {}
                ids = ids_between(at, at + n)
                values = (p, doc, at, n, zlib.crc32(ids.astype("<u4")), ids)
                for name, value in zip(names, values):
                    out[name].append(value)
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in zip(names, types)], names=names)

    spark = settle_llm(index.sparkSession)
    dealt = index.select("part", "doc_id", "at", "n_tokens").repartitionById(width(spark), F.pmod(F.col("part"), F.lit(width(spark))))
    return dealt.sortWithinPartitions("part", "at").mapInArrow(lean(read), parts)


def token_files(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE) -> DataFrame:
    """Write, read back and place in the stream: ``doc_id, start, n_tokens, ids_crc32, part, at``."""
    folder = fresh_path(docs.sparkSession, "token-files")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    index = write_tokens(docs, tokenizer, folder, sequence)
    return stream_starts(read_tokens(index, folder), index).select("doc_id", "start", "n_tokens", "ids_crc32", "part", "at")

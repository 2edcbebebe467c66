"""What the operators of this subpackage share: session settings, the worker's memory, names, pieces of long texts."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fellwalk.session import settle_session

# Arrow batches are bounded by rows and by bytes, so that a run of very long texts stays small in a Python worker.
LLM_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}

# What separates words: space, tab, line feed, vertical tab, form feed, carriage return (fixed values).
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def settle_llm(spark: SparkSession) -> SparkSession:
    settle_session(spark)
    for key, value in LLM_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def width(spark: SparkSession) -> int:
    """Partitions for a step dealt by an explicit number: the shuffle width of the session, at least its cores."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), spark.sparkContext.defaultParallelism)


def worker_memory(name: str, make: Callable[[], object]) -> object:
    """An object kept for the life of a Python worker.

    Task functions travel by value, so their module globals start anew with every task; a module entry does not.
    """
    module = sys.modules.setdefault("_fellwalk_worker", types.ModuleType("_fellwalk_worker"))
    if not hasattr(module, name):
        setattr(module, name, make())
    return getattr(module, name)


def lean(task: Callable) -> Callable:
    """A task over Arrow batches that gives memory back to the system when it ends.

    Workers live on between tasks, and allocators keep what they once held; an executor pays for its largest task in
    every worker otherwise.
    """

    def run(batches):
        import ctypes
        import gc

        import pyarrow as pa

        yield from task(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
        if trim:
            trim(0)

    return run


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


# ---- cutting a long text at many places in linear time: SQL substrings count from the start of the text each time ----

BLOCK = 1024


def text_blocks(text: Column) -> Column:
    """The text in pieces of ``BLOCK`` code points, for :func:`cut`."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{BLOCK}}}"), F.lit(0))


def cut(blocks: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` (exclusive, from 0) of a text given as blocks."""
    first = F.floor(start / BLOCK).cast("int")
    count = F.floor(end / BLOCK).cast("int") - first + 1
    joined = F.array_join(F.slice(blocks, first + 1, count), "")
    return F.when(end > start, F.substring(joined, (start - first * BLOCK + 1).cast("int"), (end - start).cast("int"))).otherwise("")


# ---- groups of rows in a sorted partition ----


def runs_of(batches, keys: list[str]):
    """Tables of rows with equal ``keys`` from Arrow batches sorted by them; one group at a time is held."""
    import numpy as np
    import pyarrow as pa

    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns)
        bounds = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        if last is not None and first != last:
            yield pa.Table.from_batches(held)
            held = []
        for start, end in zip(bounds[:-2], bounds[1:-1]):
            yield pa.Table.from_batches([*held, batch.slice(start, end - start)])
            held = []
        held.append(batch.slice(bounds[-2]))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


def rooted(first, second):
    """Node and smallest node of its group, for every node of the links ``first[i]`` to ``second[i]`` (numpy arrays)."""
    import numpy as np

    nodes, at = np.unique(np.concatenate([first, second]), return_inverse=True)
    a, b = at[: len(first)], at[len(first) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return nodes, nodes[root]
        np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (root[root] != root).any():
            root = root[root]

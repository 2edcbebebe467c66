"""Conversation prefix trie: what conversations share at their start, with subtree totals by time-forward processing.

1. *Places.* Turns are numbered in their conversation (turn, null first, then role and text). The table is dealt by ranges, so a
   conversation that fills many partitions is numbered in each; at most one conversation crosses each border, and only
   those get an offset.
2. *Nodes.* A prefix is known by two 64-bit hashes: the exclusive-or of the hashes of its turns, each taken with its place. A node
   is a group of equal ``(depth, hashes)``, combined before the shuffle, and its parent's hashes follow from its own last turn.
   Every conversation has a row of depth 0, so the root is a group like any other.
3. *Subtree totals.* A node with one member has one leaf and saves nothing, so only shared nodes are summed. Nodes with more
   than ``limit`` members, and the root, form the top of the trie; the subtrees below them are shards of at most ``limit`` members.
   A shard's nodes are sorted by reverse level order, and each node sends its totals forward in that order to its parent through
   a priority queue that spills sorted runs to the shared folder (:class:`Messages`). The totals of shard roots are combined
   for their parents in the top, which is worked off the same way. The top has at most ``rows / limit`` nodes.
4. *Ends.* The ids that end at a node are sorted by range and joined in pieces of ``PIECE``; one hash per node streams over them.

A shard is one task's stream: its memory is bounded by the queue's, its time follows its nodes. Of rows that agree in conversation,
turn and the first ``TIE`` signs of role and text, all are numbered in one partition.

Nulls and odd input: a null role or text is empty; a null turn comes first; rows with a null ``conv_id`` belong to no conversation
and go; rows that share a turn are turns of their own, by role and text; an empty table gives no rows, not even a root; columns
of other names are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from fellwalk.llm.common import lean, settle_llm, width
from fellwalk.operators.joins import salted_lookup
from fellwalk.workspace import fresh_path, settled

BORROWED = 8  # the most turns that a conversation takes from another one
LEAST_LIMIT, TOP_SHARE = 64, 10_000
BLOCK, PIECE, TIE = 1024, 4096, 32
MOST_PENDING = 1 << 20
KEY = ["depth", "k1", "k2"]


# ---- turns ----


def places(turns: DataFrame) -> DataFrame:
    """``conv_id, pos, t1, t2, bytes``: the place of every turn from 1, two hashes of role and text, the text's UTF-8 bytes."""
    spark = turns.sparkSession
    rows = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    bounds = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.substring("role", 1, TIE), F.substring("text", 1, TIE)]
    dealt = settled(rows.repartitionByRange(width(spark), *bounds).withColumn("_part", F.spark_partition_id()), "turns")
    numbered = dealt.withColumn("_local", F.row_number().over(Window.partitionBy("conv_id", "_part").orderBy(*order)))
    sizes = dealt.groupBy("conv_id", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    # one conversation at most crosses the border of two partitions, so there are fewer offsets than partitions
    offsets = F.broadcast(sizes.withColumn("_before", before).filter("_before > 0").select("conv_id", "_part", "_before"))
    return numbered.join(offsets, ["conv_id", "_part"], "left").select(
        "conv_id", (F.col("_local") + F.coalesce("_before", F.lit(0))).cast("bigint").alias("pos"),
        F.xxhash64(F.lit(1), "role", "text").alias("t1"), F.xxhash64(F.lit(2), "role", "text").alias("t2"),
        F.octet_length("text").cast("bigint").alias("bytes"))


def borrowing(conv_id: Column) -> tuple[Column, Column]:
    """The conversation that another one starts from, and how many of its turns it takes."""
    return conv_id - conv_id % 5, F.crc32(conv_id.cast("string").cast("binary")) % 9


def rebuilt(placed: DataFrame) -> DataFrame:
    """Turns of the rebuilt conversations: the first turns of another one (:func:`borrowing`), then their own after as many."""
    base, most = borrowing(F.col("conv_id"))
    convs = settled(placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns")).select("conv_id", "turns", base.alias("base"), most.alias("most")), "conversations")
    first = placed.filter((F.col("pos") <= BORROWED) & (F.col("conv_id") % 5 == 0)).withColumnRenamed("conv_id", "base")
    taken = first.join(convs.select("conv_id", "base", "most"), "base").filter("pos <= most").drop("base", "most")
    lengths = convs.select(F.col("conv_id").alias("base"), F.col("turns").alias("there"))
    short = convs.join(lengths, "base", "left").select("conv_id", (F.col("most") - F.coalesce("there", F.lit(0))).alias("missing")).filter("missing > 0")
    own = salted_lookup(placed.filter(F.col("pos") > most), short, ["conv_id"], F.col("pos"), "left")
    rest = own.withColumn("pos", F.col("pos") - F.coalesce("missing", F.lit(0))).drop("missing")
    starts = convs.select("conv_id", *[F.lit(0).cast("bigint").alias(c) for c in ("pos", "t1", "t2", "bytes")])
    return starts.unionByName(taken).unionByName(rest)


# ---- nodes ----


def prefixes(turns: DataFrame) -> DataFrame:
    """Rows ``conv_id, depth, k1, k2, p1, p2, bytes``: every prefix of every conversation, with its parent's hashes."""
    mark = lambda name: F.when(F.col("pos") > 0, F.xxhash64(name, "pos")).otherwise(0)
    marked = settled(turns.select("conv_id", F.col("pos").alias("depth"), mark("t1").alias("g1"), mark("t2").alias("g2"), "bytes"), "rebuilt")
    blocked = marked.withColumn("_block", F.floor(F.col("depth") / BLOCK))
    inner = Window.partitionBy("conv_id", "_block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    longs = marked.filter(F.col("depth") == BLOCK).select("conv_id")  # one row for each conversation of several blocks
    totals = blocked.join(longs, "conv_id", "left_semi").groupBy("conv_id", "_block").agg(F.bit_xor("g1").alias("s1"), F.bit_xor("g2").alias("s2"))
    earlier = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("conv_id", "_block", F.bit_xor("s1").over(earlier).alias("b1"), F.bit_xor("s2").over(earlier).alias("b2"))
    running = blocked.select("*", F.bit_xor("g1").over(inner).alias("r1"), F.bit_xor("g2").over(inner).alias("r2")).join(offsets, ["conv_id", "_block"], "left")
    whole = lambda i: F.col(f"r{i}").bitwiseXOR(F.coalesce(f"b{i}", F.lit(0)))
    return running.withColumn("k1", whole(1)).withColumn("k2", whole(2)).select(
        "conv_id", "depth", "k1", "k2", F.col("k1").bitwiseXOR(F.col("g1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("g2")).alias("p2"), "bytes")


def nodes_of(rows: DataFrame) -> DataFrame:
    """One row per node: key, smallest member, members, children, its parent's smallest member and members."""
    groups = settled(rows.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.max("bytes").alias("bytes")), "trie-groups")
    up = (F.col("depth") - 1).alias("depth")
    below = groups.filter("depth > 0").groupBy(up, F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("single"))
    counted = groups.join(below, KEY, "left").fillna(0, ["n_children", "single"])
    # the parent of a node is the only one that can be popular; a parent with one member has the node's own
    parents = groups.filter("n_convs > 1").select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("_up"), F.col("n_convs").alias("_up_convs"))
    joined = salted_lookup(counted, parents, ["depth", "p1", "p2"], F.col("k1"), "left")
    return joined.select(
        *KEY, "conv_id", "n_convs", "n_children", "single", "bytes",
        F.when(F.col("depth") > 0, F.coalesce("_up", "conv_id")).alias("parent_conv_id"),
        F.coalesce("_up_convs", F.lit(1)).alias("parent_convs"))


# ---- subtree totals ----


class Messages:
    """A priority queue of sums sent to nodes that come later in reverse level order.

    All that is sent while one level is worked off belongs to the next, so the queue is two-sided: sorted runs for the level
    that is read, and fresh messages for the one after it. Beyond ``most`` messages a run goes to a file of the shared folder
    and is read back as a stream.
    """

    def __init__(self, folder: str, most: int):
        self.folder, self.most = folder, most
        self.fresh, self.count, self.sealed, self.runs = [], 0, [], []

    def push(self, parent: np.ndarray, values: np.ndarray) -> None:
        """Messages to the next level: addresses and rows of values."""
        self.fresh.append((parent, values))
        self.count += len(parent)
        if self.count > self.most:
            self.sealed.append(self._spilled(*self._sorted()))

    def _sorted(self) -> tuple[np.ndarray, np.ndarray]:
        parent = np.concatenate([p for p, _ in self.fresh])
        values = np.concatenate([v for _, v in self.fresh])
        order = np.argsort(parent, kind="stable")
        parent, first = np.unique(parent[order], return_index=True)
        self.fresh, self.count = [], 0
        return parent, np.add.reduceat(values[order], first)

    def _spilled(self, parent: np.ndarray, values: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(self.folder)
        store.create_dir(root, recursive=True)
        path = f"{root}/{uuid.uuid4().hex}.arrow"
        names = ["parent", *[f"v{i}" for i in range(values.shape[1])]]
        table = pa.table([pa.array(parent), *[pa.array(c) for c in values.T]], names=names)
        with store.open_output_stream(path) as sink, pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table, max_chunksize=1 << 16)

        def read() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            with store.open_input_stream(path) as source:
                for batch in pa.ipc.open_stream(source):
                    columns = [c.to_numpy() for c in batch.columns]
                    yield columns[0], np.stack(columns[1:], axis=1)
            store.delete_file(path)

        return read()

    def next_level(self) -> None:
        """What was pushed so far is now to be taken."""
        if self.fresh:
            self.sealed.append(iter([self._sorted()]))
        self.runs = [[None, run] for run in self.sealed]
        self.sealed = []

    def take(self, nodes: np.ndarray, values: np.ndarray) -> None:
        """Add to ``values`` the messages for ``nodes``, ascending, none of them taken before."""
        for run in self.runs:
            while run[1] is not None:
                if run[0] is None or not len(run[0][0]):
                    run[0] = next(run[1], None)
                    if run[0] is None:
                        run[1] = None
                        break
                parent, sent = run[0]
                end = int(np.searchsorted(parent, nodes[-1], side="right"))
                np.add.at(values, np.searchsorted(nodes, parent[:end]), sent[:end])
                run[0] = (parent[end:], sent[end:])
                if end < len(parent):
                    break


TOTALS = "conv_id bigint, depth bigint, parent_conv_id bigint, top boolean, n_leaves bigint, saved_tokens bigint"


def summed(nodes: DataFrame, folder: str, most: int = MOST_PENDING) -> DataFrame:
    """Subtree totals of nodes sorted, in each partition, by depth (descending) and ``conv_id``.

    A node's address is its depth and smallest member. A node marked ``top`` sends nothing: its parent is elsewhere.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, level = Messages(folder, most), None
        for batch in batches:
            conv, depth, parent = (pc.fill_null(batch.column(c), 0).to_numpy() for c in ("conv_id", "depth", "parent_conv_id"))
            top = batch.column("top").to_numpy(zero_copy_only=False)
            totals = np.stack([batch.column(c).to_numpy() for c in ("n_leaves", "saved_tokens")], axis=1).copy()
            bounds = [0, *(np.flatnonzero(depth[1:] != depth[:-1]) + 1).tolist(), len(depth)] if len(depth) else [0]
            for start, end in zip(bounds[:-1], bounds[1:]):
                if depth[start] != level:
                    queue.next_level()
                    level = depth[start]
                queue.take(conv[start:end], totals[start:end])
                sends = ~top[start:end]
                if sends.any():
                    queue.push(parent[start:end][sends], totals[start:end][sends])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("conv_id", "depth", "parent_conv_id", "top")], pa.array(totals[:, 0]), pa.array(totals[:, 1])],
                                             names=["conv_id", "depth", "parent_conv_id", "top", "n_leaves", "saved_tokens"])

    return nodes.select("conv_id", "depth", "parent_conv_id", "top", "n_leaves", "saved_tokens").mapInArrow(lean(run), TOTALS)


def subtree_totals(nodes: DataFrame, rows: DataFrame, limit: int, most: int = MOST_PENDING) -> DataFrame:
    """``conv_id, depth, n_leaves, saved_tokens`` of all shared nodes: within shards, then across shard roots."""
    spark = nodes.sparkSession
    folder = fresh_path(spark, "trie-queues")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    reverse = [F.col("depth").desc(), F.col("conv_id")]
    shared = nodes.filter("n_convs > 1").select(
        *KEY, "conv_id", "parent_conv_id",
        (F.col("single") + F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"),
        ((F.col("n_convs") > limit) | (F.col("depth") == 0)).alias("popular"),
        ((F.col("parent_convs") > limit) | (F.col("depth") == 1)).alias("top"))
    light = shared.filter("NOT popular")
    # the shard of a conversation: its one node below the top that other conversations share
    roots = light.filter("top").select(*KEY, F.xxhash64(*KEY).alias("shard"))
    shards = rows.select(*KEY, "conv_id").join(roots, KEY).select("conv_id", "shard")
    placed = salted_lookup(light, shards, ["conv_id"], F.col("depth"))
    within = settled(summed(placed.repartition(width(spark), "shard").sortWithinPartitions(*reverse), folder, most), "trie-shards")
    sent = within.filter("top").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_saved"))
    tops = shared.filter("popular").join(sent, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "parent_conv_id", (F.col("depth") == 0).alias("top"),
        (F.col("n_leaves") + F.coalesce("_leaves", F.lit(0))).alias("n_leaves"), (F.col("saved_tokens") + F.coalesce("_saved", F.lit(0))).alias("saved_tokens"))
    across = summed(tops.coalesce(1).sortWithinPartitions(*reverse), folder, most)
    return within.unionByName(across).select("conv_id", "depth", "n_leaves", "saved_tokens")


# ---- ends ----


def end_hashes(turns: DataFrame) -> DataFrame:
    """``depth, k1, k2, ends_sha256`` for every node at which conversations end, from rows of :func:`prefixes`."""
    parts = width(turns.sparkSession)
    last = F.max(F.struct("depth", "k1", "k2"))
    ends = turns.groupBy("conv_id").agg(last.alias("_end")).select("_end.*", "conv_id")

    def cuts(columns: list[np.ndarray]) -> list[int]:
        """Where another node starts."""
        new = np.zeros(len(columns[0]), dtype=bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        return [0, *np.flatnonzero(new).tolist()] if len(new) else []

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(k).to_numpy() for k in KEY]
            ids = batch.column("conv_id").to_numpy()
            starts = cuts(keys)
            pieces = [(at, min(at + PIECE, end)) for start, end in zip(starts, [*starts[1:], len(ids)]) for at in range(start, end, PIECE)]
            first = np.asarray([a for a, _ in pieces], dtype=np.int64)
            joined = [",".join(map(str, ids[a:b].tolist())) for a, b in pieces]
            yield pa.RecordBatch.from_arrays([*[pa.array(k[first]) for k in keys], pa.array(ids[first]), pa.array(joined, pa.string())], names=[*KEY, "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state, done = None, None, []
        for batch in batches:
            for *key, ids in zip(*[batch.column(c).to_pylist() for c in (*KEY, "ids")]):
                if key == held:
                    state.update(b",")
                else:
                    if held is not None:
                        done.append((*held, state.hexdigest()))
                    held, state = key, hashlib.sha256()
                state.update(ids.encode())
            if len(done) > PIECE:
                yield table(done)
                done = []
        if held is not None:
            yield table([*done, (*held, state.hexdigest())])

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=[*KEY, "ends_sha256"])

    order = [*KEY, "conv_id"]
    key_types = "depth bigint, k1 bigint, k2 bigint"
    joined = ends.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(lean(join), f"{key_types}, first bigint, ids string")
    return joined.repartition(parts, *KEY).sortWithinPartitions(*KEY, "first").mapInArrow(lean(digest), f"{key_types}, ends_sha256 string")


EMPTY_HASH = hashlib.sha256(b"").hexdigest()


def prefix_trie(turns: DataFrame, limit: int | None = None, most: int = MOST_PENDING) -> DataFrame:
    """The operator: one row per node of the trie of rebuilt conversations ``conv_id, turn, role, text``.

    ``limit``: members above which a node belongs to the top; by default the conversations divided by ``TOP_SHARE``.
    """
    spark = settle_llm(turns.sparkSession)
    rows = settled(prefixes(rebuilt(settled(places(turns), "places"))), "prefixes")
    nodes = settled(nodes_of(rows), "trie-nodes")
    if limit is None:
        limit = max(LEAST_LIMIT, rows.filter("depth = 0").count() // TOP_SHARE)
    totals = settled(subtree_totals(nodes, rows, limit, most), "trie-totals")
    known = nodes.join(totals, ["conv_id", "depth"], "left").join(end_hashes(rows), KEY, "left")
    return known.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY_HASH)).alias("ends_sha256"))

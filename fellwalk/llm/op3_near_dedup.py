"""MinHash near-deduplication with an LSH forest, confirmed on full shingle sets.

1. **Sketch.** Every text becomes its set of five-word shingles (64-bit hashes), a 128-bit key of the set, and a signature of
   ``TREES * DEPTH`` MinHash values. Texts with equal sets are one class from here on, so copies are never compared.
2. **Forest.** Each tree orders the signatures by its own ``DEPTH`` values, then by those of the trees after it. Classes that share
   the first values, as many as :class:`Forest` says, are a region; a region with more than ``REGION`` classes is parted by
   one more value, and so on, so the depth follows the density. Within a region those whose whole signatures agree in a likely
   share of their values are candidates. A region still crowded at full depth is sorted by the whole order, over as many
   tasks as it takes, and every class is held against the ``REGION`` or more on each side of it that have the longest common
   prefixes with it. A region gives a spanning forest, not its pairs; every crowded one also ties its classes to its first
   class when they agree.
3. **Groups.** The connected components of the candidates over all trees hold every link (up to the forest's misses).
4. **Confirmation.** Inside a group all pairs are held against each other on their full sets, in blocks of ``BLOCK`` classes
   per task. A group of several blocks first meets its pivot, the class nearest to the group's most common signature; the
   classes linked to the pivot are connected already, so only the others meet all blocks. No pair goes untested unless
   its two classes are known to be connected, and a block gives a spanning forest of its links.
5. **Components** of the links, and the smallest ``doc_id`` of each.

The similarity is a parameter; depth, trees and the likely share follow from it, so that a pair at that similarity is missed by all
trees with a probability below ``MISS``: 24 trees from depth 5 at 0.85, 27 from depth 4 at 0.8. In regions crowded at full depth
neighbours in the order take the place of shared prefixes; there is no such bound, but families so dense are chains of neighbours.

Nulls and odd input: a null text, or one without words, has the empty set, is linked with nothing and is kept; a text of
fewer than five words is one shingle; rows with a null ``doc_id`` take part and are kept only where their whole component has
null ids; repeated rows are copies of each other; an empty table gives no rows; columns of other names are kept by
:func:`deduplicate` and ignored by :func:`groups`.
"""

from __future__ import annotations

import dataclasses
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from fellwalk.llm.common import lean, rooted, runs_of, settle_llm, width
from fellwalk.llm.tokens import pieces_of
from fellwalk.operators.components import connected_components
from fellwalk.operators.joins import salted_lookup
from fellwalk.workspace import settled

SHINGLE = 5
SIMILAR = (85, 100)  # links have 100 * intersection >= 85 * union
DEPTH, MISS, DEVIATIONS = 8, 1e-6, 5.8
REGION = 64
BLOCK = 128
RUN = 256
SKETCHED_CHARS = 1 << 21  # characters sketched at a time



@dataclasses.dataclass(frozen=True)
class Forest:
    """What follows from the similarity of links, a fraction of two integers."""

    similar: tuple[int, int]

    @property
    def share(self) -> float:
        return self.similar[0] / self.similar[1]

    @property
    def least(self) -> int:
        """The first depth: the deepest at which a tree holds two fifths of the pairs at the similarity."""
        return max(1, min(DEPTH, math.floor(math.log(0.4) / math.log(min(self.share, 0.99)))))

    @property
    def trees(self) -> int:
        return math.ceil(math.log(MISS) / math.log(1 - self.share**self.least))

    @property
    def likely(self) -> float:
        """The share of equal values that a pair at the similarity hardly ever falls below."""
        return self.share - DEVIATIONS * math.sqrt(self.share * (1 - self.share) / (self.trees * DEPTH))


SKETCH = "doc_id bigint, text_hash bigint, n_shingles bigint, node bigint, key bigint, signature binary"
EDGE = "a bigint, b bigint"


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(32))


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes."""
    import xxhash

    if not texts:
        return []
    split = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string())))
    coded = split.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names), dtype=np.uint64, count=len(names))
    at = coded.indices.to_numpy()
    full = np.fromiter(map(bool, names), dtype=bool, count=len(names))[at]  # blanks at an end give an empty string
    bounds = np.append(0, np.cumsum(full))[split.offsets.to_numpy() - split.offsets[0].as_py()]
    words = hashes[at[full]]
    factors = _mixed(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)
    sums = np.zeros(max(0, len(words) - SHINGLE + 1), dtype=np.uint64)
    for j in range(SHINGLE):
        sums += words[j : len(words) - SHINGLE + 1 + j] * factors[j]
    shingles, out = _mixed(sums), []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= SHINGLE:
            out.append(np.unique(shingles[a : b - SHINGLE + 1]))
        else:
            short = np.append(words[a:b] * factors[: b - a], np.asarray([b - a], dtype=np.uint64) * factors[-1:])
            out.append(_mixed(short.sum(dtype=np.uint64, keepdims=True)[: b > a]))
    return out


def _multipliers(forest: Forest) -> np.ndarray:
    return np.random.default_rng(20_240_229).integers(0, 1 << 32, size=forest.trees * DEPTH, dtype=np.uint32) | np.uint32(1)


def signature(shingles: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """MinHash values of a set, the low 16 bits of each."""
    low = np.full(len(multipliers), np.iinfo(np.uint32).max, dtype=np.uint32)
    halves = (shingles >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(halves), 2048):
        products = halves[start : start + 2048, None] * multipliers[None, :]
        products ^= products >> np.uint32(15)
        np.minimum(low, products.min(axis=0), out=low)
    return (low ^ (low >> np.uint32(16))).astype("<u2")


def sketches(docs: DataFrame, forest: Forest) -> DataFrame:
    """One row per document, settled: its set's size, node (64 bits of the set's key), the other 64 bits, and signature."""
    settle_llm(docs.sparkSession)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        multipliers = _multipliers(forest)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            sizes, nodes, keys, signatures = [], [], [], []
            for run in pieces_of(texts, SKETCHED_CHARS):
                for shingles in shingle_sets([texts[i] for i in run]):
                    raw = xxhash.xxh3_128_digest(shingles.tobytes())
                    node, key = np.frombuffer(raw, dtype=np.int64).tolist()
                    sizes.append(len(shingles))
                    nodes.append(node)
                    keys.append(key)
                    signatures.append(signature(shingles, multipliers).tobytes() if len(shingles) else None)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                pa.array(keys, pa.int64()), pa.array(signatures, pa.binary())], names=[c.split()[0] for c in SKETCH.split(", ")])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return settled(rows.mapInArrow(lean(sketch), SKETCH), "sketches")


def _region_keys(depth: int, trees_: int):
    """A task function from ``node, signature`` (and trees) to regions at a depth."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _mixed(np.arange(1, DEPTH + 2, dtype=np.uint64)) | np.uint64(1)
        for batch in batches:
            if not batch.num_rows:
                continue
            node = batch.column("node").to_numpy()
            values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), dtype="<u2").reshape(len(node), trees_, DEPTH)
            sums = (values[:, :, :depth].astype(np.uint64) + np.uint64(1)) @ factors[:depth]
            trees = np.arange(trees_, dtype=np.uint64)
            region = _mixed(sums + (trees + np.uint64(1)) * factors[-1]).view(np.int64)
            if "tree" in batch.schema.names:
                tree = batch.column("tree").to_numpy()
                region = region[np.arange(len(node)), tree]
                nodes = node
            else:
                tree, nodes, region = np.tile(np.arange(trees_), len(node)), np.repeat(node, trees_), region.reshape(-1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tree.astype(np.int32)), pa.array(region), pa.array(nodes)], names=["tree", "region", "node"])

    return keys


def _agreements(values: np.ndarray) -> np.ndarray:
    """Share of equal values for every two signatures of a region."""
    return np.stack([(values == row).mean(axis=1) for row in values])


def _forest_of(first: list[np.ndarray], second: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of edges given in pieces."""
    if first:
        node, root = rooted(np.concatenate(first), np.concatenate(second))
        apart = node != root
        if apart.any():
            yield pa.RecordBatch.from_arrays([pa.array(node[apart]), pa.array(root[apart])], names=["a", "b"])


def _likely_pairs(table: pa.Table, likely: float) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the likely pairs among some classes."""
    nodes = table.column("node").to_numpy()
    values = np.frombuffer(b"".join(table.column("signature").to_pylist()), dtype="<u2").reshape(len(nodes), -1)
    a, b = np.nonzero(np.triu(_agreements(values) >= likely, 1))
    if not len(a):
        return nodes[:0], nodes[:0]
    node, root = rooted(nodes[a], nodes[b])
    return node[node != root], root[node != root]


def _candidates(likely: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Spanning forests of the likely pairs in each region, joined over all regions of the task."""
        first, second = [], []
        for table in runs_of(batches, ["region"]):
            if table.num_rows > 1:
                a, b = _likely_pairs(table, likely)
                first.append(a)
                second.append(b)
        yield from _forest_of(first, second)

    return run


def _ties(likely: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The classes that are likely linked to the other one of their row."""
        first, second = [], []
        for batch in batches:
            if batch.num_rows:
                mine, other = (np.frombuffer(b"".join(batch.column(n).to_pylist()), dtype="<u2").reshape(batch.num_rows, -1) for n in ("signature", "other"))
                alike = (mine == other).mean(axis=1) >= likely
                first.append(batch.column("node").to_numpy()[alike])
                second.append(batch.column("_first").to_numpy()[alike])
        yield from _forest_of(first, second)

    return run


def _orders(trees_: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The place of a class in its tree's order: all values, from the tree's own on, as bytes that sort like them."""
        for batch in batches:
            if not batch.num_rows:
                continue
            tree = batch.column("tree").to_numpy()
            values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), dtype="<u2").reshape(len(tree), trees_ * DEPTH)
            turned = values[np.arange(len(tree))[:, None], (np.arange(trees_ * DEPTH) + tree[:, None] * DEPTH) % (trees_ * DEPTH)].astype(">u2")
            yield pa.RecordBatch.from_arrays(
                [batch.column("region"), pa.array([row.tobytes() for row in turned], pa.binary()), batch.column("node"), batch.column("signature")],
                names=["region", "place", "node", "signature"])

    return run


def _neighbours(likely: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Likely pairs among classes near each other in the order of their region: windows of three ``REGION``, each a ``REGION`` on."""
        first, second, held, region = [], [], None, None

        def take(table: pa.Table) -> None:
            a, b = _likely_pairs(table, likely)
            first.append(a)
            second.append(b)

        for batch in batches:
            key = batch.column("region").to_numpy()
            bounds = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)] if len(key) else [0]
            for start, end in zip(bounds[:-1], bounds[1:]):
                some = pa.Table.from_batches([batch.slice(start, end - start).select(["node", "signature"])])
                if region == key[start] and held is not None:
                    held = pa.concat_tables([held, some])
                else:
                    if held is not None and held.num_rows > 1:
                        take(held)
                    held, region = some, key[start]
                while held.num_rows > 3 * REGION:
                    take(held.slice(0, 3 * REGION))
                    held = held.slice(REGION).combine_chunks()
        if held is not None and held.num_rows > 1:
            take(held)
        yield from _forest_of(first, second)

    return run


def candidate_edges(classes: DataFrame, forest: Forest) -> DataFrame:
    """Edges ``a, b`` whose components hold the likely pairs of ``classes`` (``node, signature``)."""
    spark = classes.sparkSession
    keys = "tree int, region bigint, node bigint"
    placed, found, edges = classes.mapInArrow(_region_keys(forest.least, forest.trees), keys), [], []
    for depth in range(forest.least, DEPTH + 1):
        placed = settled(placed, "regions")
        counts = settled(placed.groupBy("region").agg(F.count(F.lit(1)).alias("_n"), F.min("node").alias("_first")).filter("_n > 1"), "region-counts")
        # popular regions are split over salts before the join
        members = salted_lookup(placed, counts, ["region"], F.col("node"))
        if counts.filter(F.col("_n") > REGION).isEmpty():
            found.append(members.select("region", "node"))
            break
        members = settled(members, "members")
        found.append(members.filter(F.col("_n") <= REGION).select("region", "node"))
        crowded = members.filter(F.col("_n") > REGION)
        signed = crowded.select("tree", "region", "node", "_first").join(classes, "node")
        # every class against the first class of its crowded region; those are few
        firsts = classes.join(counts.filter(F.col("_n") > REGION).select(F.col("_first").alias("node")).dropDuplicates(), "node", "left_semi")
        beside = salted_lookup(signed.filter("node <> _first"), firsts.select(F.col("node").alias("_first"), F.col("signature").alias("other")), ["_first"], F.col("node"))
        edges.append(beside.select("node", "signature", "_first", "other").mapInArrow(lean(_ties(forest.likely)), EDGE))
        if depth < DEPTH:
            placed = signed.select("tree", "node", "signature").mapInArrow(_region_keys(depth + 1, forest.trees), keys)
        else:
            ordered = signed.drop("_first").mapInArrow(lean(_orders(forest.trees)), "region bigint, place binary, node bigint, signature binary")
            dealt = ordered.repartitionByRange(width(spark), "region", "place").sortWithinPartitions("region", "place")
            edges.append(dealt.select("region", "node", "signature").mapInArrow(lean(_neighbours(forest.likely)), EDGE))
    regions = found[0]
    for more in found[1:]:
        regions = regions.unionByName(more)
    signed = regions.join(classes, "node").select("region", "node", "signature")
    dealt = signed.repartition(width(spark), "region").sortWithinPartitions("region")
    out = dealt.mapInArrow(lean(_candidates(forest.likely)), EDGE)
    for more in edges:
        out = out.unionByName(more)
    return out


def intersections(sets: list[np.ndarray], left: int, columns: int = 1 << 14) -> np.ndarray:
    """Sizes of the intersections of the first ``left`` sets with all; shingles in one set alone are left out early."""
    values, at, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = counts[at] > 1
    number = (np.cumsum(counts > 1) - 1)[at[shared]]
    owner = owner[shared]
    order = np.argsort(number, kind="stable")
    number, owner = number[order], owner[order]
    total = np.zeros((left, len(sets)), dtype=np.int64)
    for start in range(0, int(number[-1]) + 1 if len(number) else 0, columns):
        a, b = np.searchsorted(number, [start, start + columns])
        wide = np.zeros((len(sets), min(columns, int(number[-1]) + 1 - start)), dtype=np.float32)
        wide[owner[a:b], number[a:b] - start] = 1
        total += (wide[:left] @ wide.T).astype(np.int64)
    return total


def linked_pairs(sets: list[np.ndarray], left: int, similar: tuple[int, int] = SIMILAR) -> tuple[np.ndarray, np.ndarray]:
    """Positions of linked sets, the first of each pair among the first ``left``."""
    shared = intersections(sets, left)
    size = np.asarray([len(s) for s in sets])
    union = size[:left, None] + size[None, :] - shared
    return np.nonzero(similar[1] * shared >= similar[0] * union)


def _confirm(similar: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Spanning forests of the links between the ``left`` rows of each group and all its rows."""
        for table in runs_of(batches, ["group", "i", "j"]):
            left = table.column("left").to_numpy(zero_copy_only=False).astype(bool)
            order = np.argsort(~left, kind="stable")
            nodes = table.column("node").to_numpy()[order]
            raw = table.column("shingles").to_pylist()
            sets = [np.frombuffer(raw[k], dtype=np.uint64) for k in order]
            if left.any() and len(sets) > 1:
                a, b = linked_pairs(sets, int(left.sum()), similar)
                yield from _forest_of([nodes[a]], [nodes[b]])

    return run


def _in_groups(rows: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Links of rows ``group, i, j, left, node, shingles``."""
    dealt = rows.repartition(width(rows.sparkSession), "group", "i", "j").sortWithinPartitions("group", "i", "j")
    return dealt.select("group", "i", "j", "left", "node", "shingles").mapInArrow(lean(_confirm(similar)), EDGE)


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``group, signature``: the most frequent value at every place, for each run of a group."""
    for table in runs_of(batches, ["group", "salt"]):
        values = np.sort(np.frombuffer(b"".join(table.column("signature").to_pylist()), dtype="<u2").reshape(table.num_rows, -1), axis=0)
        best, most = values[0].copy(), np.zeros(values.shape[1], dtype=np.int64)
        length = np.zeros(values.shape[1], dtype=np.int64)
        for k in range(len(values)):  # the longest run of equal values of each column
            length = np.where(values[k] == values[k - 1], length + 1, 1) if k else length + 1
            better = length > most
            best[better], most[better] = values[k][better], length[better]
        yield pa.RecordBatch.from_arrays([table.column("group").combine_chunks()[:1], pa.array([best.tobytes()], pa.binary())], names=["group", "signature"])


def _nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``group, node, agreement``: of each run, the class nearest to the signature that comes first in the run."""
    for table in runs_of(batches, ["group", "salt"]):
        values = np.frombuffer(b"".join(table.column("signature").to_pylist()), dtype="<u2").reshape(table.num_rows, -1)
        agreement = (values[1:] == values[0]).sum(axis=1)
        if len(agreement):
            best = int(np.argmax(agreement))
            yield pa.RecordBatch.from_arrays([
                table.column("group").combine_chunks()[:1], pa.array([table.column("node")[best + 1].as_py()], pa.int64()),
                pa.array([int(agreement[best])], pa.int64())], names=["group", "node", "agreement"])


def _pivots(members: DataFrame) -> DataFrame:
    """``group, pivot``: the class nearest to the most common signature of its group; ``members`` are ``group, node, signature``.

    The common signature is taken over runs of about ``RUN`` classes, then over the signatures of the runs, and so on.
    """
    width_ = width(members.sparkSession)

    def in_runs(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        counts = settled(rows.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / RUN).cast("int").alias("_runs")), "runs")
        return rows.join(counts, "group").withColumn("salt", F.pmod(F.xxhash64(name), F.col("_runs")).cast("int")), counts

    placed, runs = in_runs(members, "node")
    placed = settled(placed, "placed")
    rows, counts = placed, runs
    while True:
        dealt = rows.select("group", "salt", "signature").repartition(width_, "group", "salt").sortWithinPartitions("group", "salt")
        common = settled(dealt.mapInArrow(_common, "group bigint, signature binary"), "common")
        if (counts.agg(F.max("_runs")).first()[0] or 0) <= 1:
            break
        rows, counts = in_runs(common, "signature")
    first = common.join(runs, "group").select(
        "group", F.explode(F.sequence(F.lit(0), F.col("_runs") - 1)).alias("salt"), F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("node"), "signature")
    both = first.unionByName(placed.select("group", "salt", F.lit(1).alias("kind"), "node", "signature"))
    dealt = both.repartition(width_, "group", "salt").sortWithinPartitions("group", "salt", "kind")
    near = dealt.mapInArrow(_nearest, "group bigint, node bigint, agreement bigint")
    return near.groupBy("group").agg(F.max_by("node", F.struct("agreement", "node")).alias("pivot"))


def links(docs: DataFrame, sketched: DataFrame, forest: Forest) -> DataFrame:
    """Edges ``a, b`` between nodes, whose components are those of all links."""
    spark = docs.sparkSession
    filled = sketched.filter("n_shingles > 0")
    classes = settled(
        filled.groupBy("node", "key").agg(F.min(F.struct("doc_id", "text_hash")).alias("_doc"), F.first("signature").alias("signature")), "classes")
    grouped = connected_components(candidate_edges(classes.select("node", "signature"), forest))
    sizes = grouped.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    members = settled(grouped.join(sizes, "root").select(F.col("root").alias("group"), "node", "members"), "members")

    # the sets of the members alone, made again from one text of each class
    wanted = classes.join(members.select("node"), "node").select("node", "_doc.doc_id", "_doc.text_hash")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("_id"), F.xxhash64("text").alias("_hash"), "text")
    matched = texts.join(wanted, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("text_hash")))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts_ = batch.column("text").to_pylist()
            for run in pieces_of(texts_, SKETCHED_CHARS):
                found = [s.tobytes() for s in shingle_sets([texts_[i] for i in run])]
                yield pa.RecordBatch.from_arrays([batch.column("node").take(pa.array(run)), pa.array(found, pa.binary())], names=["node", "shingles"])

    one_text = matched.select("node", "text").dropDuplicates(["node"])
    full = settled(one_text.mapInArrow(lean(sets), "node bigint, shingles binary"), "sets")

    zero = F.lit(0)
    small = members.filter(F.col("members") <= BLOCK).join(full, "node")
    edges = _in_groups(small.select("group", zero.alias("i"), zero.alias("j"), F.lit(True).alias("left"), "node", "shingles"), forest.similar)
    large = members.filter(F.col("members") > BLOCK)
    if large.isEmpty():
        return edges
    pivots = settled(_pivots(large.join(classes, "node").select("group", "node", "signature")), "pivots")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("node"), blocks).cast("int")
    with_sets = large.join(full, "node").withColumn("j", block)
    first = pivots.join(large.groupBy("group").agg(F.max(blocks).alias("_blocks")), "group").join(full, F.col("pivot") == F.col("node"))
    at_pivot = first.select("group", zero.alias("i"), F.explode(F.sequence(zero, F.col("_blocks") - 1)).alias("j"), F.lit(True).alias("left"), "node", "shingles")
    others = with_sets.join(pivots, (with_sets["group"] == pivots["group"]) & (F.col("node") == F.col("pivot")), "left_anti")
    star = settled(_in_groups(at_pivot.unionByName(others.select("group", zero.alias("i"), "j", F.lit(False).alias("left"), "node", "shingles")), forest.similar), "stars")

    core = star.select(F.explode(F.array("a", "b")).alias("node")).unionByName(pivots.select(F.col("pivot").alias("node"))).dropDuplicates()
    loose = settled(large.join(core, "node", "left_anti"), "loose")
    loose_blocks = loose.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("_loose"))
    numbered = loose.join(loose_blocks, "group").select("group", "node", "members", F.pmod(F.xxhash64(F.lit(1), "node"), F.col("_loose")).cast("int").alias("i"))
    left = numbered.join(full, "node").select(
        "group", "i", F.explode(F.sequence(zero, F.ceil(F.col("members") / BLOCK).cast("int") - 1)).alias("j"), F.lit(True).alias("left"), "node", "shingles")
    right = with_sets.join(loose_blocks, "group").select(
        "group", F.explode(F.sequence(zero, F.col("_loose") - 1)).alias("i"), "j", F.lit(False).alias("left"), "node", "shingles")
    rest = _in_groups(left.unionByName(right), forest.similar)
    return edges.unionByName(star).unionByName(rest)


def groups(docs: DataFrame, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id, kept`` of every document; ``similar``, a fraction, is the least of a link."""
    forest = Forest(similar)
    sketched = sketches(docs, forest)
    roots = connected_components(links(docs, sketched, forest))
    # thousands of copies share a node and a component; both lookups hold only what more than one text or row has
    rooted_rows = salted_lookup(sketched.filter("n_shingles > 0"), roots, ["node"], F.col("doc_id"), "left")
    filled = rooted_rows.withColumn("_component", F.coalesce("root", "node"))
    smallest = filled.groupBy("_component").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    together = salted_lookup(filled, smallest.select("_component", "component_id"), ["_component"], F.col("doc_id"), "left")
    found = together.select("doc_id", "text_hash", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "_component")
    alone = sketched.filter("n_shingles = 0").select(
        "doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(None).cast("bigint").alias("_component"))
    return found.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """The documents with one of each component: that of the smallest ``doc_id``, then text hash. All columns stay."""
    found = groups(docs, similar).filter("n_shingles > 0")
    order = F.struct(F.col("doc_id").isNull().alias("_null"), "doc_id", "text_hash")
    keepers = settled(found.groupBy("_component").agg(F.min(order).alias("_keep")).select(
        F.col("_keep.doc_id").alias("_keep_id"), F.col("_keep.text_hash").alias("_keep_hash")), "keepers")
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    marked = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("bigint").alias("_id"), F.xxhash64("text").alias("_hash"), has_words.alias("_words"))
    kept = marked.filter("_words").join(keepers, F.col("_id").eqNullSafe(F.col("_keep_id")) & (F.col("_hash") == F.col("_keep_hash")), "left_semi")
    one = kept.dropDuplicates(["_id", "_hash"])
    return one.unionByName(marked.filter("NOT _words")).select("_row.*")

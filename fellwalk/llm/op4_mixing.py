"""Mixing sources to target weights: whole documents repeated so that every source gives about its target.

Sizes are summed per source; a source's target is its weight's part of the mix, but at most ``MAX_REPEATS`` times its own size,
the rest going to the others by weight. Its rate is target / size. Every document is taken ``floor(rate)`` times, and once
more by a Bernoulli draw whose probability is the fraction and whose seed is a hash of the document. A document's draw
depends on nothing but the document, the seed and its source's rate, so reruns and retries agree.

A few large documents can carry a plain draw far from the target. Therefore ``SEEDS`` draws are summed per source in one
pass, and each source uses the seed that comes nearest to its target. Sources are a small table beside the documents (one row
per source); the documents are joined to it without moving more than ids, sizes and hashes.

Nulls and odd input: a null text has size 0; null sources are one source, after all others; null and repeated ids are mixed row
by row (rows equal in id and text share their draw); a mix without words takes nothing; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fellwalk.llm.common import WORD
from fellwalk.operators.joins import salted_lookup
from fellwalk.workspace import settled

WEIGHTS = (3.0, 1.0, 2.0)
MIX_SHARE = 1.5
MAX_REPEATS = 2.0
SEEDS = 32


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_weights(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size, weight``: the weights in turn over the sources by code point, null last."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sizes.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), place % len(weights)))


def capped_shares(sources: DataFrame, share: float = MIX_SHARE, cap: float = MAX_REPEATS) -> DataFrame:
    """Adds ``target``: weight times one level for all, but at most ``cap`` times the source's size.

    Resharing an excess until no source is above its cap ends at one level for all sources below theirs. In order of cap
    per weight, the sources before some place are capped; the level is what the mix leaves for the others, by weight. The
    first source whose cap is not below the level of its place ends the capped ones.
    """
    most = F.col("source_size") * cap
    order = Window.orderBy((most / F.col("weight")), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy()
    levelled = (
        sources.withColumn("_most", most)
        .withColumn("_left", F.sum("source_size").over(everywhere) * share - F.coalesce(F.sum("_most").over(before), F.lit(0.0)))
        .withColumn("_weights", F.sum("weight").over(everywhere) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("_level", F.col("_left") / F.col("_weights"))
        .withColumn("_open", F.col("_most") >= F.col("weight") * F.col("_level"))
    )
    level = F.min_by("_level", F.when(F.col("_open"), F.col("_most") / F.col("weight"))).over(everywhere)
    target = F.least(F.col("_most"), F.coalesce(level * F.col("weight"), F.col("_most")))
    return levelled.withColumn("target", target).select("source", "source_size", "weight", "target")


def _extra(seed: Column, fraction: Column) -> Column:
    """The Bernoulli draw of a document under a seed: a hash as a number from 0 to 1, below the fraction."""
    number = F.pmod(F.xxhash64(seed, F.col("_hash")), F.lit(1 << 52)) / F.lit(float(1 << 52))
    return (number < fraction).cast("bigint")


def _key(source: Column) -> Column:
    """Sources as a key that is never null."""
    return F.when(source.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), source))


def rates(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = MIX_SHARE, cap: float = MAX_REPEATS, seeds: int = SEEDS) -> DataFrame:
    """``_source, source_size, target, _whole, _fraction, _seed`` of every source; ``docs`` are :func:`measured`."""
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = settled(capped_shares(source_weights(sizes, weights), share, cap), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rated = targets.select(
        _key(F.col("source")).alias("_source"), "source_size", "target",
        F.floor(rate).alias("_whole"), (rate - F.floor(rate)).alias("_fraction"))
    drawn = salted_lookup(docs, rated.select("_source", "_fraction"), ["_source"], F.col("_hash"))
    sums = drawn.groupBy("_source").agg(*[F.sum(F.col("size") * _extra(F.lit(k), F.col("_fraction"))).alias(f"_{k}") for k in range(seeds)])
    error = lambda k: F.abs(F.col(f"_{k}") - F.col("_fraction") * F.col("source_size"))
    nearest = F.array_min(F.array(*[F.struct(error(k).alias("error"), F.lit(k).alias("seed")) for k in range(seeds)]))["seed"]
    return settled(rated.join(sums, "_source").select(*rated.columns, nearest.alias("_seed")), "rates")


def measured(docs: DataFrame) -> DataFrame:
    """What the mix needs of every document: ``doc_id, source, size`` and a key and a hash."""
    return docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), _key(F.col("source")).alias("_source"),
        F.xxhash64("doc_id", "text").alias("_hash"))


def with_copies(measured_docs: DataFrame, rated: DataFrame) -> DataFrame:
    joined = salted_lookup(measured_docs, rated, ["_source"], F.col("_hash"))
    return joined.withColumn("copies", F.col("_whole") + _extra(F.col("_seed"), F.col("_fraction")))


def shares(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document."""
    sized = settled(measured(docs), "sizes")
    return with_copies(sized, rates(sized)).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, all columns kept."""
    rated = rates(settled(measured(docs), "sizes"))
    marked = docs.select(F.struct("*").alias("_row"), _key(F.col("source")).alias("_source"), F.xxhash64("doc_id", "text").alias("_hash"))
    taken = with_copies(marked, rated).filter("copies > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))).select("_row.*")

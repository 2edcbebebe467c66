"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fellwalk.session import parallelism
from fellwalk.workspace import settled

SALTS = 16


def salted_lookup(
    probe: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread: Column,
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Join many ``probe`` rows to a ``lookup`` that has one or few rows per key.

    The probe rows of one key are spread over ``salts`` partitions by ``spread`` (a column
    that differs between rows of the same key, such as a row id), and every lookup row is
    repeated once per salt.  The hot key is split before the shuffle, so the result does
    not depend on run-time skew handling.  A small lookup is still broadcast by the
    planner, which measures it; a partition that stays too large is split further by adaptive
    execution, which measures it too.
    """
    left = probe.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    right = lookup.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


HITTERS = 4  # keys with more than this part of a task's even share of the rows are heavy


def heavy_keys(probe: DataFrame, keys: Sequence[str], counts: DataFrame | None = None) -> DataFrame:
    """The keys that hold more than an even share of the rows, and over how many salts each should go: ``keys``, ``salts``.

    A share is the rows of a task, divided by ``HITTERS``; so there are at most ``HITTERS`` keys for each task, whatever the
    data, and as many salts again.  ``counts`` (``keys``, ``n``) saves the pass that counts the rows of every key.
    """
    tasks = parallelism(probe.sparkSession) * HITTERS
    counted = counts if counts is not None else probe.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    share = F.greatest(counted.agg(F.sum("n")).scalar() / tasks, F.lit(1.0))
    return settled(counted.withColumn("_share", share).filter(F.col("n") > F.col("_share")).select(*keys, F.ceil(F.col("n") / F.col("_share")).cast("int").alias("salts")), "heavy")


def balanced_lookup(
    probe: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread: Column,
    how: str = "inner",
    counts: DataFrame | None = None,
    hint: str | None = None,
) -> DataFrame:
    """:func:`salted_lookup` in which only heavy keys are salted, each over as many salts as its rows call for.

    Rows of the lookup are written once, those of a heavy key once a salt: ``HITTERS`` rows a task more in all.  The heavy
    keys are so few by construction that they are broadcast to the probe.  ``hint`` goes to the lookup: a written table
    can be a byte a row, and with ``"merge"`` the planner does not take such a file size for one to broadcast.
    """
    heavy = heavy_keys(probe, keys, counts)
    salted = lambda df, salt: same_group_join(df, F.broadcast(heavy), keys, "left").withColumn("_salt", salt).drop("salts")
    salts = F.coalesce("salts", F.lit(1))
    left = salted(probe, F.pmod(F.xxhash64(spread), salts).cast("int"))
    right = salted(lookup, F.explode(F.sequence(F.lit(0), salts - 1)))
    return left.join(right.hint(hint) if hint else right, [*keys, "_salt"], how).drop("_salt")


def same_group_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` as groupings see them: NULL meets NULL.  The key columns are those of ``left``."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys]
    return left.join(renamed, functools.reduce(operator.and_, same), how).drop(*[f"_right_{k}" for k in keys])

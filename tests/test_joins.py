"""Lookups that stay balanced: only heavy keys are salted, and results are those of a plain join."""

import pytest
from pyspark.sql import functions as F

from fellwalk.operators import joins


def probe_of(spark):
    """A third of 9,000 rows has one key, the rest is spread over 1,000; some keys are missing."""
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 301 == 1, F.lit(None).cast("bigint")).otherwise(F.col("id") % 1000)
    return spark.range(9000).select("id", key.alias("k"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_balanced_lookup_is_a_join(spark, how):
    probe = probe_of(spark)
    lookup = spark.range(0, 1000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).unionByName(spark.createDataFrame([(-1, 7)], "k bigint, v bigint"))
    found = joins.balanced_lookup(probe, lookup, ["k"], F.col("id"), how)
    expected = probe.join(lookup, ["k"], how).select(*found.columns)
    assert found.exceptAll(expected).isEmpty() and found.count() == expected.count()


def test_only_heavy_keys_are_salted(spark):
    """One key of 1,001 is heavy: the lookup grows by its salts alone, and its rows are spread over all of them."""
    probe = probe_of(spark)
    heavy = joins.heavy_keys(probe, ["k"]).collect()
    tasks = joins.parallelism(spark) * joins.HITTERS
    assert [r["k"] for r in heavy] == [-1] and tasks / 4 <= heavy[0]["salts"] <= tasks / 2
    assert (1001 + heavy[0]["salts"] - 1) / 1001 <= 1.1
    spread = probe.filter("k = -1").groupBy(F.pmod(F.xxhash64("id"), F.lit(heavy[0]["salts"]))).count().agg(F.max("count")).first()[0]
    assert spread < 3 * 3000 / heavy[0]["salts"]


def test_counts_save_the_pass_and_empty_tables_work(spark):
    probe = probe_of(spark)
    counts = probe.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert sorted(joins.heavy_keys(probe, ["k"], counts).collect()) == sorted(joins.heavy_keys(probe, ["k"]).collect())
    lookup = spark.createDataFrame([(1, 1)], "k bigint, v bigint")
    assert joins.balanced_lookup(probe.limit(0), lookup, ["k"], F.col("id")).collect() == []
    assert joins.balanced_lookup(probe, lookup.limit(0), ["k"], F.col("id"), "left").count() == 9000

"""Schema jobs: bring drifting files to one target schema, and report how schemas differ.

A schema is metadata of bounded size, so it is handled on the driver; the rows stay lazy.
"""

from __future__ import annotations

import functools
import logging
import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

log = logging.getLogger(__name__)

FIELD_COLUMNS = ("name", "data_type", "nullable")


def normal_name(name: str) -> str:
    """Lower case without underscores and hyphens."""
    return re.sub(r"[_-]", "", name.lower())


def enforce(df: DataFrame, target: T.StructType) -> DataFrame:
    """Rename, cast and order the columns of ``df`` to ``target``; extra columns are dropped.

    A value that its target type cannot hold becomes NULL; :func:`lost_values` counts them.
    Columns are matched by normalised name; if two source names normalise alike, the last one
    is taken.  A target field without a source is an error.
    """
    source = {normal_name(f.name): f for f in df.schema}
    missing = [f.name for f in target if normal_name(f.name) not in source]
    if missing:
        raise KeyError(f"no source column for {missing}; the source has {df.columns}")

    columns = []
    for field in target:
        found = source[normal_name(field.name)]
        column = df[f"`{found.name}`"]
        if found.dataType != field.dataType:
            log.info("casting %s from %s to %s", field.name, found.dataType, field.dataType)
            column = column.try_cast(field.dataType)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def lost_values(df: DataFrame, target: T.StructType) -> DataFrame:
    """``name``, ``lost``: the values of each target field that :func:`enforce` turns into NULL."""
    source = {normal_name(f.name): f.name for f in df.schema}
    before = df.select(*[df[f"`{source[normal_name(f.name)]}`"].isNotNull().alias(f"_had_{i}") for i, f in enumerate(target)], *df.columns)
    after = enforce(before, target).columns
    typed = before.select(*[F.col(f"_had_{i}") for i in range(len(after))], *[
        before[f"`{source[normal_name(f.name)]}`"].try_cast(f.dataType).isNull().alias(f"_gone_{i}") for i, f in enumerate(target)])
    counts = typed.agg(*[F.count_if(F.col(f"_had_{i}") & F.col(f"_gone_{i}")).alias(f"_{i}") for i in range(len(after))])
    pairs = F.array(*[F.struct(F.lit(name).alias("name"), F.col(f"_{i}").alias("lost")) for i, name in enumerate(after)])
    return counts.select(F.explode(pairs).alias("p")).select("p.*")


def enforced_union(frames: Iterable[DataFrame], target: T.StructType) -> DataFrame:
    """All frames brought to ``target`` and stacked by name."""
    return functools.reduce(DataFrame.unionByName, [enforce(df, target) for df in frames])


def schema_fields(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """One row per top-level field: name, type text, nullability."""
    fields = [
        F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("data_type"), F.lit(f.nullable).alias("nullable"))
        for f in schema
    ]
    return spark.range(1, numPartitions=1).select(F.explode(F.array(*fields)).alias("f")).select("f.*")


def _pairs(base: DataFrame, others: Mapping[str, DataFrame], compare) -> DataFrame:
    parts = [compare(base, other).withColumn("dataset", F.lit(name)) for name, other in others.items()]
    return functools.reduce(DataFrame.unionByName, parts)


def schema_diff_strict(base: DataFrame, others: Mapping[str, DataFrame]) -> DataFrame:
    """Fields (name, type, nullability) found on one side only, for each other dataset."""

    def compare(left: DataFrame, right: DataFrame) -> DataFrame:
        spark = left.sparkSession
        a, b = schema_fields(spark, left.schema), schema_fields(spark, right.schema)
        return a.exceptAll(b).withColumn("missing_from", F.lit("other")).unionByName(
            b.exceptAll(a).withColumn("missing_from", F.lit("base"))
        )

    return _pairs(base, others, compare).select("dataset", "missing_from", *FIELD_COLUMNS)


def schema_diff(base: DataFrame, others: Mapping[str, DataFrame]) -> DataFrame:
    """One status row per field name and other dataset.

    ``status`` is ``only_base``, ``only_other``, ``type_mismatch`` or ``same``.
    """

    def compare(left: DataFrame, right: DataFrame) -> DataFrame:
        spark = left.sparkSession
        a = schema_fields(spark, left.schema).select("name", F.col("data_type").alias("base_type"))
        b = schema_fields(spark, right.schema).select("name", F.col("data_type").alias("other_type"))
        return a.join(b, "name", "full_outer")

    status = (
        F.when(F.col("other_type").isNull(), "only_base")
        .when(F.col("base_type").isNull(), "only_other")
        .when(F.col("base_type") != F.col("other_type"), "type_mismatch")
        .otherwise("same")
    )
    return _pairs(base, others, compare).select("dataset", "name", "base_type", "other_type", status.alias("status"))

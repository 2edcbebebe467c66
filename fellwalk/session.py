"""Session settings the operators rely on."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the JVM does not compile longer methods; beyond this length separate operators are faster
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app_name: str = "fellwalk", cores: str | int | None = None, **extra: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster the session is given."""
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def settle_session(spark: SparkSession) -> SparkSession:
    """Apply the settings that change results (time zone) or skew handling to a given session."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def parallelism(spark: SparkSession) -> int:
    """Partition count for steps that multiply their rows: the shuffle width, at least the cores."""
    width = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(width, spark.sparkContext.defaultParallelism)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Distribute rows by ``keys`` ahead of a step that turns each into many.

    The number of partitions is explicit, because sizes measured before the step would let the
    planner merge small partitions that are about to grow.
    """
    return df.repartition(parallelism(df.sparkSession), *keys)

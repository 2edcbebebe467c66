"""The shared folder: written tables that cut lineage and survive the loss of an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local session without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="fellwalk-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def settled(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    The returned frame has no lineage, and its known file size lets the planner pick a
    broadcast only where the written table is small.
    """
    return settled_at(df, label)[0]


def settled_at(df: DataFrame, label: str = "table") -> tuple[DataFrame, str]:
    """:func:`settled` with the path of the table, for tables that a later round replaces."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_table(spark: SparkSession, path: str | None) -> None:
    """Remove a table of :func:`settled_at` that nothing reads any more."""
    if path:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)

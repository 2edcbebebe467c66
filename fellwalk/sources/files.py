"""File sources and sinks: drifting parquet parts, CSV, raw files, reports, GeoJSON, layer catalogs."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from fellwalk.functions.numbers import morton
from fellwalk.operators.schemas import enforced_union, normal_name
from fellwalk.session import parallelism
from fellwalk.workspace import settled

TASK_BYTES = 128 << 20  # bytes of files that a task reads


def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """Path and size in bytes of every file that matches; the contents are not read."""
    return spark.read.format("binaryFile").load(pattern).select("path", "length")


def _open(path: str):
    """A stored file by the path that the listing gives."""
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))
    return store.open_input_file(name)


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The schema of each parquet file as Spark's JSON and its row groups, from the file's footer alone."""
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_schema

    for batch in batches:
        schemas, groups = [], []
        for path in batch["path"]:
            with _open(path) as file:
                footer = pq.ParquetFile(file)
                found = footer.schema_arrow
                groups.append(footer.num_row_groups)
            own = (found.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
            schemas.append(own.decode() if own else from_arrow_schema(found, prefer_timestamp_ntz=True).json())
        yield pd.DataFrame({"schema": schemas, "path": batch["path"], "length": batch["length"], "groups": groups})


def manifest_of(spark: SparkSession, pattern: str) -> DataFrame:
    """One written row per parquet file that matches: ``schema``, ``path``, ``length``, ``groups``.  Footers are read in tasks."""
    listed = list_files(spark, pattern).repartition(parallelism(spark))
    return settled(listed.mapInPandas(_footers, "schema string, path string, length bigint, groups int"), "manifest")


def _read_groups(fields: T.StructType):
    """A task function from ``path``, ``group`` to the rows of that row group, with the columns of ``fields`` alone."""
    from pyspark.sql.pandas.types import to_arrow_schema

    wanted, names = to_arrow_schema(fields), fields.names

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        for batch in batches:
            for path, group in zip(batch.column("path").to_pylist(), batch.column("group").to_pylist()):
                with _open(path) as file:
                    for rows in pq.ParquetFile(file, coerce_int96_timestamp_unit="us").iter_batches(row_groups=[group], columns=names):
                        yield from pa.Table.from_batches([rows]).select(names).cast(wanted).to_batches()

    return read


def read_drifting_parts(spark: SparkSession, pattern: str, target: T.StructType) -> DataFrame:
    """All parquet files that match, brought to ``target`` and stacked.

    Types differ between files, so they cannot be read as one table.  The files are listed in a written manifest, whose
    rows are dealt over the tasks by row group; a task reads the groups it holds, the columns of the target alone.  The
    driver sees the distinct schemas and no path, and the plan grows with the number of schemas, not of files.
    """
    manifest = manifest_of(spark, pattern)
    schemas = manifest.groupBy("schema").agg(F.sum("length").alias("length")).orderBy("schema").collect()
    if not schemas:
        raise FileNotFoundError(f"no parquet file matches {pattern}")
    columns, frames = {normal_name(f.name) for f in target}, []
    for row in schemas:
        found = T.StructType.fromJson(json.loads(row["schema"]))
        fields = T.StructType([f for f in found if normal_name(f.name) in columns])
        groups = manifest.filter(F.col("schema") == row["schema"]).select("path", F.explode(F.when(F.col("groups") > 0, F.sequence(F.lit(0), F.col("groups") - 1))).alias("group"))
        tasks = max(parallelism(spark), row["length"] // TASK_BYTES)
        dealt = groups.repartition(tasks, "path", "group")
        frames.append(dealt.mapInArrow(_read_groups(fields), fields))
    return enforced_union(frames, target)


def read_text_table(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """A CSV with a header, all columns as text; an empty value is an empty text, a missing one NULL.

    The reader gives NULL for both, so a row that is cut short is told apart by the reader's
    own mark for rows that do not fit the header.
    """
    names = spark.read.option("header", True).csv(path).columns
    mark = "_misfit"
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, mark]])
    rows = spark.read.schema(schema).option("header", True).option("columnNameOfCorruptRecord", mark).csv(path)
    short = F.col(mark).isNotNull() & rows[f"`{names[-1]}`"].isNull()
    return rows.select(*[F.when(short, rows[f"`{n}`"]).otherwise(F.coalesce(rows[f"`{n}`"], F.lit(""))).alias(n) for n in names])


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """The zone lookup: a CSV with a header whose ``LocationID`` becomes an integer."""
    return spark.read.option("header", True).csv(path).select(
        F.col("LocationID").try_cast("int").alias("LocationID"), "Borough", "Zone"
    )


def read_color_ramp(spark: SparkSession, path: str) -> DataFrame:
    """A colour ramp: lines of value, red, green, blue separated by blanks."""
    parts = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).filter(F.trim("value") != "").select(
        parts[0].cast("double").alias("value"), *[parts[i + 1].cast("int").alias(c) for i, c in enumerate("rgb")]
    )


def write_csv(df: DataFrame, path: str) -> None:
    """A CSV folder with a header, written by all tasks, replacing what was there."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_report(df: DataFrame, path: str, order: Sequence = (), single_file: bool = False) -> None:
    """A sorted CSV report: files whose names follow the order, or one file, which one task writes.

    One file suits results that are small by what they are, such as the top rows of a table.
    """
    if single_file:
        df = df.coalesce(1)
        df = df.sortWithinPartitions(*order) if order else df
    elif order:
        df = df.orderBy(*order)
    write_csv(df, path)


def write_features(df: DataFrame, path: str, properties: Sequence[str], ring: str) -> None:
    """One GeoJSON feature per line, with the polygon whose outer ring is in column ``ring``."""
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(*properties).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.array(F.col(ring)).alias("coordinates")).alias("geometry"),
    )
    df.select(F.to_json(feature).alias("value")).write.mode("overwrite").text(path)


BOUNDS = "_bounds"  # the folder of a layer with the key bounds of its files; readers of the layer pass over it
TILE_KEYS = ("tile_col", "tile_row")


def write_layer(tiles: DataFrame, path: str, files: int | None = None) -> None:
    """A tile table written to a catalog folder, one sub-folder per zoom level.

    The tiles of a level lie along a Morton curve, cut into about ``files`` files (the cores, if not given) in all, so a file
    holds tiles that are near each other, and a written table of bounds says which ones.
    """
    on_curve = tiles.withColumn("_place", morton(*[F.col(k) for k in TILE_KEYS]))
    dealt = on_curve.repartitionByRange(files or parallelism(tiles.sparkSession), "zoom", "_place").sortWithinPartitions("zoom", "_place")
    dealt.drop("_place").write.mode("overwrite").partitionBy("zoom").parquet(path)
    written = tiles.sparkSession.read.parquet(path)
    limits = [f(k).alias(f"{name}_{k}") for k in TILE_KEYS for name, f in (("min", F.min), ("max", F.max))]
    written.groupBy("zoom", F.col("_metadata.file_path").alias("file")).agg(*limits).write.mode("overwrite").parquet(f"{path}/{BOUNDS}")


def layer_files(spark: SparkSession, path: str, zoom: int | None, cols: tuple[int, int], rows: tuple[int, int]) -> list[str]:
    """The files of a written layer that may hold tiles of a window, both ends included: as many as the window has tiles, at most."""
    bounds = spark.read.parquet(f"{path}/{BOUNDS}")
    bounds = bounds if zoom is None else bounds.filter(F.col("zoom") == zoom)
    for key, (first, last) in zip(TILE_KEYS, (cols, rows)):
        bounds = bounds.filter((F.col(f"max_{key}") >= first) & (F.col(f"min_{key}") <= last))
    return sorted(r["file"] for r in bounds.select("file").collect())


def read_layer(
    spark: SparkSession, path: str, zoom: int | None = None, cols: tuple[int, int] | None = None, rows: tuple[int, int] | None = None
) -> DataFrame:
    """A written layer, or one zoom level of it; only that level's folder is read.

    With ``cols`` and ``rows``, ranges of tiles with both ends, only the files whose bounds meet that window are read.
    """
    layer = spark.read.parquet(path)
    if cols and rows:
        found = layer_files(spark, path, zoom, cols, rows)
        layer = spark.read.schema(layer.schema).option("basePath", path).parquet(*found) if found else layer.limit(0)
        layer = layer.filter(F.col("tile_col").between(*cols) & F.col("tile_row").between(*rows))
    return layer if zoom is None else layer.filter(F.col("zoom") == zoom)

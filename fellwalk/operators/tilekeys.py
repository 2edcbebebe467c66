"""Tile keys: text forms, neighbours, and a picture of the occupied keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fellwalk.functions.text import tile_index, tile_key_text

PLUS = ((1, 0), (-1, 0), (0, 1), (0, -1))
BOX = (*PLUS, (1, 1), (-1, 1), (1, -1), (-1, -1))
NO_ZOOM = -1


def zoom_of(zoom: Column) -> Column:
    """The zoom of a key, or -1 for a key without one."""
    return F.coalesce(zoom, F.lit(NO_ZOOM))


def same_zoom(a: Column, b: Column) -> Column:
    return a == b


def formatted_keys(keys: DataFrame) -> DataFrame:
    """Each key with its short text, its index text and the index as an id."""
    index = tile_index(F.col("col"), F.col("row"), F.col("zoom"))
    return keys.select(
        "col", "row", "zoom",
        tile_key_text(F.col("col"), F.col("row"), F.col("zoom")).alias("short"),
        index.alias("index"),
        F.concat(F.lit("id:"), index).alias("id"),
        zoom_of(F.col("zoom")).alias("zoom_or_none"),
    )


def shifted(keys: DataFrame, cols: int, rows: int) -> DataFrame:
    """Every key moved by an offset, at the same zoom."""
    return keys.select((F.col("col") + cols).alias("col"), (F.col("row") + rows).alias("row"), "zoom")


def neighbours(keys: DataFrame, mode: str = "plus") -> DataFrame:
    """The four (``plus``) or eight (``box``) neighbours of every key, without the key itself."""
    offsets = {"plus": PLUS, "box": BOX}[mode]
    around = F.array(
        *[F.struct((F.col("col") + dc).cast("int").alias("col"), (F.col("row") + dr).cast("int").alias("row")) for dc, dr in offsets]
    )
    others = [c for c in keys.columns if c not in ("col", "row")]
    return keys.select(
        F.col("col").alias("from_col"), F.col("row").alias("from_row"), *others, F.explode(around).alias("k")
    ).select("from_col", "from_row", "k.col", "k.row", *others)


FILLED, EMPTY = "■", "□"


def occupancy_picture(keys: DataFrame) -> DataFrame:
    """One text per grid row, filled where a key exists, with the smallest key as origin.

    Repeated keys are dropped first.  A row's text is built from its distinct columns, in
    order; the empty runs are written by length, so no full grid is ever made.
    """
    distinct = keys.select("col", "row").dropDuplicates()
    limits = distinct.agg(
        F.struct(
            F.min("col").alias("c0"), F.max("col").alias("c1"), F.min("row").alias("r0"), F.max("row").alias("r1")
        ).alias("b")
    )
    by_col = Window.partitionBy("row").orderBy("col")
    placed = distinct.withColumn("b", limits.scalar())
    gap = F.col("col") - F.coalesce(F.lag("col").over(by_col), F.col("b.c0") - 1) - 1
    runs = placed.select("row", "col", "b", F.concat(F.repeat(F.lit(EMPTY), gap), F.lit(FILLED)).alias("run"))
    filled = runs.groupBy("row", "b").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("col", "run"))), lambda x: x["run"]), "").alias("head"),
        F.max("col").alias("last"),
    )
    texts = filled.select(
        (F.col("row") - F.col("b.r0")).alias("row"),
        F.concat("head", F.repeat(F.lit(EMPTY), F.col("b.c1") - F.col("last"))).alias("picture"),
    )
    box = limits.first()["b"]
    count = 0 if box["r0"] is None else box["r1"] - box["r0"] + 1
    rows = keys.sparkSession.range(count).select(F.col("id").alias("row"))
    joined = rows.join(texts, "row", "left").withColumn("b", limits.scalar())
    blank = F.repeat(F.lit(EMPTY), F.col("b.c1") - F.col("b.c0") + 1)
    return joined.select("row", F.coalesce("picture", blank).alias("picture")).orderBy("row")

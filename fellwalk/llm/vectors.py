"""What the operators on vectors share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(vector: Column) -> Column:
    """Neither null, empty nor zero, and every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def usable_vectors(df: DataFrame, *more: str) -> DataFrame:
    """``vec_id``, ``dim`` and ``vector`` (doubles) of the rows that take part, with the columns ``more``."""
    rows = df.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.size("embedding").alias("dim"), F.col("embedding").cast("array<double>").alias("vector"), *more)


def matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column of equally long lists."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; scaled first, so that no square overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosines(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Cosines of unit vectors, each sum in the same order, so equal vectors have equal cosines."""
    return np.einsum("id,jd->ij", left, right, optimize=False)

"""The registered queries: a callable over (session, data folder) and the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from fellwalk.session import settle_session

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Job:
    run: Query
    sql: str | None


JOBS: dict[str, Job] = {}


def job(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with its SQL where SQL can express it."""

    def register(query: Query) -> Query:
        if name in JOBS:
            raise ValueError(f"query {name} is registered twice")
        JOBS[name] = Job(lambda spark, sf_dir: query(settle_session(spark), sf_dir), sql)
        return query

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles cut to ``digits`` places: the order of summation differs between engines."""
    return df.select(
        *[(F.round(c, digits) + F.lit(0.0)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )

"""Every registered query with SQL must agree with it on the smallest data set."""

import math
import pathlib

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry  # noqa: E402
from fellwalk.plans.catalog import JOBS  # noqa: E402

DATA = pathlib.Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="driver tables are not present")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return "NULL" if value is None else str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", [n for n, job in JOBS.items() if job.sql])
def test_query_agrees_with_sql(spark, oracle, name):
    result = JOBS[name].run(spark, str(DATA))
    found = oracle.execute(JOBS[name].sql)
    names = [c[0] for c in found.description]
    assert sorted(result.columns) == sorted(names)
    expected = _rows(names, found.fetchall())
    assert _rows(result.columns, result.collect()) == expected


def test_queries_without_sql_return_rows(spark):
    for name, job in JOBS.items():
        if not job.sql:
            assert job.run(spark, str(DATA)).count() > 0, name


def test_entry_points(spark):
    assert entry.entry(spark).count() == 20
    assert set(entry.oracle_sql()) <= set(entry.queries())

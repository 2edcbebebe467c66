"""The queries of the subpackage against their SQL on the smallest tables."""

import pathlib

import duckdb
import pytest
from test_oracles import _rows

from fellwalk.llm.queries import QUERIES, SQL

DATA = pathlib.Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="driver tables are not present")


@pytest.mark.parametrize("name", list(SQL))
def test_query_agrees_with_sql(spark, name):
    connection = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    result = QUERIES[name](spark, str(DATA))
    found = connection.execute(SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(result.columns) == sorted(names)
    assert _rows(result.columns, result.collect()) == _rows(names, found.fetchall())

"""Every query of the subpackage that has SQL, against it on the smallest test tables."""

import decimal

import duckdb
import pytest

from tillstar.llm.queries import QUERIES
from tillstar.llm.sql import SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def plain(value):
    return f"{value:.6f}" if isinstance(value, (float, decimal.Decimal)) else repr(value)


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, duck, name):
    cursor = duck.execute(SQL[name])
    header = [d[0] for d in cursor.description]
    expected = sorted(tuple(map(plain, row)) for row in cursor.fetchall())
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(header)
    assert sorted(tuple(map(plain, r)) for r in df.select(*header).collect()) == expected
    assert expected

"""Every registered query against its SQL in DuckDB on the smallest test tables."""

import datetime
import decimal

import duckdb
import pytest

import __spark_entry__ as entry_module
from tillstar.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
SQL = {name: sql for name, sql in entry_module.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    if isinstance(value, decimal.Decimal):
        return f"{value:.6f}"
    return repr(value)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark, duck):
    expected = duck.execute(f"select count(*) from ({SQL['fact_transactions']})").fetchone()[0]
    assert entry_module.entry(spark).count() == expected > 3137
    assert set(QUERIES) <= set(entry_module.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cursor = duck.execute(SQL[name])
    header = [d[0] for d in cursor.description]
    assert sorted(header) == columns
    expected = sorted(
        tuple(plain(row[header.index(c)]) for c in columns) for row in cursor.fetchall())
    found = sorted(tuple(map(plain, row)) for row in df.select(*columns).collect())
    assert found == expected
    if name not in ("top_store_for_product",):
        assert found

"""Every registered query against its SQL counterpart in DuckDB."""

import math

import duckdb
import pytest
from tables import DATA

from parley.plans.catalog import catalog
from parley.plans.oracles import oracles

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    values = [tuple(_value(r[i]) for i in order) for r in rows]
    return sorted(values, key=lambda r: [(v is None, str(type(v)), "" if v is None else v) for v in r])


def test_every_query_has_a_counterpart():
    assert set(oracles()) | ROWS_ONLY == set(catalog())


@pytest.mark.parametrize("name", sorted(oracles()))
def test_query_equals_sql(spark, duck, name):
    result = catalog()[name](spark, DATA)
    expected = duck.execute(oracles()[name])
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    want = _canonical(columns, expected.fetchall())
    got = _canonical(result.columns, [tuple(r) for r in result.collect()])
    assert got, "a query without rows checks nothing"
    assert got == want


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only_queries_give_rows(spark, name):
    result = catalog()[name](spark, DATA)
    assert result.count() == result.distinct().count() > 0


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).columns == [
        "channel_id", "channel_name", "user_id", "user_name", "ts",
    ]
    assert catalog().keys() <= contract.queries().keys()

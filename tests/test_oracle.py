"""Every registered query against its SQL, on the smallest test tables."""

import datetime
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as registry
from marquee.plans.oracle import SQL
from marquee.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        return round(float(value), 6)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=str)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(registry.queries()) and set(SQL) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = registry.queries()[name](spark, SF)
    expected = duck.sql(registry.oracle_sql()[name])
    columns = list(expected.columns)
    assert sorted(result.columns) == sorted(columns)
    assert rows_of(result.columns, result.collect()) == rows_of(columns, expected.fetchall())


def test_entry(spark):
    result = registry.entry(spark)
    assert result.columns == ["title", "vote_average", "vote_count"]
    rows = result.collect()
    assert len(rows) == 20
    assert [r.vote_average for r in rows] == sorted((r.vote_average for r in rows), reverse=True)

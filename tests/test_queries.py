"""Every registered query against its DuckDB check, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from wiremere.plans import oracles
from wiremere.plans import queries as registered

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES, ORACLES = registered.QUERIES, oracles.ORACLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    yield con
    con.close()


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() == 3


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_check(spark, duck, name):
    result = QUERIES[name](spark, SF)
    expected = duck.execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    got = comparable(result.columns, [tuple(r) for r in result.collect()])
    assert got == comparable(columns, expected.fetchall())
    assert got, "a query without rows checks nothing"

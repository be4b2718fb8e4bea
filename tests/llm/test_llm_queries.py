"""Registered queries against their DuckDB checks, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from wiremere.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    yield con
    con.close()


def test_registration():
    names = list(queries.QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(names) | {"pipeline"} <= set(contract.queries())
    assert set(queries.ORACLES) <= set(names)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_check(spark, duck, name):
    result = queries.QUERIES[name](spark, SF)
    expected = duck.execute(queries.ORACLES[name])
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in result.collect())
    assert got == sorted(map(repr, expected.fetchall()))
    assert got

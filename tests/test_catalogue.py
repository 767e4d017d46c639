"""Registered queries against their oracle, and the fixture against its known counts."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from catalogue import fixture, queries

SMALL = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def normal(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return [columns[i] for i in order], sorted((tuple(value(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query_matches_oracle(spark, oracle, name):
    df = contract.queries()[name](spark, SMALL)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    result = oracle.execute(contract.oracle_sql()[name])
    assert got == normal([d[0] for d in result.description], result.fetchall())


def test_every_query_has_an_oracle():
    assert set(queries.QUERIES) == set(queries.ORACLES)
    assert set(queries.QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert len(contract.entry(spark).columns) == 27


def test_fixture_counts(spark):
    tables = fixture.bronze(spark, "/root/testdata/sf0.01").tables()
    assert {n: df.count() for n, df in tables.items()} == {
        "geography": 75, "school": 1500, "pupil": 60000, "results": 58800, "claimcare": 59000,
    }

"""Every registered query against its SQL, on the smallest tables."""

import math
from pathlib import Path

import pytest

import __spark_entry__ as contract
from querybook.oracle import ORACLE
from querybook.queries import QUERIES

SF_DIR = Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6))
    return str(value)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, str(SF_DIR))
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    expected = sorted(tuple(plain(r[i]) for i in at) for r in cursor.fetchall())
    assert got == expected


def test_contract(spark):
    assert set(QUERIES) == set(ORACLE) <= set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0

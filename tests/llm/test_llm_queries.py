"""Queries that SQL can express, against their SQL; and the contract of the entry."""

import pytest

import __spark_entry__ as contract
from listingloom.llm.queries import ORACLE, QUERIES


def plain(value):
    return repr(round(value, 6)) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in cursor.fetchall())


def test_every_operator_is_registered():
    names = contract.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1

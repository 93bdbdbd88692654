from __future__ import annotations

from pathlib import Path

import pytest

SF_DIR = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    if not SF_DIR.exists():
        pytest.skip("no test tables")
    return str(SF_DIR)


@pytest.fixture(scope="session")
def duck(sf_dir):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in "documents embeddings pages benchmark labels conversations".split():
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


@pytest.fixture(scope="session")
def documents(spark):
    """A frame of (doc_id, text[, lang[, source]]) rows."""

    def make(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema)

    return make

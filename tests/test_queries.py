"""Every query against its SQL in DuckDB, on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))
import __spark_entry__ as entry
from check_sql import TABLES, compare

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, db, name):
    said, _ = compare(spark, db, name, SF_DIR)
    assert said.startswith(("same", "rows")), said


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_sql_only_for_known_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())

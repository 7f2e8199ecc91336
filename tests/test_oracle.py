"""Every registered query against its SQL, run by DuckDB on the same tables."""

import datetime
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import ORACLE, QUERIES, entry

SF_DIR = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="test tables missing")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        connection.execute(
            f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')"
        )
    return connection


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, str(SF_DIR))
    expected = duck.execute(ORACLE[name])
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    rows = expected.fetchall()
    assert rows
    assert bag(result.columns, result.collect()) == bag(columns, rows)


def test_entry(spark):
    assert entry(spark).count() > 0

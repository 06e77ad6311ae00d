"""Every registered query against its SQL in DuckDB, on the smallest data set."""

import datetime
import math
import os

import duckdb
import pytest
import __spark_entry__ as entry_point
from tidemark.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not present")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in sorted(os.listdir(SF_DIR)):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{name}')")
    return connection


def normal(value):
    if isinstance(value, float):
        return "NULL" if math.isnan(value) else repr(round(value, 6))
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return "NULL" if value is None else str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(normal(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(set(entry_point.queries()) & set(QUERIES)))
def test_query(spark, oracle, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    relation = oracle.execute(entry_point.oracle_sql()[name])
    expected = table([c[0] for c in relation.description], relation.fetchall())
    assert table(df.columns, df.collect()) == expected
    assert expected[1]


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)

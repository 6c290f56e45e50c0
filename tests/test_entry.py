"""Registered queries on the smallest tables, against their SQL where they have any."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as registered

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return connection


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float)):
        return (2, round(float(value), 5))
    return (3, str(value))


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query(spark, duck, name):
    df = registered.queries()[name](spark, SF_DIR)
    rows = df.collect()
    sql = registered.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    result = duck.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert table(df.columns, [tuple(r) for r in rows]) == table(columns, result.fetchall())


def test_sql_belongs_to_queries():
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_entry(spark):
    assert registered.entry(spark).count() > 0

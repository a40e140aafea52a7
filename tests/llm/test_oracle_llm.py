"""Registered queries that SQL can express, values and column types."""

import os

import duckdb
import pytest

from tagloom.llm.queries import ORACLE_SQL, QUERIES

TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string"}


@pytest.fixture(scope="module")
def oracle(sf_dir):
    connection = duckdb.connect()
    for file in os.listdir(sf_dir):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS FROM '{sf_dir}/{file}'")
    return connection


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, oracle, sf_dir, key):
    want = oracle.sql(ORACLE_SQL[key])
    columns = sorted(want.columns)
    got = QUERIES[key](spark, sf_dir)
    assert sorted(got.columns) == columns
    types = dict(zip(want.columns, (TYPES[str(t)] for t in want.types)))
    assert {f.name: f.dataType.simpleString() for f in got.schema} == types
    quoted = ", ".join(f'"{c}"' for c in columns)
    rows = oracle.sql(f"SELECT {quoted} FROM ({ORACLE_SQL[key]})").fetchall()
    assert rows and sorted(map(tuple, got.select(*columns).collect())) == sorted(rows)

"""Every registered query against its SQL in DuckDB, values and column types."""

import os

import duckdb
import pytest

import __spark_entry__ as registered
from tagloom.plans.oracle import ORACLE_SQL as SQL
from tagloom.plans.queries import QUERIES

TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


@pytest.fixture(scope="module")
def oracle(sf_dir):
    connection = duckdb.connect()
    for file in os.listdir(sf_dir):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{file}'")
    return connection


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_sql(spark, oracle, sf_dir, key):
    assert key in SQL
    expected = oracle.sql(SQL[key])
    got = QUERIES[key](spark, sf_dir)
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)
    types = dict(zip(expected.columns, (TYPES[str(t)] for t in expected.types)))
    assert {f.name: f.dataType.simpleString() for f in got.schema} == types
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = oracle.sql(f"SELECT {quoted} FROM ({SQL[key]})").fetchall()
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(want, key=repr)
    assert want


def test_entry(spark):
    assert registered.entry(spark).count() > 0

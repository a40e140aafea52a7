"""Places from the totals of a grid against a plain window."""

import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import tagloom as tl
from tagloom.operators import grid

from conftest import rows
from test_plans import exchanges, plan


def places(df, order):
    return df.withColumn("position", F.row_number().over(Window.orderBy(*order)).cast("long"))


@pytest.mark.parametrize("cell_rows", [1, 7, 100, 10_000])
def test_any_cell_size_gives_the_same_places(spark, sf_dir, cell_rows):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("ts", "event_id")
    for order in (["ts", "event_id"], ["event_id"]):
        got = grid.grid_position(events, order, cell_rows=cell_rows)
        assert rows(got) == rows(places(events, order))


@pytest.mark.parametrize("cell_rows", [5, 50])
def test_crowded_cells_are_cut_again(spark, cell_rows):
    """A third of all rows at one moment, another third within a second, far outliers, NULLs."""
    first = datetime.datetime(2024, 1, 1)
    data = [(first, i) for i in range(200)]
    data += [(first + datetime.timedelta(days=9, microseconds=7 * i), -i) for i in range(200)]
    data += [(first + datetime.timedelta(days=40 * i), i) for i in range(100)]
    data += [(None, i) for i in range(60)] + [(None, None), (first, None)]
    data += [(first, 2**63 - 1), (first, -(2**63))]
    df = spark.createDataFrame(data, "ts timestamp_ntz, n bigint")
    order = ["ts", "n"]
    assert rows(grid.grid_position(df, order, cell_rows=cell_rows)) == rows(places(df, order))


def test_equal_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 1)] * 50 + [(2, 0)], "a int, b int")
    got = grid.grid_position(df, ["a", "b"], cell_rows=3)
    assert sorted(r.position for r in got.collect()) == list(range(1, 52))
    assert got.where("a = 2").first().position == 51
    assert grid.grid_position(df.limit(0), ["a"]).count() == 0


def test_one_shuffle_and_no_copy(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("ts", "event_id")
    text = plan(tl.running_counter_global(events, ["ts", "event_id"], hot_rows=100))
    assert exchanges(text) == 1
    assert text.count("Scan parquet") == 2 and "ordered-" not in text  # the tree and its entry


def test_other_types_go_by_ranges(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("c", 3)], "k string, n int")
    assert not grid.has_grid(df, ["k"])
    got = tl.running_counter_global(df, ["k"])
    assert sorted((r.k, r.running_count) for r in got.collect()) == [("a", 1), ("b", 2), ("c", 3)]

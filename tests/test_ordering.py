"""Positions and hot keys against a plain Python count."""

import itertools

import pytest
from pyspark.sql import functions as F

from tagloom.operators.ordering import hot_keys, ordered_splits, running_position

from conftest import rows

# A hot key with a third of all rows, a burst at one instant, a NULL key, small keys.
EVENTS = (
    [("hot", i // 7, i) for i in range(400)]
    + [("burst", 5, 500 + i) for i in range(300)]
    + [(None, i % 3, 1000 + i) for i in range(200)]
    + [(f"k{i % 50}", i % 11, 2000 + i) for i in range(300)]
)


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(EVENTS, "key string, ts int, id long").repartition(5)


def expected(by_key):
    group = (lambda e: repr(e[0])) if by_key else (lambda e: "")
    found = []
    in_order = sorted(EVENTS, key=lambda e: (group(e), e[1], e[2]))
    for _, members in itertools.groupby(in_order, group):
        found += [(*e, place) for place, e in enumerate(members, 1)]
    return sorted(found, key=repr)


@pytest.mark.parametrize("hot_rows", [10_000, 250, 60])
def test_position_per_key(events, hot_rows):
    got = running_position(events, ["key"], ["ts", "id"], hot_rows=hot_rows)
    assert rows(got, "key", "ts", "id", "position") == expected(by_key=True)


@pytest.mark.parametrize("hot_rows", [10_000, 100])
def test_position_over_all(events, hot_rows):
    got = running_position(events, [], ["ts", "id"], hot_rows=hot_rows)
    assert rows(got, "key", "ts", "id", "position") == expected(by_key=False)


def test_both_ways_give_the_same_schema(events):
    plain = running_position(events, ["key"], ["ts", "id"])
    split = running_position(events, ["key"], ["ts", "id"], hot_rows=60)
    assert plain.schema.simpleString() == split.schema.simpleString()


def test_hot_keys_hold_more_than_the_limit(events):
    assert {(r["key"], r["n"]) for r in hot_keys(events, ["key"], 150)} == {
        ("hot", 400),
        ("burst", 300),
        (None, 200),
    }
    assert hot_keys(events, ["key"], 400) == []
    assert hot_keys(events.limit(0), ["key"], 1) == []


def test_a_hot_key_is_cut_into_even_splits(events):
    burst = events.where("key = 'burst'")
    hot = hot_keys(burst, ["key"], 10)
    sizes = ordered_splits(burst, ["key"], ["ts", "id"], hot, 200).groupBy("_split").count()
    assert sizes.agg(F.sum("count")).first()[0] == 300
    assert sizes.agg(F.max("count")).first()[0] <= 100

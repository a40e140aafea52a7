import datetime as dt

import pytest
from pyspark.sql import functions as F

import tagloom as tl
from tagloom.sources import driver_tables

from conftest import rows

T0 = dt.datetime(2025, 1, 1)
ORDER = ["ts", "event_id"]


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(
        [(1, T0, 12), (1, T0, 11), (1, T0 - dt.timedelta(1), 13), (7, T0, 14)],
        "key long, ts timestamp_ntz, event_id long",
    )


@pytest.fixture(scope="module")
def keys(spark):
    return spark.createDataFrame([(1,), (2,), (7,)], "key long")


def test_counts_with_zero(keys, events):
    counts = tl.double_counter(tl.event_counter(keys, events, "key"))
    assert rows(counts, "key", "count", "double_count") == [(1, 3, 6), (2, 0, 0), (7, 1, 2)]


def test_running_counts(events):
    assert rows(tl.running_counter(events, "key", ORDER), "event_id", "running_count") == [
        (11, 2),
        (12, 3),
        (13, 1),
        (14, 1),
    ]
    assert rows(tl.running_counter_global(events, ORDER), "event_id", "running_count") == [
        (11, 2),
        (12, 3),
        (13, 1),
        (14, 4),
    ]


def test_replayed_events_count_once(keys, events):
    twice = tl.once_per_event(events.unionByName(events), ["event_id"])
    assert rows(tl.event_counter(keys, twice, "key")) == rows(
        tl.event_counter(keys, events, "key")
    )


@pytest.mark.parametrize("hot_rows", [1_000_000, 75])
def test_final_running_count_is_the_count(spark, sf_dir, hot_rows):
    events = driver_tables.table(spark, sf_dir, "events").select("user_id", *ORDER)
    running = tl.running_counter(events, "user_id", ORDER, hot_rows)
    top = running.groupBy("user_id").agg(F.max("running_count").alias("count"))
    assert rows(top) == rows(tl.event_counts(events, "user_id"))
    whole = tl.running_counter_global(events, ORDER, hot_rows)
    assert {r[0] for r in rows(whole, "running_count")} == set(range(1, 1001))


def test_json_property(spark):
    given = spark.createDataFrame(
        [
            (1, '{"msg":"Hello World"}'),
            (2, '{"msg":""}'),
            (3, '{"msg":69}'),
            (4, '{"msg":null}'),
            (5, "{}"),
            (6, "not json"),
            (7, None),
            (8, '{"msg":["a"]}'),
            (9, '{"msg":true}'),
            (10, '{"x":1,"x":2,"msg":"b"}'),
            (11, '{"msg":1,"msg":"b"}'),
            (12, '{"msg":"b","msg":1}'),
            (13, '["msg"]'),
            (14, '[{"msg":"x"}]'),
            (15, '{"msg":"a","y":}'),
            (16, "{'msg':'a'}"),
            (17, '{"msg":{"a":1,"a":2}}'),
            (18, '{"msg":"{not an object}"}'),
        ],
        "id long, j string",
    )
    found = rows(tl.json_prop_violations(given, "j", "msg", ["id"]), "id", "violation")
    assert sorted(found) == [
        (3, "wrong_type"),
        (4, "wrong_type"),
        (5, "missing"),
        (6, "missing"),
        (7, "missing"),
        (8, "wrong_type"),
        (9, "wrong_type"),
        (12, "wrong_type"),
        (13, "missing"),
        (14, "missing"),
        (15, "missing"),
        (16, "missing"),
        (17, "wrong_type"),
    ]


@pytest.mark.parametrize("first", ["x", "[", "{"])
def test_json_text_beyond_a_variant(spark, first):
    text = F.concat(F.lit('{"msg":"' + first), F.repeat(F.lit("x"), 140_000_000), F.lit('"}'))
    given = spark.range(1).select("id", text.alias("j"))
    assert tl.json_prop_violations(given, "j", "msg", ["id"]).count() == 0


def test_json_property_names_are_literal(spark):
    given = spark.createDataFrame(
        [(1, '{"a.b c":"x"}'), (2, '{"a":{"b c":"x"}}')], "id long, j string"
    )
    assert rows(tl.json_prop_violations(given, "j", "a.b c", ["id"])) == [(2, "missing")]


def test_column_property(spark):
    texts = spark.createDataFrame([(1, "x"), (2, ""), (3, None)], "id long, msg string")
    assert rows(tl.prop_violations(texts, "msg", ["id"])) == [(3, "missing")]
    numbers = spark.createDataFrame([(1, 5), (3, None)], "id long, msg long")
    assert rows(tl.prop_violations(numbers, "msg", ["id"]), "id", "violation") == [
        (1, "wrong_type"),
        (3, "missing"),
    ]


def test_text_contains_is_literal_and_case_sensitive(spark):
    given = spark.createDataFrame(
        [(1, "Hello World"), (2, "hello world"), (3, "Hello"), (4, None), (5, "a.c%_")],
        "id long, msg string",
    )
    assert rows(tl.text_contains(given, "msg", "Hello World"), "id") == [(1,)]
    assert rows(tl.text_contains(given, "msg", ".c%_"), "id") == [(5,)]
    assert len(rows(tl.text_contains(given, "msg", ""), "id")) == 4


def test_properties_that_no_variant_holds(spark):
    """Repeated properties, text and lists beyond the variant's size, text that is no object."""
    big = "y" * 20_000_000
    given = [
        ('{"msg":"x"}', None),
        ('{"msg":1,"msg":"x"}', None),
        ('{"msg":"x","msg":1}', "wrong_type"),
        ('{"msg":{"a":1,"a":2}}', "wrong_type"),
        ('{"msg":[1,{"b":1,"b":2}]}', "wrong_type"),
        ('{"msg":"%s"}' % big, None),
        ('{"msg":"{%s"}' % big, None),
        ('{"msg":["%s"]}' % big, "wrong_type"),
        ('{"msg":"a","z":{"q":1,"q":2}}', None),
        ('{"msg":"a" oops', "missing"),
        ("{'msg':'a'}", "missing"),
        ("", "missing"),
        (None, "missing"),
        ("[1]", "missing"),
        ('{"_corrupt":"x"}', "missing"),
    ]
    df = spark.createDataFrame([(i, j) for i, (j, _) in enumerate(given)], "id int, j string")
    got = {r.id: r.violation for r in tl.json_prop_violations(df, "j", "msg", ["id"]).collect()}
    assert got == {i: v for i, (_, v) in enumerate(given) if v}

"""Duplicates over parts: only items that come in several parts are shuffled."""

import pytest
from pyspark.sql import functions as F

import tagloom as tl
from tagloom.operators import quality, sketch

from conftest import rows

LISTS = ("accounts", "units", "drivers", "areas")


def long_records(spark, records, items, every):
    """Records whose units are all different, but for one of `every` that comes again."""
    unit = F.transform(
        F.sequence(F.lit(0), F.lit(items - 1)),
        lambda i: F.when(i % every == every - 1, F.lit("again")).otherwise(i.cast("string")),
    )
    return spark.range(records).select(
        F.col("id").alias("tag_id"),
        F.lit("name").alias("tag_name"),
        F.lit("2025").alias("created_date"),
        *((unit if c == "units" else F.array().cast("array<string>")).alias(c) for c in LISTS),
    )


@pytest.mark.parametrize("bits", [sketch.BITS, 32768])
@pytest.mark.parametrize("part_items", [1, 3, 64, 1000])
def test_parts_give_the_duplicates_of_whole_lists(spark, monkeypatch, part_items, bits):
    monkeypatch.setattr(sketch.in_several_parts, "__defaults__", (bits,))
    monkeypatch.setattr(sketch.passing, "__defaults__", (bits,))
    whole = long_records(spark, 5, 300, 70)
    parts = tl.split_records(whole, part_items)
    assert rows(tl.duplicate_chip_keys(parts)) == rows(tl.duplicate_chip_keys(whole))
    assert tl.duplicate_chip_keys(parts).first().first_pos == 69


def test_lone_items_are_not_shuffled(spark):
    parts = tl.split_records(long_records(spark, 20, 2000, 500), 50).cache()
    sections = tl.tag_sections(parts).withColumn("goes_on", F.col("parts") > 1)
    counts = quality._item_counts(sections, "tag_id")
    assert counts.count() > 39_000
    left = quality._without_lone_items(parts, counts, "tag_id").count()
    assert 80 <= left <= 80 + 0.05 * 39_000  # four of each list, and few that share a bit
    parts.unpersist()


def test_null_items_and_parts_that_hold_one_twice(spark):
    schema = "tag_id bigint, part int, parts int, first_item bigint, tag_name string, created_date string, " + ", ".join(
        f"{c} array<string>" for c in LISTS
    )
    given = [
        (1, 0, 3, 0, "n", "d", ["a"], ["x", None], [], None),
        (1, 1, 3, 2, None, None, [], ["y", "y"], [], []),
        (1, 2, 3, 4, None, None, [], [None, "x"], [], []),
        (2, 0, 1, 0, "n", "d", ["a"], ["x"], ["b", "b"], []),
    ]
    got = tl.duplicate_chip_keys(spark.createDataFrame(given, schema))
    assert rows(got, "tag_id", "label", "item", "n", "first_pos") == [
        (1, "Units", "x", 2, 0),
        (1, "Units", "y", 2, 2),
        (1, "Units", None, 2, 1),
        (2, "Drivers", "b", 2, 0),
    ]


@pytest.mark.parametrize("part_items", [1, 3, 64])
def test_a_filter_that_would_fill_up_is_not_built(spark, monkeypatch, part_items):
    def filled(*_):
        raise AssertionError("the filter passes nearly all of these items")

    whole = long_records(spark, 5, 300, 70)
    parts = tl.split_records(whole, part_items).unionByName(
        tl.split_records(long_records(spark, 3, 20, 5).withColumn("tag_id", F.col("tag_id") + 9))
    )
    expected = rows(tl.duplicate_chip_keys(parts))
    monkeypatch.setattr(quality, "in_several_parts", filled)
    monkeypatch.setattr(quality, "FEW_ITEMS", 1000, raising=False)
    assert rows(tl.duplicate_chip_keys(parts)) == expected
    assert {r.tag_id for r in tl.duplicate_chip_keys(parts).collect()} == {*range(5), 9, 10, 11}

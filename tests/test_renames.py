import datetime as dt

import pytest
from pyspark.sql import functions as F

import tagloom as tl
from tagloom.schema import COMMAND_SCHEMA, TAG_SCHEMA
from tagloom.sources import driver_tables

from conftest import rows

T0 = dt.datetime(2025, 1, 1)
NAMES = [None, "", "Ali Tag", " ", "0", "Beta", None]


def make_commands(spark, given):
    return spark.createDataFrame(given, COMMAND_SCHEMA)


@pytest.fixture(scope="module")
def edits(spark):
    # All at one instant: seq alone decides. Handed over backwards.
    return make_commands(spark, [(1, T0, i, n) for i, n in reversed(list(enumerate(NAMES, 1)))])


def make_tags(spark, names):
    return spark.createDataFrame(
        [(i, 0, 1, 0, name, "d", [], [], [], []) for i, name in names], TAG_SCHEMA
    )


def test_only_null_and_empty_names_are_refused(edits):
    assert rows(tl.accepted_renames(edits), "seq", "new_name") == [
        (3, "Ali Tag"),
        (4, " "),
        (5, "0"),
        (6, "Beta"),
    ]


@pytest.mark.parametrize("hot_rows", [1_000_000, 2])
def test_golden_audit(spark, edits, hot_rows):
    audit = tl.rename_audit(tl.golden_tags(spark), edits, hot_rows)
    assert rows(audit, "seq", "new_name", "name_shown", "accepted", "name_after") == [
        (1, None, "Ali Tag", False, "Ali Tag"),
        (2, "", "Ali Tag", False, "Ali Tag"),
        (3, "Ali Tag", "Ali Tag", True, "Ali Tag"),
        (4, " ", "Ali Tag", True, " "),
        (5, "0", " ", True, "0"),
        (6, "Beta", "0", True, "Beta"),
        (7, None, "Beta", False, "Beta"),
    ]


def test_current_name_and_untouched_fields(spark, edits):
    golden = tl.golden_tags(spark)
    current = tl.current_tags(golden, edits)
    assert current.columns == golden.columns
    assert current.first()["tag_name"] == "Beta"
    assert rows(current.drop("tag_name")) == rows(golden.drop("tag_name"))


def test_tags_without_accepted_edits_keep_their_name(spark):
    tags = make_tags(spark, [(1, "one"), (2, "two"), (3, None)])
    commands = make_commands(spark, [(1, T0, 1, ""), (1, T0, 2, None), (9, T0, 3, "nobody")])
    assert rows(tl.current_tags(tags, commands), "tag_id", "tag_name") == [
        (1, "one"),
        (2, "two"),
        (3, None),
    ]
    assert rows(tl.unknown_tag_commands(tags, commands), "tag_id", "seq") == [(9, 3)]
    assert rows(tl.rename_audit(tags, commands), "tag_id", "seq", "name_after") == [
        (1, 1, "one"),
        (1, 2, "one"),
    ]


def test_a_name_reaches_part_0_and_every_view(spark, edits):
    golden = tl.golden_tags(spark)
    more = golden.withColumns({"part": F.lit(1), "tag_name": F.lit(None).cast("string")})
    current = tl.current_tags(golden.unionByName(more), edits)
    assert rows(current, "part", "tag_name") == [(0, "Beta"), (1, None)]
    views = tl.current_tag_outputs(golden, edits)
    assert views["titles"].first()["tag_name"] == "Beta"
    assert rows(views["fields"], "label", "value") == [
        ("Created Date", "2025-10-15 17:44:32"),
        ("Tag Name", "Beta"),
    ]
    assert rows(views["sections"]) == rows(tl.tag_sections(golden))


@pytest.mark.parametrize("hot_rows", [100, 30])
def test_hot_tags_are_audited_alike(spark, sf_dir, hot_rows):
    tags = driver_tables.tag_heads(spark, sf_dir)
    commands = driver_tables.commands(driver_tables.table(spark, sf_dir, "events"))
    # One tag with about a third of all commands.
    skewed = commands.withColumn(
        "tag_id", F.when(F.col("seq") % 3 == 0, F.lit(5)).otherwise(F.col("tag_id"))
    )
    plain = tl.rename_audit(tags, skewed)
    split = tl.rename_audit(tags, skewed, hot_rows)
    assert plain.schema.simpleString() == split.schema.simpleString()
    assert rows(split) == rows(plain)


def test_long_quiet_stretch_carries_the_name_across_splits(spark):
    tags = make_tags(spark, [(1, "first")])
    quiet = [(1, T0 + dt.timedelta(seconds=i), i, None) for i in range(2, 400)]
    commands = make_commands(spark, [(1, T0, 1, "kept"), *quiet]).repartition(6)
    audit = tl.rename_audit(tags, commands, hot_rows=20)
    assert audit.count() == 399
    assert rows(audit.groupBy("name_shown").count(), "name_shown", "count") == [
        ("first", 1),
        ("kept", 398),
    ]


def test_last_name_after_is_the_current_name(spark, sf_dir):
    tags = driver_tables.tag_heads(spark, sf_dir)
    commands = driver_tables.commands(driver_tables.table(spark, sf_dir, "events"))
    last = (
        tl.rename_audit(tags, commands)
        .groupBy("tag_id")
        .agg(F.max_by("name_after", F.struct("ts", "seq")).alias("tag_name"))
    )
    current = tl.current_tags(tags, commands).join(last.select("tag_id"), "tag_id", "left_semi")
    assert rows(last) == rows(current, "tag_id", "tag_name")


@pytest.mark.parametrize("hot_rows", [1_000_000, 100])
def test_other_key_and_order_columns(spark, sf_dir, hot_rows):
    tags = driver_tables.tags(spark, sf_dir).cache()
    commands = driver_tables.commands(driver_tables.table(spark, sf_dir, "events"))
    renamed = {"tag_id": "id", "ts": "at", "seq": "no"}
    other_tags, other_commands = (
        df.withColumnsRenamed(renamed) for df in (tags, commands)
    )
    order = ["at", "no"]

    def same(got, expected):
        assert rows(got) == rows(expected.withColumnsRenamed(renamed))

    same(
        tl.rename_audit(other_tags, other_commands, hot_rows, key="id", order=order),
        tl.rename_audit(tags, commands),
    )
    views = tl.current_tag_outputs(other_tags, other_commands, "id", order)
    for view, expected in tl.current_tag_outputs(tags, commands).items():
        same(views[view], expected)
    for operator in (
        tl.tag_lines,
        tl.duplicate_chip_keys,
        tl.duplicate_chip_keys_per_row,
    ):
        same(operator(other_tags, key="id"), operator(tags))
    same(
        tl.unknown_tag_commands(other_tags.limit(3), other_commands, "id"),
        tl.unknown_tag_commands(tags.limit(3), commands),
    )
    tags.unpersist()

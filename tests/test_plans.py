"""What a query must not do at scale: read unused columns, run Python, shuffle twice."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

import tagloom as tl
from tagloom.operators import ordering
from tagloom.plans.queries import QUERIES
from tagloom.sources import bucketed as bucketed_source
from tagloom.sources import driver_tables


def plan(df):
    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        df.explain("formatted")
    return printed.getvalue()


def exchanges(text):
    """Shuffles in the plan tree."""
    return sum(" Exchange (" in line for line in text.splitlines())


@pytest.fixture
def unbounded(spark):
    """Plans as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "tags")
    driver_tables.tags(spark, sf_dir).write.parquet(path)
    return path


@pytest.mark.parametrize("key", [k for k in QUERIES if not k.endswith("_stream")])
def test_no_python_and_no_cross_join(unbounded, sf_dir, key):
    text = plan(QUERIES[key](unbounded, sf_dir))
    for operator in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def test_record_operators_do_not_shuffle(spark, stored):
    tags = tl.read_tags(spark, stored)
    for operator in (
        tl.tag_titles,
        tl.tag_fields,
        tl.tag_sections,
        tl.tag_chips,
        tl.tag_cards,
        tl.tag_lines,
        tl.duplicate_chip_keys_per_row,
    ):
        assert exchanges(plan(operator(tags))) == 0


def test_scans_read_what_is_shown(spark, stored):
    tags = tl.read_tags(spark, stored)
    assert "ReadSchema: struct<tag_id:bigint,part:int,tag_name:string>" in plan(
        tl.tag_titles(tags)
    )
    assert "ReadSchema: struct<tag_id:bigint,part:int,first_item:bigint,areas:array<string>>" in plan(
        tl.tag_chips(tags, ["Areas"])
    )
    assert "EqualTo(tag_id,5)" in plan(tl.tag_chips(tags).where("tag_id = 5"))


def test_titles_and_fields_of_the_tables_scan_orders_only(spark, sf_dir):
    for key in ("tag_titles", "tag_fields"):
        text = plan(QUERIES[key](spark, sf_dir))
        assert text.count("ReadSchema") == 1 and "lineitem" not in text


def test_lists_move_lines_once(unbounded, sf_dir):
    """Numbering, collecting and the join with the orders share the lines' partitioning."""
    text = plan(driver_tables.tags(unbounded, sf_dir))
    # part and supplier names (2 x 2), lines by order, and the orders' side:
    # region, nation, customer (3 x 2), orders by tag.
    assert exchanges(text) == 2 * 2 + 1 + 3 * 2 + 1


def test_current_tags_move_no_record_again(unbounded, sf_dir):
    commands = driver_tables.commands(driver_tables.table(unbounded, sf_dir, "events"))
    tags = driver_tables.tags(unbounded, sf_dir)
    names = tl.latest_names(commands)
    moved = exchanges(plan(tl.with_names(tags, names)))
    assert moved == exchanges(plan(tags)) + exchanges(plan(names)) <= 13


def test_no_key_is_counted_when_no_bucket_is_crowded(spark, sf_dir):
    lines = driver_tables.table(spark, sf_dir, "lineitem")
    grouped = []
    real = type(lines).groupBy
    type(lines).groupBy = lambda self, *c: grouped.append(c) or real(self, *c)
    try:
        assert ordering.hot_keys(lines, ["l_orderkey"], 100) == []
    finally:
        type(lines).groupBy = real
    assert [str(c) for c in grouped] != [str(("l_orderkey",))] and len(grouped) == 1


@pytest.fixture(scope="module")
def bucketed(spark, sf_dir, tmp_path_factory):
    """Tags, names and commands, each in 16 buckets of its tag."""
    commands = driver_tables.commands(driver_tables.table(spark, sf_dir, "events"))
    tables = {
        "plan_tags": driver_tables.tags(spark, sf_dir, 3),
        "plan_names": tl.latest_names(commands),
        "plan_commands": commands,
    }
    for name, rows in tables.items():
        tl.write_bucketed(rows, name, str(tmp_path_factory.mktemp("tables") / name), 16)
    yield [tl.read_bucketed(spark, name) for name in tables]
    for name in tables:
        spark.sql(f"DROP TABLE {name}")


def test_tables_in_the_same_buckets_are_joined_without_a_shuffle(unbounded, bucketed):
    tags, names, commands = bucketed
    assert exchanges(plan(tl.with_names(tags, names))) == 0
    assert exchanges(plan(tl.rename_audit(tags, commands))) == 0


def test_a_batch_opens_the_buckets_of_its_own_tags(unbounded, bucketed):
    tags, names, _ = bucketed
    few = names.where("tag_id in (3, 7)").select("tag_id")
    found = bucketed_source.only_keys(tags, few)
    text = plan(tl.with_names(found, bucketed_source.only_keys(names, few)))
    assert exchanges(text) == 0
    chosen = re.findall(r"SelectedBucketsCount: (\d+) out of 16", text)
    assert len(chosen) == 2 and all(int(n) <= 2 for n in chosen)
    assert bucketed_source.only_keys(tags, few, few=1) is tags
    keys = {r.tag_id for r in found.select("tag_id").distinct().collect()}
    assert keys == {r.tag_id for r in few.collect()}


def test_counts_are_combined_before_the_shuffle(unbounded, sf_dir):
    text = plan(QUERIES["event_counter"](unbounded, sf_dir))
    assert "partial_count" in text and exchanges(text) == 2


def test_latest_names_are_combined_before_the_shuffle(unbounded, sf_dir):
    commands = driver_tables.commands(driver_tables.table(unbounded, sf_dir, "events"))
    text = plan(tl.latest_names(commands))
    assert "partial_max_by" in text and exchanges(text) == 1


def test_audit_moves_each_side_once(unbounded, sf_dir):
    assert exchanges(plan(QUERIES["rename_audit"](unbounded, sf_dir))) == 2


def test_running_counts_shuffle_once(unbounded, sf_dir):
    assert exchanges(plan(QUERIES["running_counter"](unbounded, sf_dir))) == 1


def test_split_positions_need_no_shuffle_after_the_ranges(unbounded, sf_dir):
    events = driver_tables.table(unbounded, sf_dir, "events").select("ts", "event_id")
    text = plan(ordering.running_position(events, [], ["ts", "event_id"], hot_rows=100))
    # Only the carry table, one row per split, is shuffled: to count and to add up.
    assert exchanges(text) == 2 and "BroadcastHashJoin" in text


def test_renames_spread_the_parts_of_a_record(unbounded, tmp_path):
    """A third of all rows are parts of one record; its shuffle partition is read by many tasks."""
    spark = unbounded
    golden = tl.golden_tags(spark)
    tags = golden.crossJoin(spark.range(3000)).withColumn(
        "tag_id", F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id"))
    )
    part = F.when(F.col("tag_id") == 1, F.col("id")).otherwise(0).cast("int")
    tags = tags.withColumn("part", part).drop("id").repartition(8)
    tags.write.parquet(f"{tmp_path}/tags")
    commands = spark.range(3000).selectExpr("id as tag_id", "id as ts", "id as seq", "'x' as new_name")
    small = {
        "skewJoin.skewedPartitionFactor": "1.2",
        "skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "advisoryPartitionSizeInBytes": "10KB",
    }
    for name, value in small.items():
        spark.conf.set(f"spark.sql.adaptive.{name}", value)
    named = tl.current_tags(spark.read.parquet(f"{tmp_path}/tags"), commands)
    named.collect()
    for name in small:
        spark.conf.unset(f"spark.sql.adaptive.{name}")
    assert "skew=true" in plan(named) and exchanges(plan(named)) >= 2


def test_bucketed_records_stay_where_they_are(unbounded, stored, sf_dir):
    spark = unbounded
    tags = tl.read_tags(spark, stored)
    tags.write.mode("overwrite").option("path", f"{stored}-bucketed").bucketBy(
        4, "tag_id"
    ).saveAsTable("tags_bucketed")
    commands = driver_tables.commands(driver_tables.table(spark, sf_dir, "events"))
    bucketed = spark.table("tags_bucketed")
    moved = exchanges(plan(tl.current_tags(bucketed, commands)))
    assert moved == exchanges(plan(tl.current_tags(tags, commands))) - 1
    spark.sql("DROP TABLE tags_bucketed")


def test_required_text_is_looked_for_in_the_scan(spark, sf_dir):
    turns = driver_tables.table(spark, sf_dir, "conversations")
    text = plan(tl.prop_violations(turns, "text", ["conv_id", "turn"]))
    assert "PushedFilters: [IsNull(text)]" in text


def test_text_match_is_pushed_to_the_scan(spark, sf_dir):
    assert "StringContains(text,the)" in plan(QUERIES["text_contains"](spark, sf_dir))


def test_a_hot_part_is_split_at_the_join(unbounded, sf_dir, tmp_path):
    """A third of all lines name one part; its shuffle partition is read by many tasks."""
    spark = unbounded
    for name in ("part", "supplier"):
        driver_tables.table(spark, sf_dir, name).write.parquet(f"{tmp_path}/{name}.parquet")
    lines = driver_tables.table(spark, sf_dir, "lineitem")
    hot_part = F.when(F.col("l_suppkey") % 3 == 0, F.lit(5)).otherwise(F.col("l_partkey"))
    lines = lines.withColumn("l_partkey", hot_part.cast("long")).repartition(8)
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    small = {
        "skewJoin.skewedPartitionFactor": "1.2",
        "skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "advisoryPartitionSizeInBytes": "10KB",
    }
    for name, value in small.items():
        spark.conf.set(f"spark.sql.adaptive.{name}", value)
    stored = spark.read.parquet(f"{tmp_path}/lineitem.parquet")
    named = driver_tables.named_lines(spark, str(tmp_path), stored)
    named.collect()
    for name in small:
        spark.conf.unset(f"spark.sql.adaptive.{name}")
    assert "skew=true" in plan(named)


def test_json_is_parsed_once(spark, sf_dir):
    found = QUERIES["prop_violations_json"](spark, sf_dir)
    optimized = found._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"from_json\([^\n]*?, props#", optimized)) == 1
    # what a variant cannot hold is looked at again, from the text that the parse left over
    assert "Filter" not in optimized

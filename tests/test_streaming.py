"""Streams against the batch operators, on input that arrives in time order."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

import tagloom as tl
from tagloom.sources import driver_tables
from tagloom.streaming import batches, cards, counters, quality, renames

from conftest import rows

ORDER = ["ts", "event_id"]
PIECES = 5


@pytest.fixture(scope="module")
def events(spark, sf_dir):
    return driver_tables.table(spark, sf_dir, "events")


@pytest.fixture(scope="module")
def pieces(spark, events, tmp_path_factory):
    """The events as PIECES files in time order."""
    folder = str(tmp_path_factory.mktemp("events"))
    size = -(-events.count() // PIECES)
    for i in range(PIECES):
        piece = events.where(f"event_id div {size} = {i}").coalesce(1)
        piece.write.mode("append").parquet(folder)
    return folder


@pytest.fixture
def stream(spark, events, pieces):
    reader = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
    return reader.parquet(pieces)


@pytest.fixture(scope="module")
def heads(spark, sf_dir):
    return driver_tables.tag_heads(spark, sf_dir)


@pytest.fixture
def folder(tmp_path):
    return lambda name: str(tmp_path / f"{name}-{uuid.uuid4().hex}")


def twice(on_batch):
    """Plays every batch again, as a restart after a failure would."""

    def played(df, batch_id):
        on_batch(df, batch_id)
        on_batch(df, batch_id)

    return played


def appended(spark, stream_df, folder):
    out = folder("out")
    (
        stream_df.writeStream.option("checkpointLocation", folder("check"))
        .trigger(availableNow=True)
        .start(out, format="parquet")
        .awaitTermination()
    )
    return spark.read.schema(stream_df.schema).parquet(out)


def test_stateless_tag_operators(spark, sf_dir, folder):
    path = folder("tags")
    driver_tables.tags(spark, sf_dir).write.parquet(path)
    batch = tl.read_tags(spark, path)
    for operator in (
        tl.tag_titles,
        tl.tag_fields,
        tl.tag_sections,
        tl.tag_chips,
        tl.tag_cards,
        tl.tag_lines,
        tl.duplicate_chip_keys_per_row,
    ):
        got = appended(spark, operator(tl.stream_tags(spark, path, max_files=1)), folder)
        assert rows(got) == rows(operator(batch)), operator.__name__


def test_stateless_event_operators(spark, events, stream, folder):
    for operator in (
        lambda e: tl.accepted_renames(driver_tables.commands(e)),
        lambda e: tl.json_prop_violations(e, "props", "k", ["event_id"]),
        lambda e: tl.prop_violations(e, "value", ["event_id"]),
        lambda e: tl.text_contains(e, "event_type", "c"),
        lambda e: tl.double_counter(e.select("event_id"), "event_id"),
    ):
        assert rows(appended(spark, operator(stream), folder)) == rows(operator(events))


def test_duplicates_with_state(spark, sf_dir, folder):
    path, out = folder("tags"), folder("out")
    driver_tables.tags(spark, sf_dir, part_items=3).write.parquet(path)
    found = tl.duplicate_chip_keys(tl.stream_tags(spark, path, max_files=1))
    keep = batches.batch_files(out)
    batches.run_available(found, keep, folder("check"), "complete")
    assert rows(batches.last_batch(spark, out)) == rows(
        tl.duplicate_chip_keys(driver_tables.tags(spark, sf_dir))
    )


def test_duplicates_with_state_in_files(spark, sf_dir, folder):
    path, out = folder("tags"), folder("out")
    driver_tables.tags(spark, sf_dir, part_items=1).repartition(3).write.parquet(path)
    count = quality.duplicate_counts(folder("state"), out)
    stream = tl.stream_tags(spark, path, max_files=1)
    batches.run_available(stream, twice(count), folder("check"))
    keys = ["tag_id", "section_ord", "item"]
    assert rows(batches.newest_per_key(spark, out, *keys)) == rows(
        tl.duplicate_chip_keys(driver_tables.tags(spark, sf_dir))
    )


@pytest.mark.parametrize("hot_rows", [1_000_000, 18])
def test_running_counts(spark, events, stream, folder, hot_rows):
    out = folder("out")
    count = counters.running_counts("user_id", ORDER, folder("state"), out, hot_rows)
    narrow = stream.select("user_id", *ORDER)
    batches.run_available(narrow, twice(count), folder("check"))
    got = batches.all_batches(spark, out)
    expected = tl.running_counter(events.select("user_id", *ORDER), "user_id", ORDER)
    assert rows(got) == rows(expected)


@pytest.mark.parametrize("hot_rows", [1_000_000, 40])
def test_running_counts_over_all(spark, events, stream, folder, hot_rows):
    out = folder("out")
    count = counters.running_counts_global(ORDER, folder("state"), out, hot_rows)
    batches.run_available(stream.select("user_id", *ORDER), twice(count), folder("check"))
    expected = tl.running_counter_global(events.select("user_id", *ORDER), ORDER)
    assert rows(batches.all_batches(spark, out)) == rows(expected)


def test_cards_of_a_stream(spark, sf_dir, folder):
    path, out = folder("tags"), folder("cards")
    driver_tables.tags(spark, sf_dir).write.parquet(path)
    tags = tl.stream_tags(spark, path, max_files=1)
    batches.run_available(tags, twice(cards.cards_files(out)), folder("check"))
    expected = tl.tag_cards(tl.read_tags(spark, path))
    assert rows(spark.read.text(out), "value") == rows(expected, "card")


def test_null_keys_go_on_counting(spark, events, stream, folder):
    out = folder("out")
    key = F.nullif("user_id", F.lit(3)).alias("user_id")
    count = counters.running_counts("user_id", ORDER, folder("state"), out)
    batches.run_available(stream.select(key, *ORDER), count, folder("check"))
    expected = tl.running_counter(events.select(key, *ORDER), "user_id", ORDER)
    assert rows(batches.all_batches(spark, out)) == rows(expected)


def test_counts_in_both_modes(spark, sf_dir, events, stream, folder):
    keys = driver_tables.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id")
    )
    expected = tl.double_counter(tl.event_counter(keys, events, "user_id"))
    out = folder("all")
    on_batch = twice(counters.counts_snapshot(keys, "user_id", out))
    counted = tl.event_counts(stream, "user_id")
    batches.run_available(counted, on_batch, folder("check"), "complete")
    assert rows(batches.last_batch(spark, out)) == rows(expected)

    out = folder("changed")
    batches.run_available(counted, counters.counts_changes(out), folder("check"), "update")
    newest = batches.newest_per_key(spark, out, "user_id")
    assert rows(newest) == rows(expected.where("count > 0"))


def test_replays_within_the_delay_count_once(spark, events, folder):
    path = folder("twice")
    events.coalesce(1).write.parquet(path)
    events.coalesce(1).write.mode("append").parquet(path)
    reader = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
    timed = reader.parquet(path).withColumn("at", F.col("ts").cast("timestamp"))
    once = counters.once_per_event_within(timed, ["event_id"], "at", "100 days")
    assert rows(appended(spark, once.select("event_id"), folder)) == rows(
        events.select("event_id")
    )


def test_current_outputs_agree(spark, sf_dir, events, stream, folder):
    tags = driver_tables.tags(spark, sf_dir, part_items=3).cache()
    now = tl.current_tags(tags, driver_tables.commands(events))
    names = tl.latest_names(driver_tables.commands(stream))
    out = folder("changes")
    on_batch = twice(renames.current_outputs(tags, folder("state"), out))
    batches.run_available(names, on_batch, folder("check"), "update")
    assert rows(renames.current_lines(tags, out)) == rows(tl.tag_lines(now))
    assert rows(renames.current_records(tags, out)) == rows(now)
    tags.unpersist()


def folder_bytes(path):
    return sum(
        os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files
    )


def test_a_rename_writes_only_lines_that_show_the_name(spark, events, stream, folder):
    """Bytes written follow the renames, not the lists of the renamed tags."""
    heads = events.select(F.col("user_id").alias("tag_id")).distinct()
    written = []
    for items in (1, 2_000):
        units = F.transform(F.sequence(F.lit(1), F.lit(items)), lambda i: i.cast("string"))
        tags = heads.select(
            "tag_id",
            F.lit("own").alias("tag_name"),
            F.lit("2025").alias("created_date"),
            F.array(F.lit("a")).alias("accounts"),
            units.alias("units"),
            *(F.array().cast("array<string>").alias(c) for c in ("drivers", "areas")),
        )
        out = folder("changes")
        names = tl.latest_names(driver_tables.commands(stream))
        on_batch = renames.current_outputs(tags, folder("state"), out)
        batches.run_available(names, on_batch, folder("check"), "update")
        changes = batches.all_batches(spark, out)
        assert {(r.output, r.label) for r in changes.select("output", "label").collect()} == {
            ("title", ""),
            ("field", "Tag Name"),
        }
        written.append(folder_bytes(out))
        now = tl.current_tags(tags, driver_tables.commands(events))
        assert rows(renames.current_lines(tags, out)) == rows(tl.tag_lines(now))
    assert abs(written[0] - written[1]) < 0.05 * written[0]


def test_a_name_that_comes_back_leaves_no_change(spark, folder):
    tags = tl.golden_tags(spark)
    state, out = folder("state"), folder("changes")
    on_batch = renames.current_outputs(tags, state, out)
    for number, name in enumerate(["Beta", "Ali Tag", "Beta", "Beta"]):
        named = spark.createDataFrame([(1, name), (99, name)], "tag_id bigint, new_name string")
        on_batch(named, number)
        now = tags.withColumn("tag_name", F.lit(name))
        assert rows(renames.current_lines(tags, out)) == rows(tl.tag_lines(now))
        assert rows(renames.current_records(tags, out)) == rows(now)
    assert batches.read_batch(spark, out, 3).count() == 0
    assert os.listdir(state) and len([d for d in os.listdir(state) if "batch_id" in d]) == 2


@pytest.mark.parametrize("hot_rows", [1_000_000, 18])
def test_rename_audits(spark, events, stream, heads, folder, hot_rows):
    out = folder("out")
    audit = renames.rename_audits(heads, folder("state"), out, hot_rows)
    commands = driver_tables.commands(stream)
    batches.run_available(commands, twice(audit), folder("check"))
    expected = tl.rename_audit(heads, driver_tables.commands(events))
    got = batches.all_batches(spark, out)
    assert got.where("change < 0").count() == 0  # nothing came late
    assert rows(got.drop("change")) == rows(expected)


@pytest.mark.parametrize("hot_rows", [1_000_000, 18])
def test_late_commands_correct_the_audit(spark, events, heads, folder, hot_rows):
    commands = driver_tables.commands(events)
    state, out = folder("state"), folder("out")
    audit = twice(renames.rename_audits(heads, state, out, hot_rows))
    for number in range(4):
        audit(commands.where(f"pmod(xxhash64(seq), 4) = {number}"), number)
        seen = commands.where(f"pmod(xxhash64(seq), 4) <= {number}")
        assert rows(renames.audit_so_far(heads, out)) == rows(tl.rename_audit(heads, seen))
    taken_back = batches.all_batches(spark, out).where("change < 0")
    assert 0 < taken_back.count() < 3 * commands.count()


def test_a_correction_reaches_only_the_suffix_of_its_tag(spark, folder):
    tags = tl.golden_tags(spark).unionByName(
        tl.golden_tags(spark).withColumn("tag_id", F.lit(2).cast("long"))
    )
    schema = "tag_id bigint, ts int, seq int, new_name string"

    def batch(*commands):
        return spark.createDataFrame(list(commands), schema)

    out = folder("out")
    audit = renames.rename_audits(tags, folder("state"), out)
    audit(batch((1, 1, 1, "A"), (1, 5, 5, None), (1, 6, 6, "B"), (1, 7, 7, ""), (2, 9, 9, "Z")), 0)
    audit(batch((1, 4, 4, "late"), (2, 9, 10, None), (3, 1, 1, "no such tag")), 1)
    changes = batches.read_batch(spark, out, 1)
    assert sorted((r.tag_id, r.seq, r.name_shown, r.change) for r in changes.collect()) == [
        (1, 4, "A", 1),
        (1, 5, "A", -1),
        (1, 5, "late", 1),
        (1, 6, "A", -1),
        (1, 6, "late", 1),
        (2, 10, "Z", 1),
    ]
    audit(batch((1, 4, 3, None), (1, 4, 3, None)), 2)  # changes no name; delivered twice
    assert batches.read_batch(spark, out, 2).where("change < 0").count() == 0
    assert renames.audit_so_far(tags, out).where("tag_id = 1 and seq = 3").count() == 2


def test_late_commands_do_not_win(spark, events, heads, folder):
    """The latest name follows (ts, seq), whatever batch a command comes in."""
    path, out = folder("backwards"), folder("out")
    for i in reversed(range(4)):
        piece = events.where(f"event_id div 250 = {i}").coalesce(1)
        piece.write.mode("append").parquet(path)
    reader = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
    names = tl.latest_names(driver_tables.commands(reader.parquet(path)))
    keep = batches.batch_files(out)
    batches.run_available(names, keep, folder("check"), "complete")
    assert rows(batches.last_batch(spark, out)) == rows(
        tl.latest_names(driver_tables.commands(events))
    )


def test_a_failed_batch_is_taken_up_again(spark, events, stream, folder):
    """A query that dies between its two writes goes on from its checkpoint."""
    out, check = folder("out"), folder("check")
    count = counters.running_counts("user_id", ORDER, folder("state"), out)
    narrow = stream.select("user_id", *ORDER)

    def dies(df, batch_id):
        count(df, batch_id)
        if batch_id == 2:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        batches.run_available(narrow, dies, check)
    batches.run_available(narrow, count, check)
    expected = tl.running_counter(events.select("user_id", *ORDER), "user_id", ORDER)
    assert rows(batches.all_batches(spark, out)) == rows(expected)


def test_changes_compare_the_two_tables_once(spark):
    schema = "tag_id bigint, name string"
    before = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c"), (None, "n")], schema)
    after = spark.createDataFrame([(1, "a"), (2, None), (2, None), (4, "d"), (None, "n")], schema)
    changes = batches.changed_rows(before, after)
    assert rows(changes, "tag_id", "name", "change") == sorted(
        [(1, "a", -1), (2, None, 1), (3, "c", -1), (4, "d", 1)], key=repr
    )
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1

"""The registered queries: every operator over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cards, counters, quality, renames, sections
from ..schema import PART_ITEMS
from ..session import drop_folder, scratch_path
from ..sources.bucketed import read_bucketed, write_bucketed
from ..sources.driver_tables import commands, table, tag_heads, tags
from ..sources.tags import read_tags
from ..sources.text_index import indexed_text_contains, write_text_index
from ..streaming import cards as stream_cards
from ..streaming import counters as stream_counters
from ..streaming import quality as stream_quality
from ..streaming import renames as stream_renames
from ..streaming.batches import all_batches, batch_files, newest_per_key, run_available

LISTS = ("accounts", "units", "drivers", "areas")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def _commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return commands(_events(spark, sf_dir))


def _lists_as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Lists as JSON text, which every engine compares alike."""
    return df.withColumns({c: F.to_json(c) for c in columns})


def tag_records(spark, sf_dir):
    return _lists_as_text(tags(spark, sf_dir), *LISTS)


def tag_titles(spark, sf_dir):
    return sections.tag_titles(tag_heads(spark, sf_dir))


def tag_fields(spark, sf_dir):
    return sections.tag_fields(tag_heads(spark, sf_dir))


def tag_sections(spark, sf_dir):
    return _lists_as_text(sections.tag_sections(tags(spark, sf_dir)), "items")


def tag_section_entries(spark, sf_dir):
    return sections.tag_section_entries(tags(spark, sf_dir))


def tag_chips(spark, sf_dir):
    return sections.tag_chips(tags(spark, sf_dir))


def tag_cards(spark, sf_dir):
    return cards.tag_cards(tags(spark, sf_dir))


def accepted_renames(spark, sf_dir):
    return renames.accepted_renames(_commands(spark, sf_dir))


def current_tags(spark, sf_dir):
    now = renames.current_tags(tags(spark, sf_dir), _commands(spark, sf_dir))
    return _lists_as_text(now, *LISTS)


def rename_audit(spark, sf_dir):
    return renames.rename_audit(tag_heads(spark, sf_dir), _commands(spark, sf_dir))


def current_tag_outputs(spark, sf_dir):
    return cards.tag_lines(renames.current_tags(tags(spark, sf_dir), _commands(spark, sf_dir)))


def _customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))


def event_counter(spark, sf_dir):
    events = _events(spark, sf_dir)
    return counters.event_counter(_customers(spark, sf_dir), events, "user_id")


def double_counter(spark, sf_dir):
    return counters.double_counter(event_counter(spark, sf_dir))


def running_counter(spark, sf_dir):
    events = _events(spark, sf_dir).select("user_id", "ts", "event_id")
    counted = counters.running_counter(events, "user_id", ["ts", "event_id"])
    return counters.double_counter(counted, "running_count")


def running_counter_global(spark, sf_dir):
    events = _events(spark, sf_dir).select("user_id", "ts", "event_id")
    return counters.running_counter_global(events, ["ts", "event_id"])


def prop_violations(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").withColumn(
        "msg", F.when(F.col("role") != "system", F.col("text"))
    )
    return quality.prop_violations(turns, "msg", ["conv_id", "turn"])


def prop_violations_json(spark, sf_dir):
    return quality.json_prop_violations(_events(spark, sf_dir), "props", "k", ["event_id"])


def duplicate_chip_keys(spark, sf_dir):
    return quality.duplicate_chip_keys(tags(spark, sf_dir))


def text_contains(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.text_contains(documents, "text", "the")


# Texts as a table of this many files, each with its filter.
TEXT_FILES = 8
RARE = "MIT License"


def _indexed_texts(spark, sf_dir, needle):
    path, index = scratch_path(spark, "texts"), scratch_path(spark, "index")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    documents.repartitionByRange(TEXT_FILES, "doc_id").write.parquet(path)
    write_text_index(spark, path, "text", index)
    return indexed_text_contains(spark, path, "text", needle, index)


def text_contains_indexed(spark, sf_dir):
    return _indexed_texts(spark, sf_dir, "the")


def text_contains_rare(spark, sf_dir):
    return _indexed_texts(spark, sf_dir, RARE)


# The same operators on records stored in small parts, and on keys that are cut up early.
SMALL_PARTS = 3
SMALL_HEAT = 8
FEW_SPLITS = 8


def _stored_parts(spark, sf_dir):
    """Tags as read back from storage, no row with more than SMALL_PARTS lines."""
    path = scratch_path(spark, "tags")
    tags(spark, sf_dir, SMALL_PARTS).write.parquet(path)
    return read_tags(spark, path)


def tag_records_parts(spark, sf_dir):
    return _lists_as_text(_stored_parts(spark, sf_dir), *LISTS)


def tag_sections_parts(spark, sf_dir):
    return _lists_as_text(sections.tag_sections(_stored_parts(spark, sf_dir)), "items")


def tag_section_entries_parts(spark, sf_dir):
    return sections.tag_section_entries(_stored_parts(spark, sf_dir))


def tag_chips_parts(spark, sf_dir):
    return sections.tag_chips(_stored_parts(spark, sf_dir))


def tag_cards_parts(spark, sf_dir):
    path = scratch_path(spark, "cards")
    cards.write_cards(cards.tag_cards(_stored_parts(spark, sf_dir)), path)
    lines = spark.read.text(path).withColumnRenamed("value", "card")
    whose = [F.get_json_object("card", f"$.{c}") for c in ("tag_id", "part")]
    return lines.select(
        whose[0].cast("long").alias("tag_id"), whose[1].cast("int").alias("part"), "card"
    )


def duplicate_chip_keys_parts(spark, sf_dir):
    return quality.duplicate_chip_keys(_stored_parts(spark, sf_dir))


def current_tags_parts(spark, sf_dir):
    stored = _stored_parts(spark, sf_dir)
    return _lists_as_text(renames.current_tags(stored, _commands(spark, sf_dir)), *LISTS)


def tag_chips_split(spark, sf_dir):
    return sections.tag_chips(tags(spark, sf_dir, SMALL_PARTS, 5, FEW_SPLITS))


def running_counter_split(spark, sf_dir):
    events = _events(spark, sf_dir).select("user_id", "ts", "event_id")
    counted = counters.running_counter(
        events, "user_id", ["ts", "event_id"], SMALL_HEAT, max_splits=FEW_SPLITS
    )
    return counters.double_counter(counted, "running_count")


def rename_audit_split(spark, sf_dir):
    heads = tag_heads(spark, sf_dir)
    return renames.rename_audit(
        heads, _commands(spark, sf_dir), SMALL_HEAT, max_splits=FEW_SPLITS
    )


# Streams get their source in this many pieces, one batch each.
PIECES = 4


def _stream_pieces(spark, rows, piece, query, on_batch, mode="append", done=()) -> None:
    """Feeds `rows` to a stream piece by piece and drops what the result does not need."""
    folder, checkpoint = scratch_path(spark, "pieces"), scratch_path(spark, "checkpoint")
    for number in range(PIECES):
        rows.where(piece == number).write.mode("append").parquet(folder)
        source = spark.readStream.schema(rows.schema).parquet(folder)
        run_available(query(source), on_batch, checkpoint, mode)
    for path in (folder, checkpoint, *done):
        drop_folder(spark, path)


def _time_piece(events):
    """The pieces are spans of time, because running results follow the order of batches."""
    second = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    low, high = events.agg(F.min(second), F.max(second)).first()
    span = max(1, (high or 0) - (low or 0) + 1)
    return F.coalesce(F.floor((second - F.lit(low or 0)) * PIECES / span), F.lit(0))


def tag_chips_stream(spark, sf_dir):
    out, path = scratch_path(spark, "chips"), scratch_path(spark, "tags")
    tags(spark, sf_dir).write.parquet(path)
    stored = read_tags(spark, path)
    piece = F.pmod("tag_id", F.lit(PIECES))
    _stream_pieces(
        spark, stored, piece, sections.tag_chips, batch_files(out), done=[path]
    )
    return all_batches(spark, out)


def accepted_renames_stream(spark, sf_dir):
    out, events = scratch_path(spark, "renames"), _events(spark, sf_dir)

    def query(source):
        return renames.accepted_renames(commands(source))

    _stream_pieces(spark, events, _time_piece(events), query, batch_files(out))
    return all_batches(spark, out)


def event_counter_stream(spark, sf_dir):
    out, events = scratch_path(spark, "counts"), _events(spark, sf_dir)
    keys = _customers(spark, sf_dir)

    def query(source):
        return counters.event_counts(source, "user_id")

    on_batch = stream_counters.counts_changes(out)
    _stream_pieces(spark, events, _time_piece(events), query, on_batch, "update")
    counts = newest_per_key(spark, out, "user_id").select("user_id", "count")
    return counters.double_counter(counters.with_zero_counts(keys, counts, "user_id"))


def running_counter_stream(spark, sf_dir):
    state, out = scratch_path(spark, "state"), scratch_path(spark, "running")
    on_batch = stream_counters.running_counts(
        "user_id", ["ts", "event_id"], state, out
    )
    events = _events(spark, sf_dir).select("user_id", "ts", "event_id")
    piece = _time_piece(events)
    _stream_pieces(spark, events, piece, lambda s: s, on_batch, done=[state])
    return counters.double_counter(all_batches(spark, out), "running_count")


def running_counter_global_stream(spark, sf_dir):
    state, out = scratch_path(spark, "state"), scratch_path(spark, "running")
    on_batch = stream_counters.running_counts_global(["ts", "event_id"], state, out)
    events = _events(spark, sf_dir).select("user_id", "ts", "event_id")
    piece = _time_piece(events)
    _stream_pieces(spark, events, piece, lambda s: s, on_batch, done=[state])
    return all_batches(spark, out)


def _audit_stream(spark, sf_dir, piece):
    """The audit of commands that come in these pieces, with the corrections that takes."""
    state, out = scratch_path(spark, "state"), scratch_path(spark, "audit")
    heads, events = tag_heads(spark, sf_dir), _events(spark, sf_dir)
    on_batch = stream_renames.rename_audits(heads, state, out)
    _stream_pieces(spark, events, piece(events), commands, on_batch, done=[state])
    return stream_renames.audit_so_far(heads, out)


def rename_audit_stream(spark, sf_dir):
    return _audit_stream(spark, sf_dir, _time_piece)


def rename_audit_late_stream(spark, sf_dir):
    """Commands in no order at all: every batch corrects what earlier ones wrote."""
    return _audit_stream(spark, sf_dir, lambda _: F.pmod(F.xxhash64("event_id"), F.lit(PIECES)))


def _current_stream(spark, sf_dir, part_items):
    """Stored tags and the folder in which a stream of renames wrote the changed lines."""
    out, path = scratch_path(spark, "current"), scratch_path(spark, "tags")
    tags(spark, sf_dir, part_items).write.parquet(path)
    stored, events = read_tags(spark, path), _events(spark, sf_dir)

    def query(source):
        return renames.latest_names(commands(source))

    state = scratch_path(spark, "state")
    on_batch = stream_renames.current_outputs(stored, state, out)
    _stream_pieces(
        spark, events, _time_piece(events), query, on_batch, "update", done=[state]
    )
    return stored, out


def current_tags_stream(spark, sf_dir):
    stored, out = _current_stream(spark, sf_dir, PART_ITEMS)
    return _lists_as_text(stream_renames.current_records(stored, out), *LISTS)


def current_tag_outputs_stream(spark, sf_dir):
    """All lines of all views: the stored records with the changes of the stream."""
    return stream_renames.current_lines(*_current_stream(spark, sf_dir, SMALL_PARTS))


def current_chips_stream(spark, sf_dir):
    lines = current_tag_outputs_stream(spark, sf_dir)
    return lines.where("output = 'section' and pos >= 0").select(
        "tag_id",
        F.col("ord").alias("section_ord"),
        "label",
        F.col("pos").alias("item_pos"),
        F.col("value").alias("item"),
    )


def current_fields_stream(spark, sf_dir):
    lines = current_tag_outputs_stream(spark, sf_dir)
    return lines.where("output = 'field'").select(
        "tag_id", F.col("ord").alias("field_ord"), "label", "value"
    )


def tag_cards_stream(spark, sf_dir):
    out, path = scratch_path(spark, "cards"), scratch_path(spark, "tags")
    tags(spark, sf_dir).write.parquet(path)
    stored = read_tags(spark, path)
    on_batch = stream_cards.cards_files(out, "parquet")
    piece = F.pmod("tag_id", F.lit(PIECES))
    _stream_pieces(spark, stored, piece, lambda s: s, on_batch, done=[path])
    return all_batches(spark, out)


def prop_violations_json_stream(spark, sf_dir):
    out, events = scratch_path(spark, "violations"), _events(spark, sf_dir)

    def query(source):
        return quality.json_prop_violations(source, "props", "k", ["event_id"])

    _stream_pieces(spark, events, _time_piece(events), query, batch_files(out))
    return all_batches(spark, out)


def duplicate_chip_keys_stream(spark, sf_dir):
    """Lists that go on in later batches: counts of each item are kept as state."""
    out, path = scratch_path(spark, "duplicates"), scratch_path(spark, "tags")
    state = scratch_path(spark, "state")
    tags(spark, sf_dir, SMALL_PARTS).write.parquet(path)
    stored = read_tags(spark, path)
    piece = F.pmod(F.col("tag_id") + F.col("part"), F.lit(PIECES))
    on_batch = stream_quality.duplicate_counts(state, out)
    _stream_pieces(spark, stored, piece, lambda s: s, on_batch, done=[path, state])
    return newest_per_key(spark, out, "tag_id", "section_ord", "item")


def duplicate_chip_keys_per_row(spark, sf_dir):
    """Records of one row each need neither shuffle nor state."""
    stored = tags(spark, sf_dir)
    return quality.duplicate_chip_keys_per_row(stored)


# As many buckets as a test table can use.
FEW_BUCKETS = 16


def _bucketed(spark, rows, purpose):
    """`rows` as a table in buckets of their tag."""
    path = scratch_path(spark, purpose)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    write_bucketed(rows, table, path, FEW_BUCKETS)
    return read_bucketed(spark, table)


def current_tags_bucketed(spark, sf_dir):
    """Records and names stored in the same buckets: the join moves neither."""
    stored = _bucketed(spark, tags(spark, sf_dir), "tags")
    names = _bucketed(spark, renames.latest_names(_commands(spark, sf_dir)), "names")
    return _lists_as_text(renames.with_names(stored, names), *LISTS)


def rename_audit_bucketed(spark, sf_dir):
    """Commands and tags stored in the same buckets."""
    heads = _bucketed(spark, tag_heads(spark, sf_dir), "tags")
    edits = _bucketed(spark, _commands(spark, sf_dir), "commands")
    return renames.rename_audit(heads, edits)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        tag_records,
        tag_titles,
        tag_fields,
        tag_sections,
        tag_section_entries,
        tag_section_entries_parts,
        tag_chips,
        tag_cards,
        accepted_renames,
        current_tags,
        rename_audit,
        current_tag_outputs,
        event_counter,
        double_counter,
        running_counter,
        running_counter_global,
        prop_violations,
        prop_violations_json,
        duplicate_chip_keys,
        text_contains,
        text_contains_indexed,
        text_contains_rare,
        tag_records_parts,
        tag_sections_parts,
        tag_chips_parts,
        tag_cards_parts,
        duplicate_chip_keys_parts,
        current_tags_parts,
        tag_chips_split,
        running_counter_split,
        rename_audit_split,
        tag_cards_stream,
        prop_violations_json_stream,
        duplicate_chip_keys_stream,
        current_chips_stream,
        current_fields_stream,
        tag_chips_stream,
        accepted_renames_stream,
        current_tags_stream,
        rename_audit_stream,
        rename_audit_late_stream,
        current_tag_outputs_stream,
        current_tags_bucketed,
        rename_audit_bucketed,
        duplicate_chip_keys_per_row,
        event_counter_stream,
        running_counter_stream,
        running_counter_global_stream,
    )
}

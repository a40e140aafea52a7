"""Rename commands as a stream: what they change in the views, and their audit.

Both write changes per batch: rows that are added (`change` 1) and rows that are taken back
(`change` -1), so what a batch writes follows what it changed. `net_rows` of all changes is
the answer so far.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import with_parts
from ..operators.cards import line_changes, tag_lines
from ..operators.ordering import HOT_ROWS
from ..operators.renames import accepted_place, rename_audit, with_names
from ..schema import COMMAND_SCHEMA, KEY, ORDER
from ..session import drop_folder
from ..sources.bucketed import only_keys
from .batches import (
    SPLITS,
    all_batches,
    batches_before,
    changed_rows,
    net_rows,
    save_state,
    state_before,
    write_batch,
)

# What a rename changes.
RENAMED = ("tag_name",)


def current_outputs(
    tags: DataFrame, state: str, out: str, key: str = KEY
) -> Callable[[DataFrame, int], None]:
    """For `latest_names` as a stream in update mode: the lines of the views that change.

    Only lines that show the name are taken back and written anew: the title and one field of
    each renamed tag. Lists are neither read nor written. State is the name that each renamed
    tag shows.
    """

    def on_batch(names: DataFrame, batch_id: int) -> None:
        spark = names.sparkSession
        now = names.select(key, F.col("new_name").alias("new_tag_name")).persist()
        try:
            schema = T.StructType([tags.schema[key], COMMAND_SCHEMA["new_name"]])
            earlier = state_before(spark, state, batch_id, schema)
            own = _own_names(tags, now, key)
            shown = own.join(now, key).join(earlier, key, "left").select(
                key,
                F.coalesce("new_name", "tag_name").alias("old_tag_name"),
                "new_tag_name",
            )
            write_batch(line_changes(shown, RENAMED, key), out, batch_id)
            after = earlier.join(now, key, "left_anti").unionByName(
                now.withColumnRenamed("new_tag_name", "new_name")
            )
            save_state(after, state, batch_id)
        finally:
            now.unpersist()

    return on_batch


def current_lines(tags: DataFrame, out: str, key: str = KEY) -> DataFrame:
    """All lines of all views (`tag_lines`) after the batches that `current_outputs` wrote.

    Lines that no rename reaches come straight from the records, without a shuffle.
    """
    reached = tag_lines(tags, key, reading=RENAMED).withColumn("change", F.lit(1))
    same = tag_lines(tags, key, not_reading=RENAMED)
    return net_rows(reached.unionByName(all_batches(tags.sparkSession, out))).unionByName(same)


def current_records(tags: DataFrame, out: str, key: str = KEY) -> DataFrame:
    """All records after the batches that `current_outputs` wrote."""
    titles = all_batches(tags.sparkSession, out).where("output = 'title'")
    # Of a renamed tag, every name but the present one was added as often as it was taken back;
    # its own name was only taken back.
    names = titles.groupBy(key, "value").agg(F.sum("change").alias("n")).where("n > 0")
    return with_names(tags, names.select(key, F.col("value").alias("new_name")), key)


def rename_audits(
    tags: DataFrame,
    state: str,
    out: str,
    hot_rows: int = HOT_ROWS,
    key: str = KEY,
    order: Sequence[str] = ORDER,
) -> Callable[[DataFrame, int], None]:
    """For a stream of commands: the audit of each, with corrections for late ones.

    State is, per tag, the place of its newest command and the name after it, so commands in
    order need no history. Where a batch holds a command older than the newest of its tag, the
    audit of that tag is read from there on, worked out anew with the late commands, and the
    rows that differ are taken back and replaced. Commands at the same place as the newest
    count as after it.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        commands = batch.select(key, *order, "new_name").persist()
        scratch = f"{state}/{SPLITS}"
        try:
            earlier = state_before(spark, state, batch_id, _audit_state(commands, key, order))
            touched = (
                commands.groupBy(key)
                .agg(F.min(F.struct(*order)).alias("_from"))
                .join(earlier, key, "left")
                .persist()
            )
            late = touched.where(F.col("_from") < F.col("newest"))
            own = _own_names(tags, touched, key)
            start = own.join(touched, key).select(
                key, F.coalesce("name", "tag_name").alias("tag_name")
            )
            any_late = bool(late.take(1))
            if not any_late:
                fresh = rename_audit(start, commands, hot_rows, scratch, key, order)
                changes = fresh.withColumn("change", F.lit(1))
            else:
                in_time = commands.join(late.select(key), key, "left_anti")
                fresh = rename_audit(start, in_time, hot_rows, scratch, key, order)
                changes = fresh.withColumn("change", F.lit(1)).unionByName(
                    _corrections(spark, commands, late, out, batch_id, hot_rows, scratch, key, order)
                )
            write_batch(changes, out, batch_id)
            save_state(_after(earlier, commands, key, order), state, batch_id)
            touched.unpersist()
        finally:
            commands.unpersist()
            drop_folder(spark, scratch)

    return on_batch


def audit_so_far(tags: DataFrame, out: str) -> DataFrame:
    """`rename_audit` of all commands that `rename_audits` has seen."""
    return net_rows(all_batches(tags.sparkSession, out))


def _own_names(tags: DataFrame, touched: DataFrame, key: str) -> DataFrame:
    heads = with_parts(tags).where("part = 0").select(key, "tag_name")
    return only_keys(heads, touched, key).join(touched.select(key).distinct(), key, "left_semi")


def _audit_state(commands: DataFrame, key: str, order: Sequence[str]) -> T.StructType:
    place = T.StructType([commands.schema[c] for c in order])
    return T.StructType(
        [
            commands.schema[key],
            T.StructField("newest", place),
            T.StructField("named_at", place),
            T.StructField("name", T.StringType()),
        ]
    )


def _after(earlier: DataFrame, commands: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The state with the commands of a batch."""
    places = commands.select(
        key,
        F.struct(*order).alias("newest"),
        accepted_place("new_name", order).alias("named_at"),
        F.col("new_name").alias("name"),
    )
    return (
        earlier.unionByName(places)
        .groupBy(key)
        .agg(
            F.max("newest").alias("newest"),
            F.max("named_at").alias("named_at"),
            F.max_by("name", "named_at").alias("name"),
        )
    )


def _corrections(
    spark, commands, late, out, batch_id, hot_rows, scratch, key, order
) -> DataFrame:
    place = F.struct(*order)
    history = only_keys(batches_before(spark, out, batch_id), late, key)
    suffix = net_rows(
        history.join(late.select(key, "_from"), key)
        .where(place > F.col("_from"))
        .drop("_from")
    ).persist()
    # The name that the first command of the suffix was shown is the one at the late command.
    start = suffix.groupBy(key).agg(F.min_by("name_shown", place).alias("tag_name"))
    columns = [key, *order, "new_name"]
    again = suffix.select(*columns).unionByName(commands.join(late.select(key), key, "left_semi"))
    redone = rename_audit(start, again, hot_rows, scratch, key, order)
    return changed_rows(suffix, redone.select(*suffix.columns))

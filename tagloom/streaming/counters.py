"""Counters over streams of events."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.counters import (
    double_counter,
    event_counts,
    running_counter_from,
    running_counter_global,
    with_zero_counts,
)
from ..operators.ordering import HOT_ROWS, null_safe
from ..session import drop_folder
from .batches import SPLITS, save_state, state_before, write_batch

_ALL = T.StructType([T.StructField("n", T.LongType())])


def once_per_event_within(
    events: DataFrame, event_id: Sequence[str], time: str, delay: str
) -> DataFrame:
    """Drops events delivered again no later than `delay` after the first delivery."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(event_id))


def counts_snapshot(
    keys: DataFrame, key: str, out: str
) -> Callable[[DataFrame, int], None]:
    """For `event_counts` in complete mode: all keys' counts per batch, with the zeros."""

    def on_batch(counts: DataFrame, batch_id: int) -> None:
        write_batch(double_counter(with_zero_counts(keys, counts, key)), out, batch_id)

    return on_batch


def counts_changes(out: str) -> Callable[[DataFrame, int], None]:
    """For `event_counts` in update mode: the keys that a batch changed."""

    def on_batch(counts: DataFrame, batch_id: int) -> None:
        write_batch(double_counter(counts), out, batch_id)

    return on_batch


def running_counts(
    key: str,
    order: Sequence[str],
    state: str,
    out: str,
    hot_rows: int = HOT_ROWS,
) -> Callable[[DataFrame, int], None]:
    """For a stream of events: each event with its key's count after it.

    Order holds inside a batch and between batches; an event that comes in a later batch
    than younger events of its key is counted after them.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        _count_on(batch, batch_id, key, order, state, out, hot_rows)

    return on_batch


def running_counts_global(
    order: Sequence[str],
    state: str,
    out: str,
    hot_rows: int = HOT_ROWS,
) -> Callable[[DataFrame, int], None]:
    """The same with the count of all events after each event."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        events = batch.persist()
        try:
            # One row of state: how many events there were before this batch.
            earlier = state_before(spark, state, batch_id, _ALL)
            before = earlier.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
            running = running_counter_global(events, order, hot_rows, f"{state}/{SPLITS}")
            so_far = F.col("running_count") + F.lit(before)
            write_batch(running.withColumn("running_count", so_far), out, batch_id)
            after = spark.createDataFrame([(before + events.count(),)], _ALL)
            save_state(after, state, batch_id)
        finally:
            events.unpersist()
            drop_folder(spark, f"{state}/{SPLITS}")

    return on_batch


def _count_on(batch, batch_id, key, order, state, out, hot_rows) -> None:
    spark = batch.sparkSession
    events = batch.persist()
    try:
        schema = T.StructType([batch.schema[key], T.StructField("count", T.LongType())])
        counts = event_counts(events, key)
        earlier = state_before(spark, state, batch_id, schema)
        touched = earlier.join(
            counts.select(F.col(key).alias("_key")), null_safe([(key, "_key")]), "left_semi"
        )
        running = running_counter_from(
            events, touched, key, order, hot_rows, f"{state}/{SPLITS}"
        )
        write_batch(running, out, batch_id)
        after = earlier.unionByName(counts).groupBy(key).agg(F.sum("count").alias("count"))
        save_state(after, state, batch_id)
    finally:
        events.unpersist()
        drop_folder(spark, f"{state}/{SPLITS}")

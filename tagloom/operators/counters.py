"""Counts of events per key, their double, and the count after each event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .grid import grid_position, has_grid
from .ordering import (
    HOT_ROWS,
    MAX_SPLITS,
    SPLITS_PER_HEAT,
    divide_by_heat,
    hot_keys,
    null_safe,
    running_position,
    split_position,
    window_position,
)


def once_per_event(events: DataFrame, event_id: Sequence[str]) -> DataFrame:
    """For sources that may deliver an event twice."""
    return events.dropDuplicates(list(event_id))


def event_counts(events: DataFrame, key: str) -> DataFrame:
    """(key, count) of the keys that have events. Also runs on a stream."""
    return events.groupBy(key).agg(F.count(F.lit(1)).alias("count"))


def with_zero_counts(keys: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """One row for each row of `keys`, 0 where nothing was counted."""
    return (
        keys.select(key)
        .join(counts, key, "left")
        .select(key, F.coalesce("count", F.lit(0)).alias("count"))
    )


def event_counter(keys: DataFrame, events: DataFrame, key: str) -> DataFrame:
    return with_zero_counts(keys, event_counts(events, key), key)


def double_counter(counts: DataFrame, count: str = "count") -> DataFrame:
    return counts.withColumn("double_count", F.col(count) * 2)


def running_counter(
    events: DataFrame,
    key: str,
    order: Sequence[str],
    hot_rows: int = HOT_ROWS,
    scratch: str | None = None,
    max_splits: int = MAX_SPLITS,
) -> DataFrame:
    """Each event with its key's count right after it.

    The events of keys with more than `hot_rows` are written to `scratch` on the way (a
    new path in the shared folder if not given).
    """
    return running_position(
        events, [key], order, "running_count", hot_rows, scratch, max_splits
    )


def running_counter_from(
    events: DataFrame,
    start: DataFrame,
    key: str,
    order: Sequence[str],
    hot_rows: int = HOT_ROWS,
    scratch: str | None = None,
) -> DataFrame:
    """`running_counter` that goes on from the (key, count) rows of `start`."""
    start = start.select(F.col(key).alias("_key"), F.col("count").alias("_start"))

    def onto(counted: DataFrame, start: DataFrame) -> DataFrame:
        so_far = F.col("running_count") + F.coalesce("_start", F.lit(0))
        return (
            counted.join(start, null_safe([(key, "_key")]), "left")
            .withColumn("running_count", so_far)
            .drop("_key", "_start")
        )

    hot = hot_keys(events, [key], hot_rows)
    if not hot:
        return onto(window_position(events, [key], order, "running_count"), start)
    cold_events, hot_events = divide_by_heat(events, [key], hot)
    # As few rows as there are hot keys.
    hot_start = F.broadcast(divide_by_heat(start, ["_key"], hot, [key])[1])
    cold = window_position(cold_events, [key], order, "running_count")
    split = split_position(
        hot_events, [key], order, hot, "running_count", hot_rows, scratch
    )
    return onto(cold, start).unionByName(onto(split, hot_start))


def running_counter_global(
    events: DataFrame,
    order: Sequence[str],
    hot_rows: int = HOT_ROWS,
    scratch: str | None = None,
) -> DataFrame:
    """Each event with the count of all events right after it.

    Where `order` is of whole numbers, dates or times, from the totals of a grid: one shuffle,
    no copy. Other types go by ranges that are written to `scratch`.
    """
    if has_grid(events, order):
        cell_rows = max(1, hot_rows // SPLITS_PER_HEAT)
        return grid_position(events, order, "running_count", cell_rows)
    return running_position(events, [], order, "running_count", hot_rows, scratch)

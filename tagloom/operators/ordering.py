"""Running positions and carried values over ordered rows, safe for hot keys.

A window puts all rows of a key into one task. That is right for a key of ordinary
size. The rows of a hot key are range-partitioned over (key, order) instead, so that a
key spans as many tasks as it needs, and each split takes over a small carry from the
splits before it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

# A key is hot with more than HOT_ROWS rows and more than 1/HOT_SHARE of all rows, so there
# are fewer than HOT_SHARE hot keys; but whatever the table's size, a key of more than HOTTEST
# times HOT_ROWS is hot, so no window task holds more.
HOT_ROWS = 1_000_000
HOT_SHARE = 100_000
HOTTEST = 20
# Rows are first counted by this many buckets of their keys, which a task adds up before
# anything is shuffled; only keys in crowded buckets get a count of their own.
BUCKETS = 1 << 20
# Splits of the hot rows; with HOT_SHARE it bounds the carry tables that are broadcast.
MAX_SPLITS = 20_000
# Up to there a split holds 1/SPLITS_PER_HEAT of what makes a key hot.
SPLITS_PER_HEAT = 4


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> list[Row]:
    """The hot keys with their row counts; with no `keys`, the whole table is one hot key.

    Runs one to three small jobs while a plan is made, and reads `df` in each: pass stored
    rows, or rows that are cheap to make again.
    """
    # Few rows in all rule hot keys out; on files, this count reads footers only.
    total = df.count()
    if not keys:
        return [Row(n=total)] if total else []
    if total <= hot_rows:
        return []
    limit = min(max(hot_rows, total // HOT_SHARE), HOTTEST * hot_rows)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))
    by_bucket = df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    crowded = [row["bucket"] for row in by_bucket.where(F.col("n") > limit).collect()]
    if not crowded:
        return []
    few = F.broadcast(  # at most BUCKETS rows
        df.sparkSession.createDataFrame([(b,) for b in crowded], "_bucket bigint")
    )
    counts = (
        df.join(few, bucket == F.col("_bucket"), "left_semi")
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.where(F.col("n") > limit).collect()


def divide_by_heat(
    df: DataFrame, keys: Sequence[str], hot: list[Row], hot_names: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, rows of hot keys); `hot_names` where `hot` calls them so."""
    schema = T.StructType([T.StructField(f"_hot_{k}", df.schema[k].dataType) for k in keys])
    found = [tuple(row[k] for k in hot_names or keys) for row in hot]
    small = F.broadcast(df.sparkSession.createDataFrame(found, schema))  # < HOT_SHARE rows
    match = null_safe([(k, f"_hot_{k}") for k in keys])
    return df.join(small, match, "left_anti"), df.join(small, match, "left_semi")


def ordered_splits(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    hot: list[Row],
    hot_rows: int,
    scratch: str | None = None,
    max_splits: int = MAX_SPLITS,
) -> DataFrame:
    """The rows of `hot` keys cut into ranges of (keys, order): adds `_split` and `_row`.

    `_row` grows along the order and has no gaps inside a split. There are at most `max_splits`
    of them, each with a share of all rows, whatever number of keys that is. The ranges are written
    out, because a second computation could cut them elsewhere: to a new folder under
    `scratch`, or under the shared folder. They are read when the result is; drop `scratch`
    (`session.drop_folder`) when that is stored.
    """
    spark = df.sparkSession
    rows = sum(row["n"] for row in hot)
    splits = min(max_splits, -(-rows * SPLITS_PER_HEAT // hot_rows))
    by = [*keys, *order]
    path = scratch_path(spark, "ordered", scratch)
    (
        df.repartitionByRange(splits, *by)
        .sortWithinPartitions(*by)
        .withColumn("_row", F.monotonically_increasing_id())
        .write.parquet(path)
    )
    # The partition number is in the bits above the 33 that count its rows.
    return spark.read.parquet(path).withColumn("_split", F.shiftright("_row", 33))


def running_position(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "position",
    hot_rows: int = HOT_ROWS,
    scratch: str | None = None,
    max_splits: int = MAX_SPLITS,
) -> DataFrame:
    """Adds each row's place (from 1) among the rows of its key, in `order`.

    `order` should be total, or equal rows get their places in any order.
    """
    hot = hot_keys(df, keys, hot_rows)
    if not hot:
        return window_position(df, keys, order, name)
    if not keys:
        return split_position(df, keys, order, hot, name, hot_rows, scratch, max_splits)
    cold_part, hot_part = divide_by_heat(df, keys, hot)
    return window_position(cold_part, keys, order, name).unionByName(
        split_position(hot_part, keys, order, hot, name, hot_rows, scratch, max_splits)
    )


def window_position(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "position"
) -> DataFrame:
    """`running_position` for keys that each fit one task."""
    return df.withColumn(name, F.row_number().over(_window(keys, order)).cast("long"))


def split_position(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    hot: list[Row],
    name: str = "position",
    hot_rows: int = HOT_ROWS,
    scratch: str | None = None,
    max_splits: int = MAX_SPLITS,
) -> DataFrame:
    """`running_position` for the rows of `hot` keys."""
    split = ordered_splits(df, keys, order, hot, hot_rows, scratch, max_splits)
    # One row per split and key: at most MAX_SPLITS + HOT_SHARE rows.
    carry = split.groupBy("_split", *keys).agg(
        F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    carry = carry.withColumn(
        "_before", F.coalesce(F.sum("_n").over(earlier_splits(keys)), F.lit(0))
    )
    return (
        with_carry(split, carry, keys)
        .withColumn(name, F.col("_before") + F.col("_row") - F.col("_first") + 1)
        .drop("_split", "_row", "_first", "_n", "_before")
    )


def earlier_splits(keys: Sequence[str]):
    """Window over a carry table: the splits of the same key before this one."""
    return _window(keys, ["_split"]).rowsBetween(Window.unboundedPreceding, -1)


def with_carry(split: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attaches a carry table, which `MAX_SPLITS + HOT_SHARE` rows bound, to its splits."""
    shared = ["_split", *keys]
    carry = carry.withColumnsRenamed({c: f"_carry{c}" for c in shared})
    match = null_safe([(c, f"_carry{c}") for c in shared])
    return split.join(F.broadcast(carry), match, "left").drop(*(f"_carry{c}" for c in shared))


def null_safe(pairs: Sequence[tuple[str, str]]) -> Column:
    """Join condition that pairs NULL keys too, as a window's groups do."""
    return reduce(Column.__and__, (F.col(a).eqNullSafe(F.col(b)) for a, b in pairs))


def _window(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*(keys or [F.lit(0)])).orderBy(*order)

"""Rename commands: which are accepted, the current name, and what each edit saw."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import accepted_or_null, is_accepted, with_parts
from ..schema import KEY, ORDER
from .ordering import (
    HOT_ROWS,
    MAX_SPLITS,
    divide_by_heat,
    earlier_splits,
    hot_keys,
    ordered_splits,
    with_carry,
)

def accepted_place(name: str, order: Sequence[str]) -> Column:
    """The place of an accepted command in its tag's order, NULL for the others."""
    return F.when(is_accepted(name), F.struct(*order))


def accepted_renames(commands: DataFrame) -> DataFrame:
    return commands.where(is_accepted("new_name"))


def latest_names(
    commands: DataFrame, key: str = KEY, order: Sequence[str] = ORDER
) -> DataFrame:
    """(key, new_name) of each tag's last accepted command, whatever order they came in.

    One small value per tag and map task is shuffled. Also runs on a stream.
    """
    return (
        accepted_renames(commands)
        .groupBy(key)
        .agg(F.max_by("new_name", F.struct(*order)).alias("new_name"))
    )


def with_names(tags: DataFrame, names: DataFrame, key: str = KEY) -> DataFrame:
    """`tags` under the names of `latest_names`; other tags keep their own.

    A name is kept in part 0 of its record. The join is on the key alone, so a partitioning of
    records or names by key is used as it is; where records have to move, adaptive execution
    splits one of many parts at this join.
    """
    name = F.coalesce("new_name", "tag_name")
    if "part" in tags.columns:
        name = F.when(F.col("part") == 0, name).otherwise(F.col("tag_name"))
    return tags.join(names, key, "left").withColumn("tag_name", name).select(*tags.columns)


def current_tags(
    tags: DataFrame, commands: DataFrame, key: str = KEY, order: Sequence[str] = ORDER
) -> DataFrame:
    return with_names(tags, latest_names(commands, key, order), key)


def unknown_tag_commands(tags: DataFrame, commands: DataFrame, key: str = KEY) -> DataFrame:
    """Commands for tags that do not exist; the other operators pass over them."""
    return commands.join(with_parts(tags).where("part = 0").select(key), key, "left_anti")


def rename_audit(
    tags: DataFrame,
    commands: DataFrame,
    hot_rows: int = HOT_ROWS,
    scratch: str | None = None,
    key: str = KEY,
    order: Sequence[str] = ORDER,
    max_splits: int = MAX_SPLITS,
) -> DataFrame:
    """Per command the name it was shown, whether it was accepted, and the name after it.

    The commands of tags with more than `hot_rows` are written to `scratch` on the way (a
    new path in the shared folder if not given).
    """
    names = with_parts(tags).where("part = 0").select(key, "tag_name")
    edits = commands.select(key, *order, "new_name")
    hot = hot_keys(edits, [key], hot_rows)
    if not hot:
        return _audit(_with_last_accepted(edits, [key], order), names, key, order)
    cold_edits, hot_edits = divide_by_heat(edits, [key], hot)
    # As few rows as there are hot keys.
    hot_names = F.broadcast(divide_by_heat(names, [key], hot)[1])
    split = ordered_splits(hot_edits, [key], order, hot, hot_rows, scratch, max_splits)
    cold = _with_last_accepted(cold_edits, [key], order)
    spread = _with_last_accepted_over_splits(split, key)
    return _audit(cold, names, key, order).unionByName(_audit(spread, hot_names, key, order))


def _with_last_accepted(
    edits: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    earlier = (
        Window.partitionBy(*keys)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    last = F.last(accepted_or_null("new_name"), ignorenulls=True)
    return edits.withColumn("_last", last.over(earlier))


def _with_last_accepted_over_splits(split: DataFrame, key: str) -> DataFrame:
    """Where a split has no accepted name yet, the last one of the splits before it."""
    accepted_row = F.when(is_accepted("new_name"), F.col("_row"))
    arrived = split.groupBy("_split", key).agg(
        F.max_by("new_name", accepted_row).alias("_arrived")
    )
    last_arrived = F.last("_arrived", ignorenulls=True).over(earlier_splits([key]))
    carry = arrived.select("_split", key, last_arrived.alias("_carried"))
    inside = _with_last_accepted(split, ["_split", key], ["_row"])
    return with_carry(inside, carry, [key]).withColumn(
        "_last", F.coalesce("_last", "_carried")
    )


def _audit(
    edits: DataFrame, names: DataFrame, key: str, order: Sequence[str]
) -> DataFrame:
    shown = F.coalesce("_last", "tag_name")
    accepted = F.coalesce(is_accepted("new_name"), F.lit(False))
    return edits.join(names, key).select(
        key,
        *order,
        "new_name",
        shown.alias("name_shown"),
        accepted.alias("accepted"),
        F.coalesce(accepted_or_null("new_name"), shown).alias("name_after"),
    )

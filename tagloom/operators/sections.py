"""Projections of tag records: titles, fields, sections, chips. All narrow."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import field_structs, section_structs, with_parts
from ..schema import KEY


def tag_titles(tags: DataFrame, key: str = KEY) -> DataFrame:
    return with_parts(tags).where("part = 0").select(key, "tag_name")


def tag_fields(tags: DataFrame, key: str = KEY) -> DataFrame:
    """Two (label, value) rows per tag."""
    return with_parts(tags).where("part = 0").select(key, F.inline(field_structs()))


def tag_sections(
    tags: DataFrame, labels: Iterable[str] | None = None, key: str = KEY
) -> DataFrame:
    """One row per tag and section, also where the list is empty or NULL.

    A list in several parts gives a row for each part that holds items; `first_item` is the
    place of the first of them in the whole list.
    """
    rows = with_parts(tags).select(
        key, "part", "parts", "first_item", F.inline(section_structs(labels))
    )
    return rows.where((F.col("part") == 0) | (F.size("items") > 0))


def tag_chips(
    tags: DataFrame, labels: Iterable[str] | None = None, key: str = KEY
) -> DataFrame:
    """One row per list item with its place (from 0); none for an empty or NULL list."""
    places = tag_sections(tags, labels, key).select(
        key, "first_item", "section_ord", "label", F.posexplode("items").alias("pos", "item")
    )
    item_pos = F.col("first_item") + F.col("pos")
    return places.select(key, "section_ord", "label", item_pos.alias("item_pos"), "item")


def tag_section_entries(
    tags: DataFrame, labels: Iterable[str] | None = None, key: str = KEY
) -> DataFrame:
    """One row per tag and section with the number of its items, however many rows hold them.

    The items are those of `tag_sections` with this key and label, in order of `first_item`. A
    NULL list has NULL items. Of lists in several rows only their sizes are shuffled.
    """
    rows = tag_sections(tags, labels, key).select(
        key, "parts", "section_ord", "label", F.size("items").cast("long").alias("n_items")
    )
    size = F.when(F.col("n_items") >= 0, F.col("n_items")).alias("n_items")
    in_one = rows.where("parts = 1").select(key, "section_ord", "label", size)
    going_on = rows.where("parts > 1").groupBy(key, "section_ord", "label")
    return in_one.unionByName(going_on.agg(F.sum(size).alias("n_items")))

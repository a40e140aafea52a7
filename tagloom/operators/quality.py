"""Data contracts: a required text property, unique items, and a literal text match."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import parsed_property, text_problem, with_parts
from ..schema import KEY
from . import sketch
from .sections import tag_sections
from .sketch import in_several_parts, passing


def prop_violations(df: DataFrame, prop: str, id_columns: Sequence[str]) -> DataFrame:
    """Rows whose column `prop` is absent (`missing`) or is not text (`wrong_type`)."""
    missing = F.col(prop).isNull()
    if isinstance(df.schema[prop].dataType, T.StringType):
        return df.where(missing).select(*id_columns, F.lit("missing").alias("violation"))
    problem = F.when(missing, "missing").otherwise("wrong_type")
    return df.select(*id_columns, problem.alias("violation"))


def json_prop_violations(
    df: DataFrame, json: str, prop: str, id_columns: Sequence[str]
) -> DataFrame:
    """The same check on a property of a JSON object held as text, which is parsed once.

    Rows without a violation are left out by an explode: a filter would be pushed below the
    parse and parse the text itself.
    """
    parsed = df.select(*id_columns, parsed_property(json, prop).alias("_parsed"))
    problem = F.array_compact(F.array(text_problem("_parsed", prop)))
    return parsed.select(*id_columns, F.explode(problem).alias("violation"))


# The filter of items in several parts is used while it stays sparse: a full one passes most items
# and costs two more readings.
FEW_ITEMS = sketch.BITS // 8


def duplicate_chip_keys(
    tags: DataFrame, labels: Iterable[str] | None = None, key: str = KEY
) -> DataFrame:
    """Items that occur more than once in a list, with count and first place.

    Each row counts its own items, so of lists in one row only duplicates are shuffled. Of lists
    that go on in other rows, all items are; while there are few of them, a filter of fixed size
    first drops those of one part only (each part of a record comes once). A stream keeps all
    of their items as state instead; `streaming.quality` keeps it in files.
    """
    if tags.isStreaming:
        sections = tag_sections(tags, labels, key).withColumn("goes_on", F.col("parts") > 1)
        counts = _placed(_item_counts(sections, key))
    else:
        counts = item_counts(tags, labels, key, lone_items=False)
    item = [key, "section_ord", "label", "item"]
    totals = counts.groupBy(*item).agg(
        F.sum("n").alias("n"), F.min("first_pos").alias("first_pos")
    )
    return totals.where(F.col("n") > 1)


def item_counts(
    tags: DataFrame,
    labels: Iterable[str] | None = None,
    key: str = KEY,
    lone_items: bool = True,
) -> DataFrame:
    """Counts `n` and places `first_pos`, to be summed up by item, of all items of lists in several
    parts and of those that occur more than once in a list of one row.

    Without `lone_items`, items that occur once may be left out.
    """
    sections = tag_sections(tags, labels, key).withColumn("goes_on", F.col("parts") > 1)
    if (with_parts(tags).agg(F.max("parts")).first()[0] or 1) <= 1:
        return _placed(_item_counts(sections, key))
    if not lone_items and _items_going_on(sections) <= FEW_ITEMS:
        return _placed(_without_lone_items(tags, _item_counts(sections, key), key))
    goes_on = F.coalesce("goes_on", F.lit(False))
    going_on = sections.where(goes_on).select(
        key, "first_item", "section_ord", "label", F.posexplode("items").alias("pos", "item")
    )
    whole = _item_counts(sections.where(~goes_on), key)
    single = going_on.withColumn("n", F.lit(1).cast("long"))
    return _placed(whole.select(*single.columns).unionByName(single))


def _items_going_on(sections: DataFrame) -> int:
    """How many items the lists in several parts hold."""
    size = F.greatest(F.size("items"), F.lit(0)).cast("long")
    return sections.where("goes_on").agg(F.sum(size)).first()[0] or 0


def _placed(counts: DataFrame) -> DataFrame:
    first_pos = (F.col("first_item") + F.col("pos")).alias("first_pos")
    place = ("part", "parts", "first_item", "pos")
    return counts.select(*(c for c in counts.columns if c not in place), first_pos)


def _without_lone_items(tags: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    most = with_parts(tags).agg(F.max("parts")).first()[0] or 1
    if most <= 1:
        return counts
    item = [key, "section_ord", "item"]
    going_on = counts.where(F.col("parts") > 1)
    bitmap = in_several_parts(going_on, item, "part", (most - 1).bit_length())
    return passing(counts, item, bitmap, or_if=F.col("n") > 1)


def duplicate_chip_keys_per_row(
    tags: DataFrame, labels: Iterable[str] | None = None, key: str = KEY
) -> DataFrame:
    """The same for records held in one row each, without a shuffle or streaming state.

    A record in several parts is an error: an item may come again in another of them.
    """
    whole = F.when(F.col("parts") > 1, F.raise_error(F.lit("a record in several parts")))
    sections = tag_sections(tags, labels, key).withColumn(
        "goes_on", F.coalesce(whole.cast("boolean"), F.lit(False))
    )
    first_pos = F.col("pos").cast("long").alias("first_pos")
    return _item_counts(sections, key).select(
        key, "section_ord", "label", "item", "n", first_pos
    )


def _item_counts(sections: DataFrame, key: str) -> DataFrame:
    """(item, n, pos) per row of `sections`: of repeated items, or of all if it `goes_on`.

    Sorting a list's (item, place) pairs puts equal items next to each other, so an
    item's count is the distance to where the next one starts.
    """
    size = F.size("items")
    worth = F.col("goes_on") | ((size > 1) & (size > F.size(F.array_distinct("items"))))
    pairs = F.transform("items", lambda item, i: F.struct(item.alias("item"), i.alias("pos")))
    ranked = sections.where(worth).withColumn("ranked", F.sort_array(pairs))

    def numbered(pair, i):
        return F.struct(pair["item"].alias("item"), pair["pos"].alias("pos"), i.alias("at"))

    def starts(pair):
        # element_at counts from 1, so `at` itself addresses the pair before.
        before = F.element_at("ranked", F.greatest(pair["at"], F.lit(1)))["item"]
        return (pair["at"] == 0) | ~pair["item"].eqNullSafe(before)

    firsts = ranked.withColumn("firsts", F.filter(F.transform("ranked", numbered), starts))

    def counted(first, i):
        end = F.coalesce(F.get("firsts", i + 1)["at"], F.size("ranked"))
        n = (end - first["at"]).cast("long")
        return F.struct(first["item"].alias("item"), n.alias("n"), first["pos"].alias("pos"))

    wanted = F.filter(F.transform("firsts", counted), lambda c: F.col("goes_on") | (c["n"] > 1))
    return firsts.select(
        key, "part", "parts", "first_item", "section_ord", "label", F.inline(wanted)
    )


def text_contains(df: DataFrame, column: str, needle: str) -> DataFrame:
    """Rows whose text contains the literal `needle`, case-sensitive."""
    return df.where(F.contains(F.col(column), F.lit(needle)))

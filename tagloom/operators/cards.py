"""Whole records as output: one JSON document per row, files of them, and the views
that show the same current record in several places."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import with_parts
from ..schema import FIELDS, KEY, ORDER, SECTIONS
from .renames import current_tags
from .sections import tag_chips, tag_fields, tag_sections, tag_titles


def tag_cards(tags: DataFrame, key: str = KEY, keep: Sequence[str] = ()) -> DataFrame:
    """(key, part, *keep, card): title, labelled fields and labelled sections as JSON.

    A card says itself whose it is and which part of how many, so that a file of cards is
    whole without any other column. `keep` names columns to carry along, as to partition by.
    """
    card = F.struct(
        F.col(key).alias(key),
        "part",
        "parts",
        "first_item",
        F.col("tag_name").alias("title"),
        F.struct(*(F.col(column).alias(label) for label, column in FIELDS)).alias("fields"),
        F.struct(*(F.col(column).alias(label) for label, column in SECTIONS)).alias("sections"),
    )
    text = F.to_json(card, {"ignoreNullFields": "false"}).alias("card")
    return with_parts(tags).select(key, "part", *keep, text)


def write_cards(
    cards: DataFrame,
    path: str,
    fmt: str = "json",
    partition_by: Sequence[str] = (),
    mode: str = "errorifexists",
) -> None:
    """Writes cards as JSON lines (one document per line) or as a Parquet table.

    With `partition_by`, rows are first evened out by those columns, so that a partition
    gets few files and a large one still gets several tasks. Only adaptive execution can
    do so; without it, as in a stateful stream, each task writes the rows it has.
    """
    if fmt not in ("json", "parquet"):
        raise ValueError(f"cards are written as json or parquet, not {fmt}")
    if fmt == "json":
        cards = cards.select("card", *partition_by)
    adaptive = cards.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    if partition_by and adaptive:
        cards = cards.hint("rebalance", *partition_by)
    writer = cards.write.mode(mode).partitionBy(*partition_by)
    writer.text(path) if fmt == "json" else writer.parquet(path)


def tag_outputs(tags: DataFrame, key: str = KEY) -> dict[str, DataFrame]:
    """All views of the same records."""
    return {
        "titles": tag_titles(tags, key),
        "fields": tag_fields(tags, key),
        "sections": tag_sections(tags, key=key),
        "chips": tag_chips(tags, key=key),
    }


def current_tag_outputs(
    tags: DataFrame, commands: DataFrame, key: str = KEY, order: Sequence[str] = ORDER
) -> dict[str, DataFrame]:
    """All views after the commands. The name reaches titles and fields together.

    Each view is a plan of its own over the same records. To work these out once, write
    `current_tags` and pass what you read back to `tag_outputs`, or take `tag_lines`, which
    holds all views in one pass.
    """
    return tag_outputs(current_tags(tags, commands, key, order), key)


# Every line of output: the view it belongs to, its place and label, and the one column it reads.
LINES = (
    ("title", 0, "", "tag_name"),
    *(("field", i, label, column) for i, (label, column) in enumerate(FIELDS)),
    *(("section", i, label, column) for i, (label, column) in enumerate(SECTIONS)),
)


def lines_reading(columns: Sequence[str]) -> list[tuple[str, int, str, str]]:
    return [line for line in LINES if line[3] in columns]


def tag_lines(
    tags: DataFrame,
    key: str = KEY,
    reading: Sequence[str] | None = None,
    not_reading: Sequence[str] = (),
) -> DataFrame:
    """All views as lines of one table, made in one pass over the records.

    `output` is title, field or section, `ord` and `label` place the line on the card and
    `pos` its value in the list. An empty section is one line with `pos` -1 and no value.
    With `reading` or `not_reading` only the lines that do or do not show these columns.
    """
    lines = [
        line
        for line in LINES
        if (reading is None or line[3] in reading) and line[3] not in not_reading
    ]

    def block(output, ord_, label, column):
        items = F.col(column) if output == "section" else F.array(column)
        return F.struct(
            F.lit(output).alias("output"),
            F.lit(ord_).alias("ord"),
            F.lit(label).alias("label"),
            items.alias("items"),
        )

    blocks = with_parts(tags).select(
        key, "part", "first_item", F.inline(F.array(*(block(*line) for line in lines)))
    )
    continued = (F.col("output") == "section") & (F.size("items") > 0)
    shown = blocks.where((F.col("part") == 0) | continued).select(
        key,
        "first_item",
        "output",
        "ord",
        "label",
        F.posexplode_outer("items").alias("at", "value"),
    )
    pos = F.coalesce(F.col("first_item") + F.col("at"), F.lit(-1))
    return shown.select(key, "output", "ord", "label", pos.cast("long").alias("pos"), "value")


def line_changes(changes: DataFrame, columns: Sequence[str], key: str = KEY) -> DataFrame:
    """The lines that a change of `columns` takes back (`change` -1) and puts in place (1).

    `changes` has, per tag, old_<column> and new_<column> of each. Columns are those that hold
    one value; lines that read others are not touched, and neither are those that stay alike.
    """
    lists = {column for _, column in SECTIONS}
    if lists & set(columns):
        raise ValueError(f"lists do not change by renames: {sorted(lists & set(columns))}")

    def both(output, ord_, label, column):
        return F.struct(
            F.lit(output).alias("output"),
            F.lit(ord_).alias("ord"),
            F.lit(label).alias("label"),
            F.lit(0).cast("long").alias("pos"),
            F.col(f"old_{column}").alias("old"),
            F.col(f"new_{column}").alias("new"),
        )

    lines = changes.select(key, F.inline(F.array(*(both(*n) for n in lines_reading(columns)))))

    def one(value, change):
        return F.struct(F.col(value).alias("value"), F.lit(change).alias("change"))

    return lines.where(~F.col("old").eqNullSafe(F.col("new"))).select(
        key, "output", "ord", "label", "pos", F.inline(F.array(one("old", -1), one("new", 1)))
    )

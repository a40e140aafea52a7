"""Column expressions shared by batch and streaming operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import FIELDS, PARTS, SECTIONS


_STRICT = {"allowSingleQuotes": "false", "maxStringLen": str(2**31 - 1)}


def with_parts(tags: DataFrame) -> DataFrame:
    """Tables without any of the columns that describe parts hold each record in one row."""
    there = [c for c in PARTS if c in tags.columns]
    if there and len(there) < len(PARTS):
        raise ValueError(f"records in parts need the columns {', '.join(PARTS)}")
    if there:
        return tags
    return tags.withColumns(
        {"part": F.lit(0), "parts": F.lit(1), "first_item": F.lit(0).cast("long")}
    )


def field_structs() -> Column:
    """array<struct<field_ord, label, value>>, in display order."""
    return F.array(
        *(
            F.struct(
                F.lit(i).alias("field_ord"),
                F.lit(label).alias("label"),
                F.col(column).alias("value"),
            )
            for i, (label, column) in enumerate(FIELDS)
        )
    )


def section_structs(labels: Iterable[str] | None = None) -> Column:
    """array<struct<section_ord, label, items>>, in display order.

    Only the columns of the wanted `labels` are mentioned, so a scan reads no others.
    """
    wanted = {label for label, _ in SECTIONS} if labels is None else set(labels)
    unknown = wanted - {label for label, _ in SECTIONS}
    if unknown:
        raise ValueError(f"no such section: {sorted(unknown)}")
    return F.array(
        *(
            F.struct(
                F.lit(i).alias("section_ord"),
                F.lit(label).alias("label"),
                F.col(column).alias("items"),
            )
            for i, (label, column) in enumerate(SECTIONS)
            if label in wanted
        )
    )


def is_accepted(name: str) -> Column:
    """A name that is neither cancelled (NULL) nor empty; blanks and '0' are names."""
    return F.col(name) != ""


def accepted_or_null(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(""))


_CORRUPT = "_corrupt"


def parsed_property(json: str, prop: str) -> Column:
    """One parse of a JSON object: its property as a variant, and the text of rows that did not
    make one.

    Only the one property becomes a variant, so the rest of the object may be large or
    name a property twice; of `prop` itself the last one counts.
    """
    kinds = [T.StructField(prop, T.VariantType()), T.StructField(_CORRUPT, T.StringType())]
    return F.from_json(json, T.StructType(kinds), _STRICT | {"columnNameOfCorruptRecord": _CORRUPT})


def text_problem(parsed: str, prop: str) -> Column:
    """NULL where a `parsed_property` is text, else what is wrong with it."""
    found = F.schema_of_variant(F.col(parsed)[prop])
    rest = F.col(parsed)[_CORRUPT]

    def read_as(kind: T.DataType) -> Column:
        return F.from_json(rest, T.StructType([T.StructField(prop, kind)]), _STRICT)[prop]

    # Few rows come so far: text that is no JSON object, and what a variant cannot hold (text
    # beyond its size limit, objects that repeat a property inside). These are told apart by
    # what else the property can be read as: an object as a map, a list as an array. Text can be
    # read as neither, whatever it begins with.
    unheld = read_as(T.StringType())
    nested = F.coalesce(
        read_as(T.MapType(T.StringType(), T.StringType())).isNotNull()
        | read_as(T.ArrayType(T.StringType())).isNotNull(),
        F.lit(False),
    )
    return (
        F.when(found.isNotNull(), F.when(found != "STRING", "wrong_type"))
        .when(rest.isNull(), "missing")
        .when(unheld.isNull(), "missing")
        .when(nested, "wrong_type")
    )

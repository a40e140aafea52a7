"""Licence scan: ordered signature rules, all in Spark's own expressions.

A text becomes its lower-cased words joined by single spaces. Rules whose keyword a text holds
(and only texts with a general mark are looked at) are matched as regular expressions on whole
words; every match is an interval with the rule's priority. Intervals that lie within another
one, and the later rule of two that overlap, are suppressed. Three base phrases are counted
apart and always label a text.

No row leaves its task: the rules are a constant array and are applied row by row.

Defined results: NULL and empty texts have no word, no place and score 0; repeated rows give
repeated rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.license_rules import RULES

# Phrases that always count, with their labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_GROUP = re.compile(r"\([^()]*\)\??")


def _always(regex: str) -> str:
    """What is left without groups, as these may be optional or have alternatives."""
    while (less := _GROUP.sub("|", regex)) != regex:
        regex = less
    return regex


# Texts without any of these are not matched against rules at all: every rule that can match
# without "licen", by any of its alternatives, has its keyword here.
MARKS = sorted({"licen"} | {key for _, key, regex in RULES if "licen" not in _always(regex)})


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _places(words: Column) -> Column:
    """Words cut before each base phrase: the first piece ends where the first phrase begins."""
    phrases = "|".join(BASE_PHRASES)
    return F.split(F.concat(F.lit("^ "), words, F.lit(" ")), f"(?= (?:{phrases}) )", -1)


def _matches(padded: Column, rule: Column) -> Column:
    """Intervals (start, end, in characters) of one rule's matches."""
    regex = F.concat(F.lit("(?<= )(?:"), rule["regex"], F.lit(")(?= )"))
    found = F.regexp_extract_all(padded, regex, F.lit(0))

    def intervals(hits: Column) -> Column:
        # from the end of one match to the end of the next
        steps = F.zip_with(
            F.slice(F.split(padded, regex, -1), 1, F.size(hits)),
            hits,
            lambda piece, hit: F.length(piece) + F.length(hit),
        )

        def span(hit: Column, end: Column) -> Column:
            return F.struct(
                (end - F.length(hit)).alias("start"),
                end.alias("end"),
                rule["priority"].alias("priority"),
                rule["label"].alias("label"),
                (F.lit(1) + _spaces(hit)).alias("words"),
            )

        return F.zip_with(hits, _running_sums(steps), span).cast(_SPANS)

    return _with(found, intervals)


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) where the value is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


# Arrays are built up in runs of so many elements, because each step of an aggregate copies what
# it has built so far; so the work follows the number of elements.
_RUN = 64


def _runs(values: Column) -> Column:
    """The array cut into arrays of _RUN elements."""

    def cut(values: Column) -> Column:
        count = F.ceil(F.size(values) / _RUN).cast("int")
        numbers = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(
            F.array().cast("array<int>")
        )
        return F.transform(numbers, lambda run: F.slice(values, run * _RUN + 1, F.lit(_RUN)))

    return _with(values, cut)


def _sums(values: Column) -> Column:
    """Running sums of a short array."""

    def add(acc: Column, value: Column) -> Column:
        total = acc["total"] + value
        return F.struct(
            total.alias("total"), F.concat(acc["sums"], F.array(total)).alias("sums")
        )

    start = F.struct(F.lit(0).alias("total"), F.array().cast("array<int>").alias("sums"))
    return F.aggregate(values, start, add, lambda acc: acc["sums"])


def _running_sums(values: Column) -> Column:
    def put_together(runs: Column) -> Column:
        totals = F.transform(runs, lambda run: F.element_at(run, -1))
        return F.flatten(
            F.zip_with(
                runs,
                _sums(totals),
                lambda run, end: F.transform(run, lambda v: v + end - F.element_at(run, -1)),
            )
        )

    return _with(F.transform(_runs(values), _sums), put_together)


_SPANS = "array<struct<start:int,end:int,priority:int,label:string,words:int>>"


def _kept(spans: Column) -> Column:
    """Intervals left after containment, then priority among those that overlap."""
    first = F.array_sort(
        spans,
        lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"])
        .when(a["end"] != b["end"], b["end"] - a["end"])
        .otherwise(a["priority"] - b["priority"]),
    )

    def add(kept: Column, span: Column) -> Column:
        last = F.element_at(kept, -1)
        alone = F.concat(kept, F.array(span))
        return (
            F.when(F.size(kept) == 0, alone)
            .when(span["start"] >= last["end"], alone)
            .when(span["end"] <= last["end"], kept)
            .when(last["priority"] <= span["priority"], kept)
            .otherwise(F.concat(F.slice(kept, 1, F.size(kept) - 1), F.array(span)))
        )

    def add_run(acc: Column, run: Column) -> Column:
        # only the last interval kept so far can still be replaced
        kept = F.aggregate(run, acc["open"], add)
        done = F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))
        return F.struct(
            F.concat(acc["done"], F.array(done)).cast(f"array<{_SPANS}>").alias("done"),
            F.slice(kept, F.greatest(F.size(kept), F.lit(1)), F.lit(1)).cast(_SPANS).alias("open"),
        )

    start = F.struct(
        F.array().cast(f"array<{_SPANS}>").alias("done"), F.array().cast(_SPANS).alias("open")
    )
    return F.aggregate(
        _runs(first), start, add_run, lambda acc: F.concat(F.flatten(acc["done"]), acc["open"])
    )


def _rules() -> Column:
    return F.array(
        *(
            F.struct(
                F.lit(number).alias("priority"),
                F.lit(label).alias("label"),
                F.lit(keyword).alias("keyword"),
                F.lit(regex).alias("regex"),
            )
            for number, (label, keyword, regex) in enumerate(RULES)
        )
    )


def license_spans(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, and for marked texts the joined `words`, `places` and kept `spans`."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    joined = F.trim(F.regexp_replace(text, _NOT_WORD, " "))
    rows = docs.select("doc_id", joined.alias("_joined"))
    marked = reduce(lambda a, b: a | b, (F.contains("_lower", F.lit(m)) for m in MARKS))
    rows = rows.withColumn("_lower", F.lower("_joined")).select(
        "doc_id",
        F.when(F.length("_joined") == 0, 0)
        .otherwise(_spaces(F.col("_joined")) + 1)
        .cast("long")
        .alias("n_words"),
        F.when(marked, F.translate("_joined", _UPPER, _UPPER.lower())).alias("words"),
    )
    padded = F.concat(F.lit(" "), F.col("words"), F.lit(" "))
    found = F.flatten(
        F.transform(
            F.filter(_rules(), lambda r: F.contains(F.col("words"), r["keyword"])),
            lambda r: _matches(padded, r),
        )
    )
    return rows.withColumn("spans", F.when(F.col("words").isNotNull(), _kept(found))).withColumn(
        "places", F.when(F.contains("words", F.lit("license")), _places(F.col("words")))
    )


def license_labels(docs: DataFrame) -> DataFrame:
    """The contract's row per document."""
    rows = license_spans(docs)
    n_base = F.coalesce(F.size("places") - 1, F.lit(0))
    after = F.element_at("places", -1)
    present = [
        F.when(F.contains(F.concat(F.lit(" "), F.col("words"), F.lit(" ")), F.lit(f" {p} ")), label)
        for p, label in BASE_PHRASES.items()
    ]
    base = F.when(F.col("n_base") > 0, F.array_compact(F.array(*present))).otherwise(
        F.array().cast("array<string>")
    )
    longest = F.coalesce(
        F.array_max(F.transform("spans", lambda s: s["words"])), F.when(F.col("n_base") > 0, 2)
    )
    return (
        rows.withColumn("n_base", n_base.cast("long"))
        .withColumn("_base", base)
        .withColumn(
            "_all",
            F.array_union(
                "_base",
                F.coalesce(
                    F.transform("spans", lambda s: s["label"]), F.array().cast("array<string>")
                ),
            ),
        )
        .select(
            "doc_id",
            "n_words",
            "n_base",
            F.when(F.col("n_base") > 0, _spaces(F.element_at("places", 1)))
            .cast("long").alias("first_word"),
            F.when(F.col("n_base") > 0, F.col("n_words") - _spaces(after) + 1)
            .cast("long").alias("last_word"),
            F.array_join(F.sort_array(F.array_distinct("_base")), ",").alias("base_labels"),
            F.array_join(F.sort_array(F.array_distinct("_all")), ",").alias("labels"),
            F.coalesce(1 - 1 / (1.0 + longest), F.lit(0.0)).cast("double").alias("score"),
        )
    )

"""Bounded samples of labelled rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_STEPS = 1 << 30


def balanced_sample(rows: DataFrame, label: str, per_label: int) -> DataFrame | None:
    """At most `per_label` rows of each label, the first by a hash of id and text.

    The classes are counted first; a cut on the hash then leaves about twice the wanted rows
    of each, so that only these are sorted. None without any row.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    if not counts:
        return None
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(_STEPS))
    below = reduce(
        lambda a, b: a | b,
        (
            (F.col(label) == value) & (place < int(min(1.0, (2 * per_label + 20) / n) * _STEPS))
            for value, n in counts.items()
        ),
    )
    order = Window.partitionBy(label).orderBy(place, "doc_id", "text")
    return (
        rows.where(below)
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= per_label)
        .drop("_rank")
    )

"""Duplicate items over a stream of tag records."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quality import item_counts
from ..schema import KEY
from .batches import read_batch, save_state, state_before, write_batch


def duplicate_counts(
    state: str, out: str, labels: Iterable[str] | None = None, key: str = KEY
) -> Callable[[DataFrame, int], None]:
    """For a stream of tags: of the items that a batch brings, those that are now duplicates.

    What `duplicate_chip_keys` gives on a stream in update mode. State is one row per item of a
    list in several parts, in files instead of executor memory: count and first place so far,
    and whether the batch brought it.
    """

    def on_batch(tags: DataFrame, batch_id: int) -> None:
        spark = tags.sparkSession
        now = item_counts(tags, labels, key).withColumn("brought", F.lit(True))
        earlier = state_before(spark, state, batch_id, now.schema)
        items = earlier.withColumn("brought", F.lit(False)).unionByName(now)
        after = items.groupBy(key, "section_ord", "label", "item").agg(
            F.sum("n").alias("n"),
            F.min("first_pos").alias("first_pos"),
            F.max("brought").alias("brought"),
        )
        save_state(after, state, batch_id)
        found = read_batch(spark, state, batch_id).where("brought and n > 1").drop("brought")
        write_batch(found, out, batch_id)

    return on_batch

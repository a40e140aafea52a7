"""Filters of document ids and of hashes, of fixed size, for tasks that read texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTER_BITS = 1 << 26  # 8 MB to every task
_U = np.uint64


class IdFilter:
    """A fixed-size filter of ids: passes all ids it was built from, and few others while they
    are fewer than its bits. Beyond that it passes more, which costs time but no result."""

    def __init__(self, ids: DataFrame, column: str):
        bit = bit_of(column)
        rows = (
            ids.select(bit.alias("bit"))
            .groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
            .collect()
        )
        self.bits = np.zeros(FILTER_BITS // 8, np.uint8)
        for row in rows:
            part = np.frombuffer(row["bits"], np.uint8)
            at = (row["bucket"] - 1) * len(part)
            self.bits[at : at + len(part)] = part

    def passes(self, bit: np.ndarray) -> np.ndarray:
        return (self.bits[bit >> 3] >> (bit & 7)) & 1 == 1


class Members:
    """A filter of keys: passes all it was built from, and few others while they are few."""

    def __init__(self, keys: DataFrame):
        n = keys.count()
        self.shifts = (0, 19, 38)[: max(1, min(3, round(0.7 * FILTER_BITS / max(1, n))))]
        bits = (F.shiftright("key", by).bitwiseAND(FILTER_BITS - 1) + 1 for by in self.shifts)
        rows = (
            keys.select(F.explode(F.array(*bits)).alias("bit"))
            .groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
            .collect()
        )
        self.bits = np.zeros(FILTER_BITS // 8, np.uint8)
        for row in rows:
            part = np.frombuffer(row["bits"], np.uint8)
            at = (row["bucket"] - 1) * len(part)
            self.bits[at : at + len(part)] = part

    def passes(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for by in self.shifts:
            bit = ((keys >> _U(by)) & _U(FILTER_BITS - 1)).astype(np.int64)
            out &= (self.bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
        return out


def bit_of(column: str):
    # bit numbers from 1, as the bitmap functions count them
    return F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(FILTER_BITS)) + 1


def with_bit(docs: DataFrame) -> DataFrame:
    return docs.withColumn("bit", bit_of("doc_id"))


def chosen(batches, members: IdFilter):
    """The rows of batches with a column `bit` that the filter passes."""
    for batch in batches:
        good = members.passes(batch.column("bit").to_numpy() - 1)
        yield batch.filter(pa.array(good, pa.bool_()))

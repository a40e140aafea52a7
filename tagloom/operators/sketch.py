"""A filter of what occurs in more than one part, of fixed size and exact on one side.

Two different parts differ in some binary digit of their numbers. For each digit, one bitmap
holds the values of the parts where it is 0 and one those where it is 1; a value of two parts is
in both of some digit. So all values that occur in several parts pass, and few others while the
bitmaps are not full. Bitmaps are built in the tasks: their size and not the number of values
is what is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 23  # 1 MB, for each digit twice


def _bit(columns: list[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(bits)) + 1


def in_several_parts(
    values: DataFrame, columns: list[str], part: str, digits: int, bits: int = BITS
) -> DataFrame:
    """(bucket, bits): a bitmap of the values of `columns` that come in several parts, a row per
    bucket. At most 2 x `digits` bitmaps reach the driver, whatever the number of values."""
    number = F.explode(F.sequence(F.lit(0), F.lit(digits - 1)))
    told = values.select(_bit(columns, bits).alias("bit"), F.col(part).alias("part"), number.alias("digit"))
    side = F.call_function("shiftright", "part", "digit").bitwiseAND(1)
    rows = (
        told.groupBy(
            "digit",
            side.alias("side"),
            F.bitmap_bucket_number("bit").alias("bucket"),
        )
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
        .collect()
    )
    sides = {(r["digit"], r["bucket"], r["side"]): int.from_bytes(r["bits"], "big") for r in rows}
    found: dict[int, int] = {}
    for (digit, bucket, side), held in sides.items():
        if not side:
            both = held & sides.get((digit, bucket, 1), 0)
            found[bucket] = found.get(bucket, 0) | both
    size = len(rows[0]["bits"]) if rows else 0
    return values.sparkSession.createDataFrame(
        [(b, bytearray(v.to_bytes(size, "big"))) for b, v in found.items() if v],
        "_bucket bigint, _bits binary",
    )


def passing(
    values: DataFrame, columns: list[str], bitmap: DataFrame, or_if: Column, bits: int = BITS
) -> DataFrame:
    """The rows of `values` that the bitmap passes, or for which `or_if` holds."""
    bit = _bit(columns, bits)
    place = F.bitmap_bit_position(bit)
    byte = F.substring("_bits", F.shiftright(place, 3).cast("int") + 1, 1)
    mask = F.call_function("shiftleft", F.lit(1), (place % 8).cast("int"))
    has = F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(mask) != 0
    # as few rows as the bitmap has buckets
    return (
        values.join(F.broadcast(bitmap), F.bitmap_bucket_number(bit) == F.col("_bucket"), "left")
        .where(or_if | F.coalesce(has, F.lit(False)))
        .drop("_bucket", "_bits")
    )

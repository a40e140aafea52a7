"""A skipping index for literal search in stored texts.

Beside the files lies a filter of fixed size per file: bits of all runs of three characters in
its texts. A search opens only files whose filter has every run of the needle. A filter that is
nearly full passes its file, which costs time and no result; a needle of under three characters
has no run and passes all; a file that is new or was written anew since is always read.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAM = 3
FILTER_BITS = 1 << 18  # 32 KB a file
_FILE = ("file", "size", "modified")


def write_text_index(
    spark: SparkSession, path: str, column: str, index_path: str, fmt: str = "parquet"
) -> None:
    """Reads the texts once and writes a row per file: which file it was and its filter."""
    rows = spark.read.format(fmt).load(path).select(column, *_identity())
    bits = rows.select(*_FILE, F.explode_outer(F.array_distinct(gram_bits(F.col(column)))))
    # Distinct bits first, combined in the task: a file has no more than its filter.
    parts = (
        bits.withColumnRenamed("col", "bit")
        .distinct()
        .groupBy(*_FILE, F.bitmap_bucket_number("bit").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    )
    part = F.when(F.col("bucket").isNotNull(), F.struct("bucket", "bits"))
    parts.groupBy(*_FILE).agg(F.collect_list(part).alias("filter")).write.parquet(index_path)


def indexed_text_contains(
    spark: SparkSession,
    path: str,
    column: str,
    needle: str,
    index_path: str,
    fmt: str = "parquet",
) -> DataFrame:
    """Rows whose text contains the literal `needle`, from the files that can hold it."""
    table = spark.read.format(fmt).load(path)
    files = files_to_search(spark, path, needle, index_path)
    if not files:
        return table.limit(0)
    found = spark.read.schema(table.schema).format(fmt).load(files)
    return found.where(F.contains(F.col(column), F.lit(needle)))


def files_to_search(spark: SparkSession, path: str, needle: str, index_path: str) -> list[str]:
    """The files under `path` that the index does not rule out, one name each."""
    listed = spark.read.format("binaryFile").load(path).select(*_identity())
    bits = sorted(
        spark.range(1).select(F.array_distinct(gram_bits(F.lit(needle)))).first()[0]
    )
    if bits:
        wanted = F.array(*(F.lit(b).cast("long") for b in bits))
        missing = F.exists(wanted, lambda bit: ~_has_bit(F.col("filter"), bit))
        ruled_out = spark.read.parquet(index_path).where(missing).select(*_FILE)
        listed = listed.join(ruled_out, list(_FILE), "left_anti")
    return sorted(unquote(r["file"]) for r in listed.select("file").collect())


def gram_bits(text: Column) -> Column:
    """The filter's bit, from 1, of every run of GRAM characters."""

    def bits(characters: Column) -> Column:
        last = F.size(characters) - GRAM
        runs = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(
            runs,
            lambda i: F.pmod(
                F.xxhash64(*(F.get(characters, i + j) for j in range(GRAM))), F.lit(FILTER_BITS)
            )
            + 1,
        )

    # Inside a function of the array the text is split once; named outside, once per run.
    split = F.coalesce(F.split(text, ""), F.array().cast("array<string>"))
    return F.element_at(F.transform(F.array(split), bits), 1)


def _identity() -> list[Column]:
    return [
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    ]


def _has_bit(parts: Column, bit: Column) -> Column:
    """Whether the filter, an array of (bucket, bits), has this bit."""
    place = F.bitmap_bit_position(bit)

    def holds(part: Column) -> Column:
        byte = F.substring(part["bits"], F.call_function("div", place, F.lit(8)).cast("int") + 1, 1)
        value = F.conv(F.hex(byte), 16, 10).cast("int")
        mask = F.call_function("shiftleft", F.lit(1), (place % 8).cast("int"))
        return (part["bucket"] == F.bitmap_bucket_number(bit)) & (
            value.bitwiseAND(mask) != 0
        )

    return F.exists(parts, holds)

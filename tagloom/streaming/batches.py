"""Micro-batch results and state as numbered Parquet folders.

A batch that is played again after a failure overwrites its own folders and reads only
the state of the batch before, so it gives the same answer. The folders belong to one
query checkpoint: Spark numbers a query's batches 0, 1, 2, ... without gaps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_folder

# Under the state: the hot rows of the batch at work, dropped when it is done.
SPLITS = "splits"


def write_batch(df: DataFrame, root: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(_folder(root, batch_id))


def batch_files(out: str) -> Callable[[DataFrame, int], None]:
    """For any stream: its rows as a folder per batch, written anew if played again."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, out, batch_id)

    return on_batch


def read_batch(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    return spark.read.parquet(_folder(root, batch_id))


def all_batches(spark: SparkSession, root: str) -> DataFrame:
    """The results of all batches, for outputs that each batch adds to."""
    return spark.read.parquet(root).drop("batch_id")


def batches_before(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    """The results of earlier batches: what a batch that is played again may read."""
    return spark.read.parquet(root).where(F.col("batch_id") < batch_id).drop("batch_id")


def last_batch(spark: SparkSession, root: str) -> DataFrame:
    """The newest result, for outputs that each batch writes whole."""
    newest = spark.read.parquet(root).agg(F.max("batch_id")).first()[0]
    return read_batch(spark, root, newest)


def newest_per_key(spark: SparkSession, root: str, *keys: str) -> DataFrame:
    """The rows of each key's newest batch, for outputs that each batch adds changed keys to."""
    rows = spark.read.parquet(root)
    newest = rows.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(
        F.max("batch_id").alias("_newest")
    )
    match = F.col("batch_id") == F.col("_newest")
    for key in keys:
        match &= F.col(key).eqNullSafe(F.col(f"_{key}"))
    return rows.join(newest, match).select(*(c for c in rows.columns if c != "batch_id"))


def net_rows(changes: DataFrame) -> DataFrame:
    """What is left of rows that were added (`change` 1) and taken back (`change` -1)."""
    columns = [c for c in changes.columns if c != "change"]
    left = changes.groupBy(*columns).agg(F.sum("change").cast("int").alias("_left"))
    copies = F.explode(F.array_repeat(F.lit(0), F.col("_left")))
    return left.where("_left > 0").select(*columns, copies.alias("_copy")).drop("_copy")


def changed_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """`change` -1 for rows that are only in `before`, 1 for those only in `after`."""
    both = after.withColumn("change", F.lit(1)).unionByName(
        before.withColumn("change", F.lit(-1))
    )
    told = both.groupBy(*after.columns).agg(F.sum("change").cast("int").alias("_left"))
    copies = F.explode(F.array_repeat(F.signum("_left").cast("int"), F.abs("_left")))
    return told.where("_left != 0").select(*after.columns, copies.alias("change"))


def save_state(state: DataFrame, root: str, batch_id: int) -> None:
    """Writes the state after a batch whole; `state_before` of the next batch reads it.

    A batch starts when the one before it is done for good, so older states can go.
    """
    write_batch(state, root, batch_id)
    if batch_id > 1:
        drop_folder(state.sparkSession, _folder(root, batch_id - 2))


def state_before(
    spark: SparkSession, root: str, batch_id: int, schema: T.StructType
) -> DataFrame:
    """The state that the batch before this one saved, none for the first."""
    if not batch_id:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(_folder(root, batch_id - 1))


def run_available(
    stream: DataFrame,
    on_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
) -> None:
    """Processes what the sources hold now, batch by batch, and returns."""
    (
        stream.writeStream.foreachBatch(on_batch)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _folder(root: str, batch_id: int) -> str:
    return f"{root}/batch_id={batch_id}"

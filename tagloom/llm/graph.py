"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tagloom.session import drop_folder, scratch_path


# Rows are texts and sets here, so a Python task takes fewer at a time.
SMALL_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}
# What a step shuffled is of no use once its result is written.
_OF_A_STEP = SMALL_BATCHES | {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]):
    """Session settings that hold inside, and are as before afterwards."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def step_settings(spark: SparkSession):
    return settings(spark, _OF_A_STEP)


# The folders of the operator at work, which `workspace` drops.
_folders: ContextVar[list[str] | None] = ContextVar("folders", default=None)


@contextmanager
def workspace(spark: SparkSession):
    """Drops the tables that were `stored` inside, but for the result.

    Yields a function that stores the result; its table belongs to whoever is around.
    """
    around, own = _folders.get(), []
    token = _folders.set(own)

    def keep(frame: DataFrame) -> DataFrame:
        out = stored(frame, "result")
        kept = own.pop()
        if around is not None:
            around.append(kept)
        return out

    try:
        yield keep
    finally:
        _folders.reset(token)
        for folder in own:
            drop_folder(spark, folder)


def _new_folder(spark: SparkSession, purpose: str) -> str:
    path = scratch_path(spark, purpose)
    if (own := _folders.get()) is not None:
        own.append(path)
    return path


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The rows written under the shared folder and read again: plan and lineage end here."""
    spark = frame.sparkSession
    path = _new_folder(spark, purpose)
    with step_settings(spark):
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def drop(*frames: DataFrame) -> None:
    """Deletes the tables that `stored` returned, when nothing reads them any more."""
    for frame in frames:
        for folder in {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
            drop_folder(frame.sparkSession, folder)


def components(edges: DataFrame, most: int = 40) -> DataFrame:
    """node and component (its smallest node) for all nodes of edges (a, b).

    Rounds of large-star and small-star: each round ties every node to the smallest one in
    its neighbourhood, which keeps the components and takes a number of rounds that grows
    with the logarithm of their size. A hub's edges are aggregated before they are joined.
    """
    spark = edges.sparkSession
    edges, path, last = _clean(edges.select("a", "b")), None, None
    for _ in range(most):
        told, new = Observation(), _new_folder(spark, "edges")
        edges = edges.observe(
            told, F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % 1_000_003).alias("mark")
        )
        with step_settings(spark):
            edges.write.parquet(new)
        edges = spark.read.schema("a bigint, b bigint").parquet(new)
        if path:
            drop_folder(spark, path)
        path, state = new, told.get
        if state == last or not state["n"]:
            break
        last = state
        edges = _clean(_star(_star(edges, True), False))
    else:
        raise RuntimeError(f"no end after {most} rounds")
    # now every edge leads from a node to the smallest node of its component
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _clean(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger to the smaller node."""
    return (
        edges.where("a != b")
        .select(
            F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")
        )
        .distinct()
    )


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Ties neighbours to the smallest node around u: the larger ones, or u and the smaller ones.

    Edges come and go from the larger to the smaller node.
    """
    ways = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        ways = ways.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = ways.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    tied = ways.join(least, "u")
    if large:
        return tied.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return (
        tied.select(F.col("v").alias("a"), F.col("m").alias("b"))
        .where("a != b")
        .unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    )

"""A corpus pipeline: stages (name, function) that each take (spark, docs, sf_dir).

All stages but the last return the columns of `documents`; the last one says where each kept
document goes in training sequences. Results are written under the shared folder and read
again, so a stage starts from stored rows whatever happened to the executors of the one before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagloom.llm import decontaminate, jaccard_join, language_id, packing, secret_scan
from tagloom.llm.graph import SMALL_BATCHES, settings
from tagloom.session import drop_folder, scratch_path



def _take_small_batches(spark: SparkSession) -> None:
    """Rows are whole texts here, so tasks in Python take fewer of them at a time.

    What a stage returns is worked out when it is written, so these settings have to last until
    then; `run` puts back what they were.
    """
    for key, value in SMALL_BATCHES.items():
        spark.conf.set(key, value)


def language_identification(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, and those that no language clearly wins, go."""
    _take_small_batches(spark)
    return language_id.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones stays: the least doc_id."""
    return jaccard_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secret_scan.redact_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of permitted lengths."""
    return packing.best_fit_packing(docs)


STAGES = [
    ("language identification", language_identification),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("best-fit packing", packed),
]

# Classifiers, alignments and packing have no counterpart in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_path(spark, "pipeline")
    with settings(spark, SMALL_BATCHES):
        for number, (_, stage) in enumerate(STAGES):
            path = f"{folder}/{number}"
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
            if number:
                drop_folder(spark, f"{folder}/{number - 1}")
    return docs

"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tagloom.llm import (
    ann_tree,
    collocations,
    decontaminate,
    jaccard_join,
    language_id,
    lexical_search,
    licenses,
    packing,
    secret_scan,
    sharding,
    substring_dedup,
    suffix_tree,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _on_documents(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, "documents"))


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contamination(docs, benchmark)


def _lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return lexical_search.ranked(docs, benchmark)


def _neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_tree.nearest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


QUERIES: dict[str, Query] = {
    "op1_ngram_jaccard_join": _on_documents(jaccard_join.link_components),
    "op2_substring_dedup": _on_documents(substring_dedup.remove_repeats),
    "op3_decontamination": _contamination,
    "op4_toxicity": _toxicity,
    "op5_suffix_tree_lm": _on_documents(suffix_tree.score),
    "op6_nearest_neighbours": _neighbours,
    "op7_license_scan": _on_documents(licenses.license_labels),
    "op8_secret_scan": _on_documents(secret_scan.secret_digest),
    "op9_language_id": _on_documents(
        lambda docs: language_id.identify(docs).select(
            "doc_id", "held_out", "lang_pred", "score", "ambiguous"
        )
    ),
    "op10_best_fit_packing": _on_documents(packing.best_fit_packing),
    "op11_phrase_collocations": _on_documents(collocations.collocations),
    "op12_lexical_search": _lexical_search,
    "op13_sharding": _on_documents(sharding.shard_digest),
}

ORACLE_SQL: dict[str, str] = {
    "op1_ngram_jaccard_join": jaccard_join.ORACLE,
    "op2_substring_dedup": substring_dedup.ORACLE,
    "op11_phrase_collocations": collocations.ORACLE,
    "op12_lexical_search": lexical_search.ORACLE,
}

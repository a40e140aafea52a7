"""Literal search through the skipping index against a scan."""

import pytest
from pyspark.sql import functions as F

import tagloom as tl
from tagloom.sources import text_index

from conftest import rows


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("texts") / "a table")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs.repartitionByRange(8, "doc_id").write.parquet(path)
    extra = [(9001, "naïve 😀😀 zebra-quartz"), (9002, None), (9003, ""), (9004, "ab")]
    more = spark.createDataFrame(extra, "doc_id bigint, text string").coalesce(1)
    more.write.mode("append").parquet(path)
    index = str(tmp_path_factory.mktemp("index") / "text")
    tl.write_text_index(spark, path, "text", index)
    return path, index


@pytest.mark.parametrize(
    "needle",
    ["the", "e t", "zebra", "quartz", "😀😀 z", "ïve", "not in any text", "ab", "b", "", ". ", "%_["],
)
def test_rows_are_those_of_a_scan(spark, stored, needle):
    path, index = stored
    got = tl.indexed_text_contains(spark, path, "text", needle, index)
    assert rows(got) == rows(tl.text_contains(spark.read.parquet(path), "text", needle))


def test_a_rare_needle_opens_few_files(spark, stored):
    path, index = stored
    every = len(spark.read.parquet(path).inputFiles())
    assert every >= 6
    for needle, most in (("zebra-quartz", 1), ("😀😀", every), ("qqzzqq", 0), ("the", every)):
        assert len(text_index.files_to_search(spark, path, needle, index)) <= most
    found = tl.indexed_text_contains(spark, path, "text", "zebra-quartz", index)
    assert len(found.inputFiles()) == 1
    assert len(text_index.files_to_search(spark, path, "ab", index)) == every


def test_files_that_came_after_the_index_are_read(spark, tmp_path):
    path, index = f"{tmp_path}/texts", f"{tmp_path}/index"
    spark.createDataFrame([("one",)], "text string").coalesce(1).write.parquet(path)
    tl.write_text_index(spark, path, "text", index)
    late = spark.createDataFrame([("needle",)], "text string").coalesce(1)
    late.write.mode("append").parquet(path)
    found = tl.indexed_text_contains(spark, path, "text", "needle", index)
    assert rows(found) == [("needle",)] and len(found.inputFiles()) == 1


def test_a_full_filter_passes_its_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(text_index, "FILTER_BITS", 8)
    path, index = f"{tmp_path}/texts", f"{tmp_path}/index"
    texts = spark.range(200).select(F.concat(F.lit("x"), F.sha2(F.col("id").cast("string"), 256)))
    texts.toDF("text").coalesce(1).write.parquet(path)
    tl.write_text_index(spark, path, "text", index)
    assert len(text_index.files_to_search(spark, path, "not there", index)) == 1
    assert tl.indexed_text_contains(spark, path, "text", "not there", index).count() == 0

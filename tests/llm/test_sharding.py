import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.llm import sharding

SCHEMA = "doc_id bigint, text string"


def check(rows, docs, shards):
    """The contract of law `bytes` for collected rows against (doc_id, text) pairs."""
    want = sorted(
        (-1 if d is None else d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
        for d, t in docs
    )
    got = sorted((-1 if r.doc_id is None else r.doc_id, r["size"], r.text_crc32) for r in rows)
    assert got == want
    for shard in range(shards):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert all(0 <= r.shard < shards for r in rows)
    total = sum(w[1] for w in want)
    largest = max((w[1] for w in want), default=0)
    sizes = np.zeros(shards)
    for r in rows:
        sizes[r.shard] += r["size"]
    slack = largest + 2 * sharding.TOLERANCE * total / shards + 1
    assert np.abs(sizes - total / shards).max(initial=0) <= slack
    return sizes


def test_documents_come_into_equal_shards(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sharding.shard_digest(docs).collect()
    check(rows, [(r.doc_id, r.text) for r in docs.collect()], 16)
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}


def test_a_third_of_all_rows_with_one_key_is_cut(spark):
    docs = [(7, "same")] * 1000 + [(i, "x" * (i % 50)) for i in range(100, 2100)]
    docs += [(None, None)] * 30
    df = spark.createDataFrame(docs, SCHEMA).repartition(5)
    sizes = check(sharding.shard_digest(df, 8).collect(), docs, 8)
    assert sizes.max() <= 1.02 * sizes.mean() + 50


def test_pieces_give_the_same_shards_and_gapless_slots(spark):
    docs = [(i, "y" * (i * 37 % 400)) for i in range(3000)]
    df = spark.createDataFrame(docs, SCHEMA).repartition(4)
    whole = {r.doc_id: (r.shard, r.slot) for r in sharding.sharded(df, 4).collect()}
    cut = sharding.sharded(df, 4, piece_bytes=5000)
    assert {r.doc_id: (r.shard, r.slot) for r in cut.collect()} == whole


@pytest.mark.parametrize(
    "docs",
    [[], [(1, None)], [(1, ""), (1, ""), (None, "ä")], [(1, "z" * 500_000)] + [(2, "a")] * 20],
)
def test_small_and_odd_tables(spark, docs):
    df = spark.createDataFrame(docs, SCHEMA)
    rows = sharding.shard_digest(df, 16).collect()
    check(rows, docs, 16)


def test_shards_are_ranges_of_the_sort_key(spark):
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    rows = sharding.sharded(df, 5).withColumn("key", F.xxhash64("doc_id"))
    ordered = [(r.shard, r.slot) for r in rows.orderBy("key").collect()]
    assert ordered == sorted(ordered)


def test_splitters_take_few_rounds(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t" * 9).alias("text"))
    rows = sharding.keyed_rows(df)
    found = sharding.find_splitters(rows, [(200_000 * i / 16, 12.5) for i in range(1, 16)])
    assert found.rounds <= 5
    miss = found.size_below - np.array([200_000 * i / 16 for i in range(1, 16)])
    assert np.abs(miss).max() <= 12.5


def test_whole_rows_are_written(spark, tmp_path):
    rows = [(i, f"text {i}", "a", i, i) for i in range(100)]
    names = "doc_id bigint, text string, key string, slot int, size int"
    df = spark.createDataFrame(rows, names)
    sharding.write_shards(df, f"{tmp_path}/shards", 3)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert back.count() == 100 and {"key", "size", "shard", "slot"} <= set(back.columns)
    assert {(r.doc_id, r.key, r["size"]) for r in back.collect()} == {
        (i, "a", i) for i in range(100)
    }

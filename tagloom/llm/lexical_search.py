"""Ranked lexical search with bags of terms told apart once.

Every item of a benchmark is a query of all its terms over all documents. Terms are the maximal
runs of TERM bytes of the whole text, A-Z lower-cased. With N documents that hold a term, L
terms in all of them and n terms in a document, a term in df documents and tf times in this one
adds w * ((10**9 * tf) div (1000 * tf + 8 * m)) to the score each time the item has it, where
w = floor(1000 * ln((2 * N + 2) / (2 * df + 1))) and m = 25 + (75 * n * N) div L.

* Documents are restricted to the vocabulary of the items: one pass over the texts stores n and
  the (term, tf) vector of each.
* A second pass over the vectors counts df; N and L are sums of n.
* Documents with the same vector and the same m score alike for every item. They are grouped by
  a hash of both and told apart by the vectors themselves; a class keeps its first TOP doc_ids,
  which is all that one item can rank.
* Each class is scored once, against all items at a time. A task keeps the TOP best classes of
  each item by (score, smallest doc_id): ten classes that come before another one have ten
  documents that come before all of its.
* The best classes of an item are expanded into members by ascending doc_id.

The vocabulary that goes to every task is bounded: items are dealt by hash to blocks of about
ITEM_BYTES of text, and blocks are done one after the other, each with all documents.

Defined results: NULL texts and items have no terms; items without a term in any document have
no row; every row of the benchmark is a query of its own, also with a repeated or NULL item_id;
repeated documents are ranked each; rows without doc_id come last among equal scores; other
columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.graph import stored, workspace
from tagloom.llm.words import LOWER, Block, blocks, byte_class, word_hashes, words

TOP = 10
ITEM_BYTES = 1 << 22
SCORES_AT_ONCE = 1 << 21  # scores of classes times items that a task holds
PAIRS_AT_ONCE = 1 << 21  # (class, item, term) triples that a task holds
# The bytes of [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F].
TERM = ~byte_class([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


def term_hashes(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """A hash per term, and the row of the block that it belongs to."""
    found = words(block, TERM)
    return word_hashes(LOWER[block.data], found), found.text_of()


class Items:
    """Terms of some items: a sorted vocabulary and, per term, the items that hold it."""

    def __init__(self, texts: list[str | None]):
        column = pa.array(texts, pa.large_string())
        bags = [Counter() for _ in texts]
        for block in blocks(column):
            hashes, rows = term_hashes(block)
            for value, row in zip(hashes.tolist(), rows.tolist()):
                bags[block.first + row][value] += 1
        self.vocabulary = np.array(sorted({v for bag in bags for v in bag}), np.uint64)
        found = [
            (int(np.searchsorted(self.vocabulary, np.uint64(v))), item, times)
            for item, bag in enumerate(bags)
            for v, times in bag.items()
        ]
        found.sort()
        self.item = np.array([f[1] for f in found], np.int64)
        self.times = np.array([f[2] for f in found], np.int64)
        terms = np.array([f[0] for f in found], np.int64)
        # The items of term t are item[first[t]:first[t + 1]].
        self.first = np.searchsorted(terms, np.arange(len(self.vocabulary) + 1))
        self.n = len(texts)


def vectors(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """doc_id, n and the terms of the vocabulary with their tf, as bytes of int32."""

    def restrict(batches):
        for batch in batches:
            n, term, tf = [], [], []
            for block in blocks(batch.column("text")):
                hashes, row = term_hashes(block)
                n.append(np.bincount(row, minlength=block.rows))
                at = np.searchsorted(vocabulary, hashes)
                known = at < len(vocabulary)
                known[known] = vocabulary[at[known]] == hashes[known]
                key = row[known] * np.int64(len(vocabulary) or 1) + at[known]
                key, times = np.unique(key, return_counts=True)
                row, at = np.divmod(key, len(vocabulary) or 1)
                cut = np.searchsorted(row, np.arange(block.rows + 1))
                at, times = at.astype("<i4"), times.astype("<i4")
                for i in range(block.rows):
                    term.append(at[cut[i] : cut[i + 1]].tobytes())
                    tf.append(times[cut[i] : cut[i + 1]].tobytes())
            n = np.concatenate(n) if n else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n.astype(np.int64)),
                    pa.array(term, pa.binary()),
                    pa.array(tf, pa.binary()),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(restrict, "doc_id bigint, n bigint, terms binary, tfs binary")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All int32 values of a column of bytes, and how many each row has."""
    column = column.cast(pa.large_binary())
    _, raw, data = column.buffers()
    at = np.frombuffer(raw, np.int64)[column.offset : column.offset + len(column) + 1]
    values = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return values[at[0] : at[-1]].view("<i4").astype(np.int64), np.diff(at) // 4


def document_counts(found: DataFrame, terms: int) -> np.ndarray:
    """How many rows hold each term of the vocabulary."""

    def count(batches):
        total = np.zeros(terms, np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch.column("terms"))[0], minlength=terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["t", "df"])

    counted = found.select("terms").mapInArrow(count, "t bigint, df bigint")
    out = np.zeros(terms, np.int64)
    for row in counted.groupBy("t").agg(F.sum("df").alias("df")).collect():
        out[row["t"]] = row["df"]
    return out


def classes(found: DataFrame, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """m, terms, tfs and the first `top` doc_ids of each class of documents that score alike."""
    m = F.expr(f"25 + (75 * n * {n_docs}L) div {max(1, n_terms)}L")
    some = found.where(F.octet_length("terms") > 0).select(
        "doc_id", m.alias("m"), "terms", "tfs"
    )
    alike = [F.xxhash64("m", "terms", "tfs").alias("hash"), "m", "terms", "tfs"]
    place = Window.partitionBy("hash", "m", "terms", "tfs").orderBy(F.asc_nulls_last("doc_id"))
    first = some.select("doc_id", *alike).withColumn("_place", F.row_number().over(place))
    member = F.struct("_place", "doc_id")
    return (
        first.where(F.col("_place") <= top)
        .groupBy("hash", "m", "terms", "tfs")
        .agg(F.sort_array(F.collect_list(member)).alias("members"))
        .select("m", "terms", "tfs", F.col("members.doc_id").alias("members"))
    )


class _Best:
    """The best `top` classes so far of each item, in order of score and first doc_id."""

    def __init__(self, items: int, top: int):
        self.top, self.least = top, np.zeros(items)
        self.item, self.row = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.score, self.first = np.zeros(0), np.zeros(0, np.int64)

    def offer(self, scores: np.ndarray, first: np.ndarray, row: np.ndarray) -> None:
        """scores: classes x items; an equal score may still win by its doc_id."""
        at, item = np.nonzero((scores > 0) & (scores >= self.least))
        item = np.concatenate([self.item, item])
        score = np.concatenate([self.score, scores[at, item[len(self.item) :]]])
        first = np.concatenate([self.first, first[at]])
        row = np.concatenate([self.row, row[at]])
        order = np.lexsort((row, first, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        order, item = order[place < self.top], item[place < self.top]
        self.item, self.score, self.first, self.row = item, score[order], first[order], row[order]
        full = np.flatnonzero(place == self.top - 1)
        if len(full):
            at = np.searchsorted(item, item, "right") - 1
            last = np.unique(at)
            enough = np.bincount(item, minlength=len(self.least))[item[last]] == self.top
            self.least[item[last[enough]]] = self.score[last[enough]]


def score_classes(alike: DataFrame, items: Items, weight: np.ndarray, top: int) -> DataFrame:
    """item, score and members: the best classes of each item in each task."""
    most = int(weight.max(initial=0)) * 10**6 * int(items.times.sum() or 1)
    if most >= 1 << 53:
        raise ValueError("scores of an item this long outgrow exact sums; use smaller ITEM_BYTES")

    def best(batches):
        kept = _Best(items.n, top)
        held: dict[int, list] = {}
        seen = 0
        for batch in batches:
            term, many = _flat(batch.column("terms"))
            tf, _ = _flat(batch.column("tfs"))
            members = batch.column("members")
            first = members.flatten().to_numpy(zero_copy_only=False)
            first = _first_of(members, first)
            owner = np.repeat(np.arange(batch.num_rows), many)
            m = batch.column("m").to_numpy()
            value = weight[term] * ((10**9 * tf) // (1000 * tf + 8 * m[owner]))
            postings = items.first[term + 1] - items.first[term]
            for low, high in _slices(np.bincount(owner, postings, batch.num_rows), items.n):
                a, b = np.searchsorted(owner, [low, high])
                many_here = postings[a:b]
                at = np.arange(many_here.sum()) - np.repeat(
                    np.cumsum(many_here) - many_here, many_here
                )
                at += np.repeat(items.first[term[a:b]], many_here)
                cell = np.repeat(owner[a:b] - low, many_here) * items.n + items.item[at]
                # exact: every sum is a whole number below 2**53
                scores = np.bincount(
                    cell,
                    np.repeat(value[a:b], many_here) * items.times[at],
                    (high - low) * items.n,
                ).reshape(high - low, items.n)
                kept.offer(scores, first[low:high], seen + np.arange(low, high))
            new = np.unique(kept.row[kept.row >= seen])
            held |= {int(r): members[int(r) - seen].as_py() for r in new}
            live = set(kept.row.tolist())
            held = {r: ids for r, ids in held.items() if r in live}
            seen += batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(kept.item),
                pa.array(kept.score.astype(np.int64)),
                pa.array([held[r] for r in kept.row.tolist()], pa.list_(pa.int64())),
            ],
            ["item", "score", "members"],
        )

    return alike.mapInArrow(best, "item bigint, score bigint, members array<bigint>")


def _first_of(members: pa.Array, flat: np.ndarray) -> np.ndarray:
    """The smallest doc_id of each class; those without any come last."""
    sizes = members.value_lengths().to_numpy()
    at = np.cumsum(sizes) - sizes
    value = flat[at] if len(flat) else np.zeros(0)
    if value.dtype.kind == "f":  # NULLs among the ids: read these exactly
        ids = [m[0] for m in members.to_pylist()]
        return np.array([np.iinfo(np.int64).max if i is None else i for i in ids], np.int64)
    return value.astype(np.int64)


def _slices(work: np.ndarray, items: int):
    """Runs of classes whose scores and triples fit the bounds (or single classes)."""
    most = max(1, SCORES_AT_ONCE // max(1, items))
    total = np.concatenate([[0], np.cumsum(work)])
    low = 0
    while low < len(work):
        high = int(np.searchsorted(total, total[low] + PAIRS_AT_ONCE, "right")) - 1
        high = min(max(high, low + 1), low + most, len(work))
        yield low, high
        low = high


def ranked(docs: DataFrame, benchmark: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id and score of the `top` best documents of every item."""
    kind = benchmark.schema["item_id"].dataType
    questions = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    size = questions.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // ITEM_BYTES))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    results = []
    for number in range(count):
        block = questions if count == 1 else questions.where(part == number)
        with workspace(docs.sparkSession) as keep:
            results.append(keep(_ranked_block(docs, block.collect(), kind, top)))
    return reduce(DataFrame.unionByName, results)


def _ranked_block(docs: DataFrame, questions, kind, top: int) -> DataFrame:
    spark = docs.sparkSession
    items = Items([q["text"] for q in questions])
    found = stored(vectors(docs, items.vocabulary), "vectors")
    sums = found.where("n > 0").agg(F.count("*").alias("N"), F.sum("n").alias("L")).first()
    n_docs, n_terms = sums["N"], sums["L"] or 0
    df = document_counts(found, len(items.vocabulary))
    weight = np.array(
        [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()],
        np.int64,
    )
    best = score_classes(classes(found, n_docs, n_terms, top), items, weight, top)
    # An item's best classes of all tasks, then the members of these.
    first = F.asc_nulls_last(F.get("members", F.lit(0)))
    by_class = Window.partitionBy("item").orderBy(F.desc("score"), first)
    by_member = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    names = spark.createDataFrame(
        [(i, q["item_id"]) for i, q in enumerate(questions)],
        f"_item bigint, item_id {kind.simpleString()}",
    )
    return (
        best.withColumn("_place", F.row_number().over(by_class))
        .where(F.col("_place") <= top)
        .select("item", "score", F.explode("members").alias("doc_id"))
        .withColumn("rank", F.row_number().over(by_member))
        .where(F.col("rank") <= top)
        .join(F.broadcast(names), F.col("item") == F.col("_item"))  # as few rows as the block
        .select("item_id", "rank", "doc_id", "score")
    )


ORACLE = """
WITH term AS (
  SELECT row, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t
  FROM (SELECT row_number() OVER () AS row, text FROM documents)
),
doc AS (SELECT row_number() OVER () AS row, doc_id FROM documents),
tf AS (SELECT row, t, count(*) AS tf FROM term GROUP BY 1, 2),
len AS (SELECT row, count(*) AS n FROM term GROUP BY 1),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM len),
weight AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1)))
              AS BIGINT) AS w
  FROM tf, total GROUP BY t
),
m AS (SELECT row, 100 - 75 + (75 * n * docs) // terms AS m FROM len, total),
question AS (
  SELECT item_id, t, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t
    FROM benchmark)
  GROUP BY 1, 2
),
scored AS (
  SELECT item_id, tf.row,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM question JOIN weight USING (t) JOIN tf USING (t) JOIN m ON tf.row = m.row
  GROUP BY 1, 2
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scored JOIN doc USING (row) WHERE score > 0)
WHERE rank <= 10"""

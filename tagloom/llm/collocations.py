"""Phrase collocations by SETM: relations of occurrences, joined by piece and adjacent position.

Texts are lower-cased (A-Z), cut into pieces at PIECE_END and these into words; everything is
counted per language. Relation k holds the places where a frequent phrase of k words begins:

* The words of all texts are counted; those seen `support` times in their language are frequent.
* Relation 1 is written: the places of frequent words, sorted by piece and position. One stored
  row holds the occurrences of some whole pieces, so a piece is never parted and rows are small
  whatever the texts, and a lost task reads the same rows again.
* For k = 2, 3, 4: relation k - 1 is merge-joined with itself, in a task, where one occurrence
  is next to the other in the same piece; the phrases of k words that come out are counted in
  the task, which hands on a row of packed counts for each bucket of their hashes. The counts of
  a bucket are added up together and phrases of `support` are kept. There are as many buckets as
  the places of the phrases of k - 1 words ask for, so that one stays small whatever the corpus.
* The join is run again and semi-joined with the frequent phrases: what is left is written as
  relation k. The semi-join uses a filter of fixed size that passes every frequent phrase and
  few others; the others are counted in vain and never reported, so a full filter costs time
  and no result. Occurrences are never shuffled, only counts are.

A phrase is the tuple of its words' 64-bit hashes, which contain the language; its text comes
from the table of word counts at the end. Every part of a frequent phrase is frequent, so the
counts of all parts are looked up among the frequent phrases.

Defined results: a NULL text is empty, a NULL lang is `und`; pieces without words count nothing;
repeated rows count each time; an empty table has no row; ties of score and count are told apart
by the phrase's bytes; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.graph import stored, workspace
from tagloom.llm.id_filter import FILTER_BITS
from tagloom.llm.suffix_tree import bucket_bits
from tagloom.llm.words import LOWER, Block, blocks, byte_class, mix, word_hashes, words

SUPPORT = 30  # occurrences that make a phrase a candidate
MOST = 2000  # rows per language
LONGEST = 4
# Of 100 occurrences of a phrase, so many inside one longer phrase make it a part of that.
INSIDE = 80
SCALE = 2_000_000
# The ends of pieces, [.,;:!?\x0A-\x0D], and the white space inside, [\x20\x09].
PIECE_END = byte_class([*b".,;:!?", *range(0x0A, 0x0E)])
WORD = ~(PIECE_END | byte_class([0x20, 0x09]))

TEXT_AT_ONCE = 1 << 20  # bytes of text that a task tokenizes at a time
ROW_WORDS = 512  # about so many occurrences make a stored row, more if a piece has more
COMBINE = 1 << 21  # occurrences that a task counts before it passes counts on
COUNTS_OF_BUCKET = 1 << 18  # about so many counts at most are added up together

_U = np.uint64


def _occurrences(block: Block, lang_hash: np.ndarray):
    """Words of a block, a hash of each with its language, and its position.

    Positions grow by one inside a piece and by more where another piece or text begins.
    """
    found = words(block, WORD)
    text = found.text_of()
    hashes = mix(word_hashes(LOWER[block.data], found) ^ lang_hash[text].view(np.uint64))
    ends = np.cumsum(PIECE_END[block.data])
    piece = ends[found.start] if len(found.start) else np.zeros(0, np.int64)
    parted = np.zeros(len(piece), np.int64)
    parted[1:] = (piece[1:] != piece[:-1]) | (text[1:] != text[:-1])
    return found, hashes, np.arange(len(piece)) + np.cumsum(parted)


def _texts(docs: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    text = F.col("text").cast("string")
    return docs.select(lang.alias("lang"), F.xxhash64(lang).alias("lang_hash"), text.alias("text"))


def _pieces_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """data[start[i]:end[i]] as an array of strings."""
    sizes = end - start
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], sizes)
    return pa.LargeStringArray.from_buffers(
        len(sizes), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[at])
    )


def word_counts(docs: DataFrame) -> DataFrame:
    """w (hash of language and word), lang, word and n of every word."""

    def count(batches):
        for batch in batches:
            langs, hashes = batch.column("lang"), batch.column("lang_hash").to_numpy()
            for block in blocks(batch.column("text"), TEXT_AT_ONCE):
                of_block = hashes[block.first : block.first + block.rows]
                found, w, _ = _occurrences(block, of_block)
                w, first, n = np.unique(w, return_index=True, return_counts=True)
                row = block.first + found.text_of()[first]
                lower = LOWER[block.data]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(w.view(np.int64)),
                        langs.take(pa.array(row)).cast(pa.string()),
                        _pieces_of(lower, found.start[first], found.end[first]).cast(pa.string()),
                        pa.array(n),
                    ],
                    ["w", "lang", "word", "n"],
                )

    counted = _texts(docs).mapInArrow(count, "w bigint, lang string, word string, n bigint")
    return counted.groupBy("w", "lang", "word").agg(F.sum("n").alias("n"))


class GroupFilter:
    """Passes all groups it was made of, and few others while it is not full: of fixed size."""

    def __init__(self, groups: DataFrame, names: list[str]):
        def bits(batches):
            for batch in batches:
                found = _bits([batch.column(c).to_numpy() for c in names])
                yield pa.RecordBatch.from_arrays([pa.array(found + 1)], ["bit"])

        rows = (
            groups.select(*names)
            .mapInArrow(bits, "bit bigint")
            .groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
            .collect()
        )
        self.bits = np.zeros(FILTER_BITS // 8, np.uint8)
        for row in rows:
            part = np.frombuffer(row["bits"], np.uint8)
            at = (row["bucket"] - 1) * len(part)
            self.bits[at : at + len(part)] = part


def _passing(bits: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    bit = _bits(columns)
    return (bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def _group_hash(columns: list[np.ndarray]) -> np.ndarray:
    total = np.full(len(columns[0]), _U(len(columns)))
    for column in columns:
        total = mix(total * _U(0x9E3779B97F4A7C15) + column.view(np.uint64))
    return total


def _bits(columns: list[np.ndarray]) -> np.ndarray:
    return (_group_hash(columns) & _U(FILTER_BITS - 1)).astype(np.int64)


def _names(k: int) -> list[str]:
    return [f"w{i + 1}" for i in range(k)]


def _relation_schema(k: int) -> str:
    return ", ".join(["p array<int>", *(f"{c} array<bigint>" for c in _names(k))])


def _stored_rows(p: np.ndarray, columns: list[np.ndarray], cut: np.ndarray) -> pa.RecordBatch:
    """Row i of a relation holds the occurrences cut[i] to cut[i + 1]; empty rows go."""
    offsets = pa.array(np.unique(cut).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(p.astype(np.int32)))]
    lists += [pa.ListArray.from_arrays(offsets, pa.array(c.view(np.int64))) for c in columns]
    return pa.RecordBatch.from_arrays(lists, ["p", *_names(len(columns))])


def first_relation(docs: DataFrame, frequent: GroupFilter) -> DataFrame:
    bits = frequent.bits  # tasks get the bits alone

    def occurrences(batches):
        for batch in batches:
            lang_hash = batch.column("lang_hash").to_numpy()
            for block in blocks(batch.column("text")):
                of_block = lang_hash[block.first : block.first + block.rows]
                _, w, p = _occurrences(block, of_block)
                keep = _passing(bits, [w])
                w, p = w[keep], p[keep]
                # Rows end where an occurrence is not next to the one before it.
                gaps = np.flatnonzero(np.diff(p, prepend=-2) > 1)
                _, first = np.unique(gaps // ROW_WORDS, return_index=True)
                cut = np.concatenate([[0], gaps[first], [len(p)]])
                yield _stored_rows(p, [w], cut)

    return _texts(docs).select("lang_hash", "text").mapInArrow(occurrences, _relation_schema(1))


def _read(batch: pa.RecordBatch, k: int):
    """Sorted (row, position) places of a batch of relation k, its words, and rows' ends."""
    p = batch.column("p")
    sizes = p.value_lengths().to_numpy()
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = (row << 32) + p.flatten().to_numpy()
    return place, [batch.column(c).flatten().to_numpy() for c in _names(k)], row


def merge_join(place: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, list]:
    """Joins sorted occurrences with those that begin one position later: where the joined
    phrases begin in the relation, and their words."""
    after = np.searchsorted(place, place + 1)
    there = after < len(place)
    there[there] = place[after[there]] == place[there] + 1
    left = np.flatnonzero(there)
    return left, [*(c[left] for c in columns), columns[-1][after[left]]]


def _summed(columns: list[np.ndarray], n: np.ndarray | None = None):
    """Each phrase once, in the order of its hash: hashes, words and its occurrences."""
    h = _group_hash(columns)
    order = np.argsort(h, kind="stable")
    h = h[order]
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1])[: len(h)])
    if n is None:
        n = np.diff(np.append(first, len(h)))
    elif len(h):
        n = np.add.reduceat(n[order], first, dtype=np.int64)
    return h[first], [c[order[first]] for c in columns], n


def _as_bytes(values: np.ndarray, cut: np.ndarray) -> pa.Array:
    """values[cut[i]:cut[i + 1]] as the bytes of row i."""
    offsets = (cut * values.itemsize).astype(np.int32)
    data = pa.py_buffer(np.ascontiguousarray(values))
    return pa.BinaryArray.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer(offsets), data])


def _from_bytes(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """The values of all rows, one after the other."""
    return np.concatenate(
        [np.zeros(0, dtype), *(np.frombuffer(row.as_buffer(), dtype) for row in column)]
    )


def packed_counts(relation: DataFrame, k: int, places: int) -> DataFrame:
    """Phrases of k words that begin at joined places of relation k - 1, and how often, as tasks
    have counted them: a task makes a row for each bucket of phrases, with the bytes of their
    words (w1 .. wk) and counts (n). The buckets are for about `places` places."""
    bits = bucket_bits(places, COUNTS_OF_BUCKET)

    def count(batches):
        held, many = [], 0
        for batch in batches:
            place, columns, _ = _read(batch, k - 1)
            left, columns = merge_join(place, columns)
            held.append(columns)
            many += len(left)
            if many >= COMBINE:
                yield _dealt(held)
                held, many = [], 0
        if many:
            yield _dealt(held)

    def _dealt(held):
        h, columns, n = _summed([np.concatenate(parts) for parts in zip(*held)])
        bucket = (h >> _U(64 - bits)).astype(np.int32)
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        cut = np.append(first, len(h))
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[first]), *(_as_bytes(c, cut) for c in [*columns, n.astype(np.int32)])],
            ["bucket", *_names(k), "n"],
        )

    schema = ", ".join(["bucket int", *(f"{c} binary" for c in [*_names(k), "n"])])
    return relation.mapInArrow(count, schema)


def phrase_counts(relation: DataFrame, k: int, places: int, support: int) -> DataFrame:
    """w1 .. wk and n of the phrases of k words that begin at `support` joined places or more of
    relation k - 1. A bucket's counts are added up together."""

    def frequent(table: pa.Table) -> pa.Table:
        columns = [_from_bytes(table.column(c), np.int64) for c in _names(k)]
        _, columns, n = _summed(columns, _from_bytes(table.column("n"), np.int32))
        often = n >= support
        return pa.table([c[often] for c in [*columns, n]], names=[*_names(k), "n"])

    schema = ", ".join(f"{c} bigint" for c in [*_names(k), "n"])
    return packed_counts(relation, k, places).groupBy("bucket").applyInArrow(frequent, schema)


def next_relation(relation: DataFrame, k: int, frequent: GroupFilter) -> DataFrame:
    """The joined places of relation k - 1 whose phrases the filter passes."""
    bits = frequent.bits

    def occurrences(batches):
        for batch in batches:
            place, columns, row = _read(batch, k - 1)
            left, columns = merge_join(place, columns)
            keep = _passing(bits, columns)
            left = left[keep]
            cut = np.searchsorted(row[left], np.arange(batch.num_rows + 1))
            p = place[left] & 0xFFFFFFFF
            yield _stored_rows(p, [c[keep] for c in columns], cut)

    return relation.mapInArrow(occurrences, _relation_schema(k))


def frequent_phrases(docs: DataFrame, support: int) -> tuple[DataFrame, DataFrame]:
    """(word counts, phrases): words array and f of all phrases of 1 to LONGEST frequent words."""
    counts = stored(word_counts(docs), "words")
    frequent = counts.where(F.col("n") >= support)
    groups = [frequent.select(F.array("w").alias("words"), F.col("n").alias("f"))]
    keep = GroupFilter(frequent.withColumnRenamed("w", "w1"), ["w1"])
    relation = stored(first_relation(docs, keep), "relation")
    for k in range(2, LONGEST + 1):
        # A phrase of k words begins where a frequent one of k - 1 words does.
        places = groups[-1].agg(F.sum("f")).first()[0] or 0
        found = stored(phrase_counts(relation, k, places, support), "phrases")
        groups.append(found.select(F.array(*_names(k)).alias("words"), F.col("n").alias("f")))
        if k < LONGEST:
            relation = stored(next_relation(relation, k, GroupFilter(found, _names(k))), "relation")
    return counts, reduce(DataFrame.unionByName, groups)


def _exact(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(38,0)")


def scored(phrases: DataFrame) -> DataFrame:
    """words, a, l, r and score of the candidates, by their lowest cut, without mere parts."""
    candidates = phrases.where(F.size("words") > 1).withColumnRenamed("f", "a")
    cuts = candidates.select(
        "words", "a", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    ).withColumns(
        {
            "first": F.slice("words", F.lit(1), F.col("k")),
            "rest": F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")),
        }
    )
    known = phrases.select(F.col("words").alias("part"), "f")
    for side, name in (("first", "l"), ("rest", "r")):
        count = known.select(F.col("part").alias(side), F.col("f").alias(name))
        cuts = cuts.join(count, side)
    share = F.expr(
        f"(cast(a as decimal(38,0)) * {SCALE}) div (cast(l as decimal(38,0)) + r)"
    ).cast("long")
    lowest = (
        cuts.groupBy("words", "a")
        .agg(F.min(F.struct(share.alias("score"), "k", "l", "r")).alias("cut"))
        .select("words", "a", "cut.score", "cut.l", "cut.r")
    )
    longer = candidates.where(F.size("words") > 2).select(
        "a",
        F.explode(
            F.expr(
                "flatten(transform(sequence(2, size(words) - 1), n ->"
                " transform(sequence(1, size(words) - n + 1), i -> slice(words, i, n))))"
            )
        ).alias("words"),
    )
    inside = longer.groupBy("words").agg(F.max("a").alias("most"))
    part = _exact("most") * 100 >= _exact("a") * INSIDE
    return (
        lowest.join(inside, "words", "left")
        .where(~F.coalesce(part, F.lit(False)))
        .select("words", "a", "l", "r", "score")
    )


def collocations(docs: DataFrame, support: int = SUPPORT, most: int = MOST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the `most` best phrases of each language."""
    with workspace(docs.sparkSession) as keep:
        return keep(_ranked(docs, support, most))


def _ranked(docs: DataFrame, support: int, most: int) -> DataFrame:
    counts, phrases = frequent_phrases(docs, support)
    names = counts.where(F.col("n") >= support).select("w", "lang", "word")
    best = stored(scored(phrases), "scored")
    lang = best.withColumn("w", F.get("words", F.lit(0))).join(names.drop("word"), "w").drop("w")
    # All phrases that can be among the first, ties included; only these get their text.
    by_lang = Window.partitionBy("lang")
    in_order = [F.desc("score"), F.desc("a")]
    first = lang.withColumn("_place", F.rank().over(by_lang.orderBy(*in_order))).where(
        F.col("_place") <= most
    )
    spelled = (
        first.select(*lang.columns, F.posexplode("words").alias("at", "w"))
        .join(names.select("w", "word"), "w")
        .groupBy(*lang.columns)
        .agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("spelled"))
        .withColumn("phrase", F.concat_ws(" ", "spelled.word"))
    )
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    place = F.row_number().over(by_lang.orderBy(*in_order, "phrase"))
    return (
        spelled.withColumn("rank", place.cast("long"))
        .where(F.col("rank") <= most)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


ORACLE = f"""
WITH piece AS (
  SELECT row_number() OVER () AS id, lang, regexp_extract_all(p, '[^ \\t]+') AS words
  FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[.,;:!?\\x0A-\\x0D]')) AS p
    FROM documents)
),
total AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM piece GROUP BY 1),
occurrence AS (
  SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS spot
  FROM piece, (SELECT unnest([1, 2, 3, 4]) AS size)
),
phrase AS (
  SELECT lang, size, words[spot:spot + size - 1] AS words, count(*) AS f
  FROM occurrence GROUP BY ALL HAVING count(*) >= {SUPPORT}
),
cut AS (
  SELECT lang, size, words, f AS a, unnest(range(1, size)) AS k FROM phrase WHERE size > 1
),
scored AS (
  SELECT cut.lang, cut.size, cut.words, a, k, x.f AS l, y.f AS r,
         CAST(({SCALE}::HUGEINT * a) // (x.f + y.f) AS BIGINT) AS score
  FROM cut
  JOIN phrase x ON x.lang = cut.lang AND x.words = cut.words[1:k]
  JOIN phrase y ON y.lang = cut.lang AND y.words = cut.words[k + 1:]
),
lowest AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
),
part AS (
  SELECT lang, words[i:i + n - 1] AS words, max(f) AS most
  FROM (
    SELECT lang, words, f, size, n, unnest(range(1, size - n + 2)) AS i
    FROM (SELECT *, unnest(range(2, size)) AS n FROM phrase WHERE size > 2))
  GROUP BY ALL
),
ranked AS (
  SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, score
  FROM lowest LEFT JOIN part USING (lang, words)
  WHERE most IS NULL OR 100 * most < {INSIDE} * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (
    PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM ranked)
JOIN total USING (lang)
WHERE rank <= {MOST}"""

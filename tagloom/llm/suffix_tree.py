"""Language-model scores by a probabilistic suffix tree over words.

Texts are sequences of lower-cased (A-Z) words between a begin and an end. Contexts are sequences
of up to DEPTH whole words, known by 64-bit hashes. Their next-word counts come from all training
texts, one length after the other: a context of d words counts if it occurs SUPPORT times, and a
next word is a parameter of it if it follows LEAST_NEXT times. Both are absolute, so a larger
corpus has more and longer contexts. Such contexts and parameters are looked for only where
those of the next shorter suffix reach these counts, which loses none.

A context is kept if its parameters save more bits than they cost against its longest proper
suffix, or if a longer kept context ends in it. In a context with t places, a parameter that
follows n times has (n + r p) / (t + k), every other word r p / (t + k), where k is the number of
parameters, r = k + t - (the places of parameters), and p is the word's probability in the
suffix. The empty context has discounted word frequencies, unknown words being one word that
holds what the discount leaves. A text's score sums log10 of each word's probability in the
longest kept suffix of what precedes it: that is the log10 in the empty context, and for each
kept suffix log10 r / (t + k), and if the word is a parameter of it log10 (1 + n / (r p)).

Contexts, parameters and these summands are Spark tables. The TOP_WORDS most frequent words go
to every task with their counts, and as many summands; the others are joined. Filters of fixed
size choose what is worth a join; when they fill up they pass more, which costs no result.

Pairs to count and keys to join are dealt into buckets of their hashes, whose number grows with
the corpus. A task hands on the sorted keys of a bucket as one row of bytes, and a bucket is
counted or joined at once. While pairs are counted, the most frequent contexts of that length and
the most frequent words have numbers, so that a pair of them takes few bytes; where either has
none, the pair takes both hashes.

Defined results: NULL, empty and wordless texts consist of the end; without any training text
every word counts as unknown; repeated rows are counted and scored each; a NULL doc_id counts as
training text and is carried along; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.graph import drop, stored
from tagloom.llm.id_filter import Members
from tagloom.llm.words import LOWER, Block, blocks, is_held_out, segment_sums, word_hashes, words

DEPTH = 4
SUPPORT = 16  # places that a context needs
LEAST_NEXT = 3  # times that a word follows a context before it is a parameter
PARAMETER_BITS = 12.0
# Known to every task with their counts, and as many summands: 48 MB. So many words and contexts
# of a length have numbers: 32 MB.
TOP_WORDS = 1 << 20
HELD = 2_000_000  # counted keys a task holds before it hands them on
SHARES = 2  # of the joined keys, one after the other: what a share shuffles goes before the next
PAIRS_OF_BUCKET = 1 << 19  # counted together
PLACES_OF_BUCKET = 1 << 21  # of which the unknown words and summands are joined together
TEXTS_OF_BATCH = 1 << 16  # put together with what was joined, fewer if they hold more keys
JOINED_AT_ONCE = 500_000  # keys to join, or to be joined, that a task holds

_U = np.uint64


class Tally:
    """Counts by key; what it hands on is summed again by the shuffle."""

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        keys, counts = np.unique(keys, return_counts=True)
        self.keys.append(keys)
        self.counts.append(counts)
        self.size += len(keys)
        if self.size > 2 * HELD:
            self._merge()

    def _merge(self) -> None:
        if self.keys:
            keys, where = np.unique(np.concatenate(self.keys), return_inverse=True)
            counts = np.bincount(where, np.concatenate(self.counts), len(keys)).astype(np.int64)
            self.keys, self.counts, self.size = [keys], [counts], len(keys)

    def take(self, least: int = 0):
        """Everything, if there are more than `least` keys."""
        if self.size > least:
            self._merge()
        if self.size <= least:
            return None
        out = self.keys[0], self.counts[0]
        self.__init__()
        return out


def text_words(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a block, and where each text's begin."""
    found = words(block)
    return word_hashes(LOWER[block.data], found), found.row


def _training(batches):
    for batch in batches:
        train = ~is_held_out(batch.column("doc_id").to_pylist(), 7)
        yield from blocks(batch.column("text").filter(pa.array(train)))


def _tallied(values):
    """Counted keys, handed on whenever a task holds many."""
    tally = Tally()
    for keys in values:
        tally.add(keys)
        if (out := tally.take(HELD)) is not None:
            yield _counts(out)
    if (out := tally.take()) is not None:
        yield _counts(out)


def _counts(out):
    return pa.RecordBatch.from_arrays(
        [pa.array(out[0].view(np.int64)), pa.array(out[1].astype(np.int64))], ["key", "n"]
    )


_END = np.zeros(1, np.uint64)  # counted under 0: no word has that hash but by chance


def _word_counts(batches):
    def keys():
        for block in _training(batches):
            hashes, _ = text_words(block)
            yield hashes
            yield np.repeat(_END, block.rows)

    return _tallied(keys())


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << _U(by)) | (x >> _U(64 - by))


_P1, _P2, _P3, _P4, _P5 = (
    _U(p)
    for p in (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63,
        0x27D4EB2F165667C5,
    )
)


def _hash_long(x: np.ndarray, seed) -> np.ndarray:
    h = (seed + _P5 + _U(8)) ^ (_rotated(x * _P2, 31) * _P1)
    h = _rotated(h, 27) * _P1 + _P4
    h = (h ^ (h >> _U(33))) * _P2
    h = (h ^ (h >> _U(29))) * _P3
    return h ^ (h >> _U(32))


def followed(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The key of a context with one more word: Spark's xxhash64(context, word)."""
    return _hash_long(word, _hash_long(context, np.full(1, 42, np.uint64)))


def between_ends(hashes: np.ndarray, row: np.ndarray):
    """All texts with a 0 before and behind each, and for each place the text and how many come
    before it there."""
    sizes = np.diff(row)
    line = np.zeros(len(hashes) + 2 * len(sizes), np.uint64)
    line[np.arange(len(hashes)) + 2 * np.repeat(np.arange(len(sizes)), sizes) + 1] = hashes
    text = np.repeat(np.arange(len(sizes)), sizes + 2)
    first = row[:-1] + 2 * np.arange(len(sizes))
    return line, text, np.arange(len(line)) - first[text]


def planes(values: np.ndarray) -> bytes:
    """All last bytes, then all last but one and so on, as far as any is not zero."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 0
    of_each = values.astype(np.uint64).view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(of_each[:, :width].T).tobytes()


def from_planes(data: bytes, size: int) -> np.ndarray:
    out = np.zeros((size, 8), np.uint8)
    if size:
        found = np.frombuffer(data, np.uint8).reshape(-1, size)
        out[:, : len(found)] = found.T
    return out.view(np.uint64).reshape(-1)


def packed(rising: np.ndarray) -> bytes:
    """Sorted keys by their differences, of which many bytes are zero."""
    return planes(np.diff(rising, prepend=_U(0)))


def unpacked(data: bytes, size: int) -> np.ndarray:
    return np.cumsum(from_planes(data, size), dtype=np.uint64)


def bucket_bits(keys: int, each: int) -> int:
    """So many first bits of a key deal about `keys` keys into buckets of about `each`."""
    return min(30, max(2, (keys // each).bit_length()))


def _runs(bucket: np.ndarray):
    """Each bucket of a sorted array, and from where to where it stands."""
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
    ends = np.append(first[1:], len(bucket))[: len(first)]
    return zip(bucket[first].tolist(), first.tolist(), ends.tolist(), strict=True)


class Numbers:
    """Numbers of keys, each in the slot that the last bits of its key give; a key that finds its
    slot taken by one before it has no number."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.number = np.full(1 << len(keys).bit_length(), -1, np.int32)
        slot = (keys[::-1] & _U(len(self.number) - 1)).astype(np.int64)
        self.number[slot] = np.arange(len(keys) - 1, -1, -1)  # the last one written stays

    def of(self, wanted: np.ndarray) -> np.ndarray:
        """The numbers, or -1."""
        if not len(self.keys):
            return np.full(len(wanted), -1)
        number = self.number[(wanted & _U(len(self.number) - 1)).astype(np.int64)]
        return np.where(self.keys[number] == wanted, number, -1).astype(np.int64)


_ODD = 0x9E3779B97F4A7C15


@dataclass
class Codes:
    """Pairs of a numbered context and a numbered word as numbers of few bits.

    These are spread, so that their first bits deal pairs evenly into buckets.
    """

    contexts: np.ndarray
    words: np.ndarray

    @property
    def shift(self) -> int:
        return len(self.words).bit_length()

    @property
    def bits(self) -> int:
        return self.shift + len(self.contexts).bit_length()

    def code(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        code = (context.astype(np.uint64) << _U(self.shift)) | word.astype(np.uint64)
        return code * _U(_ODD) & _U((1 << self.bits) - 1)

    def pairs(self, codes: np.ndarray):
        code = codes * _U(pow(_ODD, -1, 1 << 64)) & _U((1 << self.bits) - 1)
        return (
            self.contexts[(code >> _U(self.shift)).astype(np.int64)],
            self.words[(code & _U((1 << self.shift) - 1)).astype(np.int64)],
        )


def _pair_counts(batches, length: int, contexts: Members, shorter: Members, codes: Codes, bits: int):
    """bucket, coded, size, a, b, n: words after contexts of `length` words that may be frequent
    enough, and how often. a has codes, or a and b the contexts and words where one has no number."""
    context_number, word_number = Numbers(codes.contexts), Numbers(codes.words)

    def summed():
        code, n = np.unique(np.concatenate(coded), return_counts=True)
        coded.clear()
        rows = [
            (bucket, True, end - at, packed(code[at:end]), b"", planes(n[at:end]))
            for bucket, at, end in _runs((code >> _U(max(0, codes.bits - bits))).astype(np.int64))
        ]
        context, word = (np.concatenate(x) for x in zip(*others, strict=True))
        others.clear()
        key, one, n = np.unique(followed(context, word), return_index=True, return_counts=True)
        context, word = context[one], word[one]
        rows += [
            (
                bucket, False, end - at,
                context[at:end].tobytes(), word[at:end].tobytes(), planes(n[at:end]),
            )
            for bucket, at, end in _runs((key >> _U(64 - bits)).astype(np.int64))
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), _PAIRS.types, strict=True)],
            schema=_PAIRS,
        )

    coded, others, size = [], [], 0
    for block in _training(batches):
        line, _, before = between_ends(*text_words(block))
        keys = line  # of the last words up to each place
        for d in range(1, length):
            keys = np.append(keys[:d], followed(keys[d - 1 : -1], line[d:]))
        place = np.flatnonzero(before >= length)
        place = place[shorter.passes(keys[place])]
        place = place[contexts.passes(keys[place - 1])]
        context, word = keys[place - 1], line[place]
        first, second = context_number.of(context), word_number.of(word)
        numbered = (first >= 0) & (second >= 0)
        coded.append(codes.code(first[numbered], second[numbered]))
        others.append((context[~numbered], word[~numbered]))
        size += len(place)
        if size > HELD:
            yield summed()
            size = 0
    if size:
        yield summed()


_PAIRS = pa.schema(
    [
        ("bucket", pa.int32()),
        ("coded", pa.bool_()),
        ("size", pa.int32()),
        ("a", pa.binary()),
        ("b", pa.binary()),
        ("n", pa.binary()),
    ]
)


def _of_bucket(codes: Codes):
    return lambda table: _frequent_pairs(table, codes)


def _frequent_pairs(table: pa.Table, codes: Codes) -> pa.Table:
    """context, next, n of the pairs of one bucket that are frequent enough."""
    out = []
    for coded in (True, False):
        rows = table.filter(pa.compute.equal(table["coded"], coded)).to_pylist()
        if not rows:
            continue
        n = np.concatenate([from_planes(r["n"], r["size"]) for r in rows])
        if coded:
            keys = np.concatenate([unpacked(r["a"], r["size"]) for r in rows])
        else:
            context, word = (
                np.concatenate([np.frombuffer(r[x], np.uint64) for r in rows]) for x in ("a", "b")
            )
            keys = followed(context, word)
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        n = np.add.reduceat(n, first).astype(np.int64)
        good = n >= LEAST_NEXT
        first, n = first[good], n[good]
        pair = codes.pairs(keys[first]) if coded else (context[order[first]], word[order[first]])
        out.append([*(x.view(np.int64) for x in pair), n])
    return pa.table(
        {name: np.concatenate(x) for name, x in zip(("context", "next", "n"), zip(*out), strict=True)}
    )


def _first_keys(counted: DataFrame, column: str, by: str, most: int) -> np.ndarray:
    """The `most` keys with the largest counts, those first."""
    top = counted.orderBy(F.desc(by), column).select(column).limit(most).toArrow()
    return top[column].to_numpy().view(np.uint64)


def _summands(
    texts: DataFrame, counted: DataFrame, roots: DataFrame, places: int, top_words: int
) -> DataFrame:
    """key, n, value: a kept context's under the inverted bits of its key, and its parameters'.

    counted: key, n of words and the end; roots: key, p of them in the empty context; places: how
    many words and ends there are; top_words: how many words and contexts get numbers.
    """
    numbered = _first_keys(counted, "key", "n", top_words)
    bits = bucket_bits(places, PAIRS_OF_BUCKET)
    contexts = counted.where(F.col("n") >= SUPPORT).select(
        F.col("key").alias("context"), F.lit(None).cast("long").alias("suffix"), F.col("n").alias("t")
    )
    below = roots.join(counted, "key").where(F.col("n") >= LEAST_NEXT).select(
        F.col("key").alias("next"), F.lit(0).cast("long").alias("suffix"), "p", "key"
    )
    levels = []
    for length in range(1, DEPTH + 1):
        frequent = Members(contexts.select(F.col("context").alias("key")))
        shorter = Members(below.select("key"))
        codes = Codes(_first_keys(contexts, "context", "t", top_words), numbered)
        pairs = stored(
            texts.mapInArrow(
                lambda batches, length=length, frequent=frequent, shorter=shorter, codes=codes: (
                    _pair_counts(batches, length, frequent, shorter, codes, bits)
                ),
                "bucket int, coded boolean, size int, a binary, b binary, n binary",
            )
            .groupBy("bucket")
            .applyInArrow(
                _of_bucket(codes),
                "context bigint, next bigint, n bigint",
            ),
            "pairs",
        )
        sizes = pairs.groupBy("context").agg(F.count("*").alias("k"), F.sum("n").alias("seen"))
        sizes = sizes.join(contexts, "context").withColumn("r", F.col("k") + F.col("t") - F.col("seen"))
        rows = pairs.join(sizes, "context").join(
            below.select("next", F.col("suffix").alias("suffix_"), F.col("p").alias("q")),
            on=(F.col("suffix_") == F.coalesce("suffix", F.lit(0))) & (pairs["next"] == below["next"]),
        )
        rows = stored(
            rows.select(
                "context", "suffix", pairs["next"], "n", "r", "q",
                ((F.col("n") + F.col("r") * F.col("q")) / (F.col("t") + F.col("k"))).alias("p"),
            ).withColumn("key", F.xxhash64("context", "next")),
            "parameters",
        )
        drop(pairs)
        # t, k and seen of a context follow from r and its parameters
        kept = stored(
            rows.groupBy("context", "suffix", "r")
            .agg(
                F.sum(F.col("n") * F.log2(F.col("p") / F.col("q"))).alias("gain"),
                F.count("*").alias("k"),
                F.sum("n").alias("seen"),
            )
            .withColumn("t", F.col("r") - F.col("k") + F.col("seen"))
            .select(
                "context",
                "suffix",
                "t",
                F.log10(F.col("r") / (F.col("t") + F.col("k"))).alias("value"),
                (
                    F.col("gain")
                    + (F.col("t") - F.col("seen")) * F.log2(F.col("r") / (F.col("t") + F.col("k")))
                    > PARAMETER_BITS * F.col("k")
                ).alias("says_more"),
            ),
            "contexts",
        )
        levels.append((rows, kept))
        suffix = F.col("next") if length == 1 else F.xxhash64("suffix", "next")
        contexts = rows.where((F.col("n") >= SUPPORT) & (F.col("next") != 0)).select(
            F.col("key").alias("context"), suffix.alias("suffix"), F.col("n").alias("t")
        )
        below = rows.select("next", F.col("context").alias("suffix"), "p", "key")
    out, needed = [], None
    for rows, kept in reversed(levels):
        chosen = kept.where("says_more").select("context")
        chosen = (chosen if needed is None else chosen.unionByName(needed)).distinct()
        kept = stored(kept.join(chosen, "context", "left_semi"), "kept")
        out.append(kept.select(F.bitwise_not("context").alias("key"), F.col("t").alias("n"), "value"))
        out.append(
            rows.join(kept.select("context"), "context", "left_semi").select(
                "key", "n", F.log10(1 + F.col("n") / (F.col("r") * F.col("q"))).alias("value")
            )
        )
        needed = kept.select(F.col("suffix").alias("context"))
    summands = stored(reduce(DataFrame.unionByName, out), "summands")
    for rows, kept in levels:
        drop(rows, kept)
    return summands


@dataclass
class Vocabulary:
    """What every task knows: the most frequent words, the totals, the greatest summands."""

    known: np.ndarray  # sorted hashes
    counts: np.ndarray
    ends: int  # training texts
    tokens: int  # training words
    distinct: int
    discount: float
    keys: np.ndarray  # of summands, each in the slot that the last bits of its key give
    values: np.ndarray

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """The more important ones come first; what finds its slot taken is left to the join."""
        size = 1 << len(keys).bit_length()
        self.keys, self.values = np.zeros(size, np.uint64), np.zeros(size)
        slot = (keys[::-1] & _U(size - 1)).astype(np.int64)
        # the last one written to a slot stays, in both tables
        last = len(slot) - 1 - np.unique(slot[::-1], return_index=True)[1]
        self.keys[slot[last]], self.values[slot[last]] = keys[::-1][last], values[::-1][last]

    def summand(self, wanted: np.ndarray):
        """Which are at hand, and their values (else 0)."""
        slot = (wanted & _U(len(self.keys) - 1)).astype(np.int64)
        here = self.keys[slot] == wanted
        return here, np.where(here, self.values[slot], 0)

    @property
    def places(self) -> int:
        """One more for the end and for unknown words, that they have a probability."""
        return self.tokens + self.ends + 2

    @property
    def unknown(self) -> float:
        return (self.discount * self.distinct + 1) / self.places

    @property
    def end(self) -> float:
        return (self.ends + 1) / self.places

    def word_log(self, n):
        """log10 of a word's probability in the empty context; n is 0 for unknown ones."""
        share = np.where(n > 0, (n - self.discount) / self.places, self.unknown)
        return np.log10(share)


def _known(keys: np.ndarray, counts: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The counts of `wanted` among sorted keys (else 0)."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, counts[at], 0)


def _wanted(line, before, members: Members):
    """Places and keys of the summands that may exist."""
    place, keys = np.flatnonzero(before >= 1), line
    for d in range(1, DEPTH + 1):
        place = place[before[place] >= d]
        context = ~keys[place - 1]
        good = members.passes(context)
        place, context = place[good], context[good]
        if not len(place):
            break
        yield place, context
        keys = np.append(keys[:d], followed(keys[d - 1 : -1], line[d:]))
        after = keys[place]
        good = members.passes(after)
        yield place[good], after[good]


_JOINED = ["batch", "bucket", "size", "a", "b", "times"]


def _scored(batches, members: Members, vocabulary: Vocabulary, bits: int):
    """A row for each text, and rows of a bucket with keys to join (a), whose they are (b) and
    how often (times).

    batch and `at` say which text it is: the texts of a batch are joined and put together at once.
    """
    ends, batch_number = vocabulary.ends, TaskContext.get().partitionId() << 33
    rest, rest_of, held, texts_held, names = [], [], 0, 0, None

    def joined():
        keys, at = np.concatenate(rest), np.concatenate(rest_of)
        order = np.argsort(keys, kind="stable")  # by text too, as they came
        keys, at = keys[order], at[order]
        one = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (at[1:] != at[:-1])))
        keys, at, times = keys[one], at[one], np.diff(np.append(one, len(keys)))
        rows = [
            (
                batch_number, bucket, end - first,
                packed(keys[first:end]), planes(at[first:end]), planes(times[first:end]),
            )
            for bucket, first, end in _runs((keys >> _U(64 - bits)).astype(np.int64))
        ]
        columns = dict(zip(_JOINED, zip(*rows, strict=True), strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns.get(f.name, [None] * len(rows)), f.type) for f in names], schema=names
        )

    for batch in batches:
        ids = batch.column("doc_id")
        out = {k: [np.zeros(0)] for k in ("n_tokens", "n_known", "logs", "score")}
        for block in blocks(batch.column("text")):
            hashes, row = text_words(block)
            distinct, number = np.unique(hashes, return_inverse=True)
            n = _known(vocabulary.known, vocabulary.counts, distinct)
            each = n[number]
            line, text, before = between_ends(hashes, row)
            begins = row + 2 * np.arange(len(row))
            # by place first and in long numbers: in a likely text the summands nearly cancel out
            logs = np.zeros(len(line))
            logs[begins[1:] - 1] = np.log10(vocabulary.end)
            of_word = np.arange(len(hashes)) + 2 * np.repeat(np.arange(block.rows), np.diff(row)) + 1
            logs[of_word] = np.where(n > 0, vocabulary.word_log(n), 0)[number]
            unknown = segment_sums((each == 0).astype(float), row).round()
            first = texts_held + block.first
            text = (first + text).astype(np.int32)
            rest_of.append(text[of_word[each == 0]])
            rest.append(hashes[each == 0])
            held += len(rest[-1])
            for place, wanted in _wanted(line, before, members):
                here, value = vocabulary.summand(wanted)
                logs[place] += value
                rest_of.append(text[place[~here]])
                rest.append(wanted[~here])
                held += len(rest[-1])
            sums = np.append(0, np.cumsum(logs, dtype=np.longdouble))
            score = (sums[begins[1:]] - sums[begins[:-1]]).astype(np.float64) + unknown * np.log10(vocabulary.unknown)
            out["score"].append(score)
            out["n_tokens"].append(np.diff(row) + 1)
            out["n_known"].append(np.diff(row) - unknown + (ends > 0))
            out["logs"].append(
                segment_sums(np.log10(n + 1.0)[number], row) + np.log10(ends + 1.0)
            )
        whole = {k: np.concatenate(v) for k, v in out.items()}
        columns = {
            "batch": pa.array(np.full(len(ids), batch_number)),
            "at": pa.array(np.arange(texts_held, texts_held + len(ids)), pa.int32()),
            "doc_id": ids,
            "held_out": pa.array(is_held_out(ids.to_pylist(), 7)),
            "n_tokens": pa.array(whole["n_tokens"].astype(np.int64)),
            "n_known": pa.array(whole["n_known"].astype(np.int64)),
            "logs": pa.array(whole["logs"]),
            "score": pa.array(whole["score"]),
            "bucket": pa.nulls(len(ids), pa.int32()),
            "size": pa.nulls(len(ids), pa.int32()),
            "a": pa.nulls(len(ids), pa.binary()),
            "b": pa.nulls(len(ids), pa.binary()),
            "times": pa.nulls(len(ids), pa.binary()),
        }
        rows = pa.RecordBatch.from_pydict(columns)
        names = rows.schema
        yield rows
        texts_held += len(ids)
        if held > JOINED_AT_ONCE or texts_held >= TEXTS_OF_BATCH:
            if held:
                yield joined()
            rest, rest_of, held, texts_held = [], [], 0, 0
            batch_number += 1
    if held:
        yield joined()


def _joinable(batches, bits: int):
    """bucket, size, a, b: counts and values of words and summands by key."""

    def rows(held):
        keys, n, value = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(keys)
        keys, n, value = keys[order], n[order], value[order]
        found = [
            (bucket, end - at, packed(keys[at:end]), n[at:end].tobytes() + value[at:end].tobytes())
            for bucket, at, end in _runs((keys >> _U(64 - bits)).astype(np.int64))
        ]
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(x, kind) for x, kind in zip(zip(*found, strict=True), kinds, strict=True)],
            ["bucket", "size", "a", "b"],
        )

    held, size = [], 0
    for batch in batches:
        key, n, value = (batch.column(c).to_numpy() for c in ("key", "n", "value"))
        held.append((key.view(np.uint64), n, value))
        size += len(key)
        if size > JOINED_AT_ONCE:
            yield rows(held)
            held, size = [], 0
    if size:
        yield rows(held)


def _joined(table: pa.Table) -> pa.Table:
    """batch, size, a, b: what the joined keys of one bucket add to texts (a): how many words
    are known, their logarithms, the scores (b)."""
    rows = table.to_pylist()
    known = [r for r in rows if r["batch"] is None]
    out = []
    if known:
        keys = np.concatenate([unpacked(r["a"], r["size"]) for r in known])
        numbers = [np.frombuffer(r["b"], np.int64).reshape(2, -1) for r in known]
        n = np.concatenate([x[0] for x in numbers])
        value = np.concatenate([x[1].view(np.float64) for x in numbers])
        order = np.argsort(keys)
        keys, n, value = keys[order], n[order], value[order]
        log = np.log10(n + 1.0)
        for r in rows:
            if r["batch"] is None:
                continue
            wanted = unpacked(r["a"], r["size"])
            at, times = (from_planes(r[x], r["size"]) for x in ("b", "times"))
            place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            found = keys[place] == wanted
            place, at, times = place[found], at[found], times[found]
            if not len(at):
                continue
            texts, where = np.unique(at, return_inverse=True)
            sums = [np.bincount(where, times * x[place]) for x in (n > 0, log, value)]
            out.append((r["batch"], len(texts), packed(texts), np.concatenate(sums).tobytes()))
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
    columns = zip(*out, strict=True) if out else [[]] * len(kinds)
    return pa.table(
        [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)],
        ["batch", "size", "a", "b"],
    )


def _put_together(table: pa.Table) -> pa.Table:
    """The texts of a batch with what was joined added."""
    is_text = pa.compute.is_valid(table["at"])
    texts = table.filter(is_text)
    place = np.full(pa.compute.max(texts["at"]).as_py() + 1, -1)
    place[texts["at"].to_numpy()] = np.arange(len(texts))
    known, logs, score = (
        texts[c].to_numpy().astype(np.float64) for c in ("n_known", "logs", "score")
    )
    for r in table.filter(pa.compute.invert(is_text)).select(["size", "a", "b"]).to_pylist():
        at = place[unpacked(r["a"], r["size"]).astype(np.int64)]
        for all_, more in zip(
            (known, logs, score), np.frombuffer(r["b"], np.float64).reshape(3, -1), strict=True
        ):
            all_[at] += more
    new = [pa.array(known.round().astype(np.int64)), pa.array(logs), pa.array(score)]
    return pa.table(
        [*(texts[c] for c in ("doc_id", "held_out", "n_tokens")), *new],
        ["doc_id", "held_out", "n_tokens", "n_known", "logs", "score"],
    )


def score(docs: DataFrame, top_words: int = TOP_WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    counted = stored(
        texts.mapInArrow(_word_counts, "key bigint, n bigint")
        .groupBy("key")
        .agg(F.sum("n").alias("n")),
        "words",
    )
    words_only = counted.where("key != 0")
    ends = (counted.where("key = 0").first() or (0, 0))[1]
    top = words_only.orderBy(F.desc("n"), "key").limit(top_words).toArrow()
    known, n = top["key"].to_numpy().view(np.uint64), top["n"].to_numpy()
    distinct, tokens, once, twice = words_only.agg(
        F.count("*"), F.sum("n"), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
    ).first()
    tokens = tokens or 0
    discount = float(np.clip((once + 0.5) / (once + 2 * twice + 1), 0.05, 0.95))
    order = np.argsort(known)
    vocabulary = Vocabulary(
        known[order], n[order], ends, tokens, distinct, discount, np.zeros(1, np.uint64), np.zeros(1)
    )
    p = F.when(F.col("key") == 0, F.lit(vocabulary.end)).otherwise(
        (F.col("n") - discount) / F.lit(float(vocabulary.places))
    )
    summands = _summands(
        texts, counted, counted.select("key", p.alias("p")), tokens + ends, top_words
    )
    top = summands.orderBy(F.desc("n"), "key").limit(top_words).toArrow()
    vocabulary.put(top["key"].to_numpy().view(np.uint64), top["value"].to_numpy())
    members = Members(summands.select("key"))
    bits = bucket_bits(tokens + ends, PLACES_OF_BUCKET)
    scored = stored(
        texts.mapInArrow(
            lambda batches: _scored(batches, members, vocabulary, bits),
            f"batch bigint, at int, doc_id {kind}, held_out boolean, n_tokens bigint,"
            " n_known bigint, logs double, score double, bucket int, size int, a binary, b binary, times binary",
        ),
        "scored",
    )
    # these words were taken as unknown; the ones that are not get their own share instead
    gain = F.log10((F.col("n") - discount) / F.lit(float(vocabulary.places))) - F.lit(
        float(np.log10(vocabulary.unknown))
    )
    joinable = stored(
        words_only.select("key", "n", gain.alias("value"))
        .unionByName(summands.select("key", F.lit(0).cast("long").alias("n"), "value"))
        .mapInArrow(lambda batches: _joinable(batches, bits), "bucket int, size int, a binary, b binary"),
        "joinable",
    )
    drop(counted, summands)
    rest = (
        scored.where("bucket is not null")
        .select(*_JOINED)
        .unionByName(joinable, allowMissingColumns=True)
    )
    shares = [
        stored(
            rest.where(F.pmod("bucket", F.lit(SHARES)) == number)
            .groupBy("bucket")
            .applyInArrow(_joined, "batch bigint, size int, a binary, b binary"),
            "more",
        )
        for number in range(SHARES)
    ]
    drop(joinable)
    texts = scored.where("bucket is null").drop("bucket", "size", "a", "b", "times")
    whole = (
        reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [texts, *shares])
        .groupBy("batch")
        .applyInArrow(
            _put_together,
            f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, logs double,"
            " score double",
        )
    )
    total, types = tokens + ends, distinct + (ends > 0)
    base = F.col("logs") - F.col("n_tokens") * F.lit(float(np.log10(total + types + 1)))
    return whole.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
    )

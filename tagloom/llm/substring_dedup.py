"""Substring dedup by repeated-phrase automata.

A window is WINDOW consecutive words of one document. Words covered by a window that also
starts in a document with a smaller doc_id are removed; windows are judged on the input.

1. Texts of equal words are found by a digest; all but the one with the least doc_id go whole.
2. Recurring passages are found among the rest: the smallest hash of the GRAM-word sequences in
   a window is its anchor, so equal windows have equal anchors, and a text has far fewer anchors
   than words. Windows whose anchor occurs in several documents are hashed whole; those that
   recur are confirmed, and the least document that holds one is its owner.
3. Runs of an owner's recurring windows are the phrases. They are dealt to shards by owner, and
   each shard compiles an Aho-Corasick automaton over seeds of its phrases: every SEED-th
   sequence of SEED words, so that each window holds one. Where a seed is common to many
   phrases, the automaton gets their windows whole instead.
4. Every document is streamed through the automata of the shards that own any of its windows,
   word by word. From each seed that it holds the match is carried on to both sides, and what
   is as long as a window is an occurrence. Phrases are compared as words, hashes only propose.
   Documents of a busy shard are dealt to several copies of its automaton.

Defined results: NULL, empty and wordless texts have no word and the digest of an empty text;
rows with a NULL doc_id lose nothing and make others lose nothing; of rows that repeat a doc_id
none has a smaller id, so they do not affect each other; other columns are not read.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.graph import drop, stored, workspace
from tagloom.llm.id_filter import IdFilter, Members, chosen, with_bit
from tagloom.llm.words import Block, blocks, gram_hashes, word_hashes, words

WINDOW = 13
GRAM = 5
SEED = 7  # words; each run of WINDOW words holds a SEED-th sequence of SEED words whole
CROWD = 32  # phrases that may share a seed
SHARD_WINDOWS = 200_000  # of an automaton
SHARD_TEXT = 24 << 20  # bytes of text that one copy of it reads
STRETCH = 8192  # words of an owner that stay in one shard

_KEY = ["doc_id", "uid"]


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").split()


def digest(kept: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(kept)).hexdigest()


def _profiles(batches):
    """n_words and the digest of the whole text."""
    for batch in batches:
        n, sha = [], []
        for block in blocks(batch.column("text")):
            for i in range(block.rows):
                own = block.text(i).split()
                n.append(len(own))
                sha.append(digest(own))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("uid"), pa.array(n, pa.int64()), pa.array(sha)],
            [*_KEY, "n_words", "sha"],
        )


def anchors_of(block: Block):
    """For each word that begins a window its anchor, the window's hash, and the texts' bounds."""
    found = words(block)
    hashes = word_hashes(block.data, found)
    grams = gram_hashes(hashes, GRAM)
    span = WINDOW - GRAM + 1
    if len(grams) < span:
        none = np.zeros(0, np.uint64)
        return none, none, found.row
    least = np.lib.stride_tricks.sliding_window_view(grams, span).min(axis=1)
    return least, gram_hashes(hashes, WINDOW), found.row


def _anchors(batches, reps):
    for batch in chosen(batches, reps):
        ids = batch.column("doc_id").to_numpy()
        at = 0
        for block in blocks(batch.column("text")):
            least, _, row = anchors_of(block)
            own = [
                np.unique(least[a : b - WINDOW + 1]) if b - a >= WINDOW else least[:0]
                for a, b in zip(row[:-1].tolist(), row[1:].tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(ids[at : at + block.rows], [len(x) for x in own])),
                    pa.array(np.concatenate(own).view(np.int64)),
                ],
                ["doc_id", "anchor"],
            )
            at += block.rows


def _windows(batches, reps, shared):
    """Texts that hold shared anchors, with a number, and the windows of these anchors."""
    number = TaskContext.get().partitionId() << 33
    for batch in chosen(batches, reps):
        place, value = [], []
        for block in blocks(batch.column("text")):
            least, whole, row = anchors_of(block)
            passed = shared.passes(least)
            for a, b in zip(row[:-1].tolist(), row[1:].tolist(), strict=True):
                end = max(a, b - WINDOW + 1)
                at = np.flatnonzero(passed[a:end])
                place.append(at.astype(np.int32))
                value.append(whole[a:end][at].view(np.int64))
        found = pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(number, number + batch.num_rows)),
                *(batch.column(c) for c in (*_KEY, "text")),
                pa.array(place, pa.list_(pa.int32())),
                pa.array(value, pa.list_(pa.int64())),
            ],
            ["no", *_KEY, "text", "places", "hashes"],
        )
        yield found.filter(pa.array([len(p) > 0 for p in place], pa.bool_()))
        number += batch.num_rows


# Words are spelled in two alphabets of 32 letters: the first letter is of one, all others are of
# the other. So a node of the automaton has few branches, which are searched one by one, and a
# match can only begin where a word does.
_HEAD = "ABCDEFGHIJKLMNOPQRSTUVWXYZ!#$%&*"
_TAIL = "abcdefghijklmnopqrstuvwxyz012345"


def spellings(n: int) -> list[str]:
    """Words of one length for the numbers 0 to n - 1; 0 is of neither alphabet."""
    width = 1
    while 32**width < n:
        width += 1
    out = ["~" * width]
    for number in range(1, n):
        letters = [_HEAD[number % 32]]
        for _ in range(width - 1):
            number //= 32
            letters.append(_TAIL[number % 32])
        out.append("".join(letters))
    return out


class Phrases:
    """The phrases of a shard, one after the other as numbers of words, and an automaton."""

    def __init__(self, rows: pd.DataFrame):
        self.numbers: dict[bytes, int] = {}
        self.line: list[int] = [0]  # 0 stands between phrases and for words of none
        self.owner: list[int] = []
        self.first: list[int] = []  # where each phrase begins
        for owner, text, places in zip(
            rows["owner"].tolist(), rows["passage"], rows["places"], strict=True
        ):
            own = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in _words(text)]
            places = np.sort(np.asarray(places))
            for run in np.split(places, np.flatnonzero(np.diff(places) > 1) + 1):
                self.first.append(len(self.line))
                self.owner.append(owner)
                self.line += [*own[run[0] : run[-1] + WINDOW], 0]
        seeds: dict[tuple, list[tuple[int, int]]] = {}
        ends = [*(f - 1 for f in self.first[1:]), len(self.line) - 1]
        for owner, begin, end in zip(self.owner, self.first, ends, strict=True):
            for at in range(begin, end - SEED + 1, SEED):
                seed = tuple(self.line[at : at + SEED])
                seeds.setdefault(seed, []).append((at, owner))
        self.spelled = spellings(len(self.numbers) + 1)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        whole: dict[tuple, int] = {}
        for seed, held in seeds.items():
            if len(held) <= CROWD:
                self.automaton.add_word(self.spell(seed), held)
                continue
            for at, owner in held:  # the windows that hold this seed whole
                for begin in range(at + SEED - WINDOW, at + 1):
                    window = tuple(self.line[max(0, begin) : begin + WINDOW])
                    if begin >= 0 and len(window) == WINDOW and 0 not in window:
                        whole[window] = min(whole.get(window, owner), owner)
        for window, owner in whole.items():
            self.automaton.add_word(self.spell(window), owner)
        self.automaton.make_automaton()

    def spell(self, words) -> str:
        return "".join(map(self.spelled.__getitem__, words))

    def runs(self, doc: int, text: str) -> list[tuple[int, int]]:
        """Runs of words that phrases of smaller documents than `doc` cover."""
        line = [0, *(self.numbers.get(w, 0) for w in _words(text)), 0]
        phrase, found = self.line, []
        reach: dict[int, int] = {}  # by shift against the phrases: how far matches were carried
        width = len(self.spelled[0])
        if not len(self.automaton):
            return []
        for letter, held in self.automaton.iter(self.spell(line)):
            last = letter // width
            if isinstance(held, int):
                if held < doc:
                    found.append((last - WINDOW, last))
                continue
            begin = last - SEED + 1
            for at, owner in held:
                shift = begin - at
                if owner >= doc or reach.get(shift, -1) > begin:
                    continue
                left, right = at, at + SEED
                while phrase[left - 1] and phrase[left - 1] == line[left - 1 + shift]:
                    left -= 1
                while phrase[right] and phrase[right] == line[right + shift]:
                    right += 1
                reach[shift] = right + shift
                if right - left >= WINDOW:
                    found.append((left + shift - 1, right + shift - 1))
        merged: list[tuple[int, int]] = []
        for begin, end in sorted(found):
            if merged and begin <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
            else:
                merged.append((begin, end))
        return merged


def locate(_, docs: pd.DataFrame, phrases: pd.DataFrame) -> pd.DataFrame:
    """Runs of words of each document that phrases of smaller documents cover."""
    out = {"no": [], "begin": [], "end": []}
    if len(docs) and len(phrases):
        built = Phrases(phrases)
        for no, doc, text in zip(
            docs["no"].tolist(), docs["doc_id"].tolist(), docs["text"], strict=True
        ):
            runs = built.runs(doc, text)
            if runs:
                out["no"].append(no)
                out["begin"].append([a for a, _ in runs])
                out["end"].append([b for _, b in runs])
    return pd.DataFrame(out).astype({"no": "int64", "begin": object, "end": object})


def _removed(batches):
    """n_removed and the digest of what is left, from the runs to remove."""
    for batch in batches:
        n, sha = [], []
        for text, begins, ends in zip(
            batch.column("text").to_pylist(),
            batch.column("begins").to_pylist(),
            batch.column("ends").to_pylist(),
            strict=True,
        ):
            own = _words(text)
            step = np.zeros(len(own) + 1, np.int64)
            for some_begin, some_end in zip(begins, ends, strict=True):
                np.add.at(step, some_begin, 1)
                np.add.at(step, some_end, -1)
            gone = np.cumsum(step)[: len(own)] > 0
            n.append(int(gone.sum()))
            sha.append(digest([own[i] for i in np.flatnonzero(~gone).tolist()]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("no"), pa.array(n, pa.int64()), pa.array(sha)],
            ["no", "n_gone", "sha_left"],
        )


def recurring_passages(texts: DataFrame, reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts that share an anchor with another one, and their windows that recur, each with
    the least (doc_id, place) that holds it as `owner`."""
    wanted = IdFilter(reps, "doc_id")
    rows = with_bit(texts).where("doc_id is not null")
    anchors = rows.mapInArrow(
        lambda batches: _anchors(batches, wanted), "doc_id bigint, anchor bigint"
    )
    # All of these are aggregates that are combined before the shuffle, and joins that adaptive
    # execution splits: a passage that a third of all documents hold is no task's alone.
    shared = (
        anchors.groupBy("anchor")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .where("low != high")
        .select(F.col("anchor").alias("key"))
    )
    shared = stored(shared, "anchors")
    passing = Members(shared)
    drop(shared)
    some = rows.mapInArrow(
        lambda batches: _windows(batches, wanted, passing),
        "no bigint, doc_id bigint, uid bigint, text string, places array<int>,"
        " hashes array<bigint>",
    )
    some = stored(some, "passages")
    windows = some.select(
        "no", "doc_id", F.explode(F.arrays_zip("places", "hashes")).alias("w")
    ).select("no", "doc_id", F.col("w.places").alias("place"), F.col("w.hashes").alias("hash"))
    owners = (
        windows.groupBy("hash")
        .agg(
            F.min(F.struct("doc_id", "no", "place")).alias("owner"), F.max("doc_id").alias("high")
        )
        .where("owner.doc_id != high")
        .select("hash", "owner")
    )
    owners = stored(owners, "owners")  # only plain tables are joined in split partitions
    recurring = (
        windows.join(owners, "hash")
        .select(
            "no",
            "doc_id",
            (F.col("doc_id") > F.col("owner.doc_id")).alias("later"),
            F.expr("if(no = owner.no and place = owner.place, place, null)").alias("first"),
            F.col("owner.no").alias("owner"),
            F.floor(F.col("owner.place") / STRETCH).cast("int").alias("stretch"),
        )
        .where("later or first is not null")
    )
    recurring = stored(recurring, "recurring")
    drop(owners)
    return some.select("no", *_KEY, "text"), recurring


def located(some: DataFrame, recurring: DataFrame) -> DataFrame:
    """no, begin, end (lists): the runs that the shards' automata find."""
    n_windows = recurring.where("first is not null").count()
    n_shards = max(1, -(-n_windows // SHARD_WINDOWS))
    dealt = recurring.withColumn(
        "shard", F.pmod(F.xxhash64("owner", "stretch"), F.lit(n_shards))
    )
    phrases = (
        dealt.where("first is not null")
        .groupBy("shard", "no", "doc_id")
        .agg(F.collect_set("first").alias("places"))
    )
    routes = dealt.where("later").select("shard", "no", "doc_id").distinct()
    routes = stored(
        routes.join(some.select("no", F.octet_length("text").alias("size")), "no"), "routes"
    )
    copies = routes.groupBy("shard").agg(
        F.ceil(F.sum("size") / SHARD_TEXT).cast("int").alias("copies")
    )
    texts = some.select("no", "text")  # the same rows for all joins, so they move once
    readers = (
        routes.join(copies, "shard")
        .withColumn("copy", F.pmod(F.xxhash64("no"), F.col("copies")).cast("int"))
        .join(texts, "no")
        .select("shard", "copy", "no", "doc_id", "text")
    )
    patterns = (
        phrases.join(copies, "shard")
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
        .join(texts, "no")
        .select("shard", "copy", "doc_id", "text", "places")
        .toDF("of_shard", "of_copy", "owner", "passage", "places")
    )
    return (
        readers.groupBy("shard", "copy")
        .cogroup(patterns.groupBy("of_shard", "of_copy"))
        .applyInPandas(locate, "no bigint, begin array<int>, end array<int>")
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256; one row per row of `docs`."""
    with workspace(docs.sparkSession) as keep:
        return keep(_judged(docs))


def _judged(docs: DataFrame) -> DataFrame:
    given = docs.schema["doc_id"].dataType
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).withColumn("uid", F.xxhash64("doc_id", "text"))
    profiles = stored(
        texts.mapInArrow(_profiles, "doc_id bigint, uid bigint, n_words bigint, sha string"),
        "profiles",
    )
    least = (
        profiles.where(f"doc_id is not null and n_words >= {WINDOW}")
        .groupBy("sha")
        .agg(F.min("doc_id").alias("least"))
    )
    least = stored(least, "least")
    some, recurring = recurring_passages(texts, least.select(F.col("least").alias("doc_id")))
    runs = (
        located(some, recurring)
        .groupBy("no")
        .agg(F.collect_list("begin").alias("begins"), F.collect_list("end").alias("ends"))
    )
    left = (
        some.select("no", "text")
        .join(runs, "no")
        .mapInArrow(_removed, "no bigint, n_gone bigint, sha_left string")
        .join(some.select("no", *_KEY), "no")
        .dropDuplicates(_KEY)
        .drop("no")
    )
    copy = F.expr("least is not null and least < doc_id")
    return (
        profiles.join(least, "sha", "left")
        .join(left, _KEY, "left")
        .select(
            F.col("doc_id").cast(given).alias("doc_id"),
            "n_words",
            F.when(copy, F.col("n_words"))
            .otherwise(F.coalesce("n_gone", F.lit(0)))
            .cast("long")
            .alias("n_removed"),
            F.when(copy, F.lit(digest([])))
            .otherwise(F.coalesce("sha_left", "sha"))
            .alias("kept_sha256"),
        )
    )


ORACLE = """
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
         coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS words
  FROM documents
),
place AS (SELECT row, doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM d),
win AS (SELECT row, doc_id, i, array_to_string(words[i:i + 12], ' ') AS sequence FROM place),
least AS (SELECT sequence, min(doc_id) AS low FROM win GROUP BY 1),
gone AS (
  SELECT DISTINCT row, unnest(range(i, i + 13)) AS i
  FROM win JOIN least USING (sequence) WHERE low < doc_id
),
word AS (SELECT row, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d),
kept AS (
  SELECT row, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n
  FROM word ANTI JOIN gone USING (row, i) GROUP BY 1
)
SELECT doc_id, len(words) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (row)"""

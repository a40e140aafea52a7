"""Suffix-tree scores: base counts against plain Python, and what a distribution must be."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tagloom.llm import suffix_tree

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
END = "\n"


def held_out(doc):
    return zlib.crc32(str(doc).encode()) % 7 == 2


def expected(rows):
    tokens = [(doc, [*WORD.findall((t or "").translate(LOWER)), END]) for doc, t in rows]
    counts = Counter()
    for doc, own in tokens:
        if not held_out(doc):
            counts.update(own)
    total, distinct = sum(counts.values()), len(counts)
    return {
        doc: (
            held_out(doc), len(own), sum(counts[w] > 0 for w in own), total,
            sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own),
        )
        for doc, own in tokens
    }


def corpus():
    rng = random.Random(1)
    rows = []
    for i in range(150):
        words = []
        for _ in range(rng.randint(0, 60)):
            words += rng.choice([["The", "cat"], ["a", "dog"], [f"w{rng.randrange(400)}"]])
        rows.append((i, " ".join(words)))
    return rows + [(500, None), (501, ""), (502, "É é " * 30_000)]


@pytest.mark.parametrize("top", [0, 1 << 18])
def test_base_score(spark, top):
    rows = corpus()
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, logs string")
    got = suffix_tree.score(frame.repartition(3), top).collect()
    want = expected(rows)
    assert len(got) == len(rows)
    for r in got:
        w = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:4]
        assert r["base_score"] == pytest.approx(w[4], rel=1e-9)
        assert r["score"] < 0


def test_joined_words_score_like_those_at_hand(spark):
    frame = spark.createDataFrame(corpus(), "doc_id long, text string").repartition(2)
    few, all_ = (
        {r["doc_id"]: r["score"] for r in suffix_tree.score(frame, n).collect()} for n in (0, 1 << 18)
    )
    assert few == pytest.approx(all_, rel=1e-9)


def test_tables_without_words(spark):
    frame = spark.createDataFrame([(None, None), (1, ""), (1, "")], "doc_id long, text string")
    got = suffix_tree.score(frame).collect()
    assert [r["n_tokens"] for r in got] == [1, 1, 1]
    assert suffix_tree.score(frame.limit(0)).collect() == []


def test_known_text_is_likelier(spark):
    rows = [(i, "the cat sat on the mat and the dog sat on the log") for i in range(60)]
    rows += [(100, "log the on sat dog the and mat the on sat cat the")]
    got = {r["doc_id"]: r["score"] for r in suffix_tree.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] > got[100]


def plain_scores(rows):
    """Every context of whole words counted in plain Python."""
    lines = {d: ["\n", *WORD.findall((t or "").translate(LOWER)), "\n"] for d, t in rows}
    train = [own for d, own in lines.items() if not held_out(d)]
    first = Counter(w for own in train for w in own[1:])
    words = {w: n for w, n in first.items() if w != END}
    once, twice = (sum(n == k for n in words.values()) for k in (1, 2))
    discount = min(0.95, max(0.05, (once + 0.5) / (once + 2 * twice + 1)))
    places = sum(first.values()) + 2
    unknown = (discount * len(words) + 1) / places

    def in_empty(w):
        if w == END:
            return (first[END] + 1) / places
        return (words[w] - discount) / places if w in words else unknown

    after = {}
    for own in train:
        for i in range(1, len(own)):
            for d in range(1, min(suffix_tree.DEPTH, i) + 1):
                after.setdefault(tuple(own[i - d : i]), Counter())[own[i]] += 1
    after = {c: n for c, n in after.items() if sum(n.values()) >= suffix_tree.SUPPORT}
    model = {}
    for c, n in after.items():
        own = {w: x for w, x in n.items() if x >= suffix_tree.LEAST_NEXT}
        t = sum(n.values())
        model[c] = own, t + len(own), len(own) + t - sum(own.values()), t - sum(own.values())

    def p(c, w):
        if not c:
            return in_empty(w)
        own, total, r, _ = model[c]
        return (own.get(w, 0) + r * p(c[1:], w)) / total

    kept = set()
    for c, (own, total, r, apart) in model.items():
        gain = sum(x * math.log2(p(c, w) / p(c[1:], w)) for w, x in own.items())
        if own and gain + apart * math.log2(r / total) > suffix_tree.PARAMETER_BITS * len(own):
            kept |= {c[i:] for i in range(len(c))}
    scores = {}
    for doc, own in lines.items():
        scores[doc] = 0.0
        for i in range(1, len(own)):
            fit = [d for d in range(1, min(suffix_tree.DEPTH, i) + 1) if tuple(own[i - d : i]) in kept]
            scores[doc] += math.log10(p(tuple(own[i - max(fit, default=0) : i]), own[i]))
    return scores, kept


def with_phrases():
    """More than 62 words that are all equally frequent, in phrases and in any order."""
    rng = random.Random(2)
    names = [f"v{i}" for i in range(400)]
    rows = []
    for i in range(300):
        own = [rng.choice(names) for _ in range(60)]
        at = 8 * (i % 10)
        own[20:20] = names[at : at + 8]
        own[40:40] = [*"abcdx"] if i % 2 else [*"ebcdy"]  # only the fourth word back tells
        rows.append((i, " ".join(own)))
    return rows + [(1000, " ".join(names[:8])), (1001, " ".join(names[7::-1]))]


@pytest.mark.parametrize("top", [0, 1 << 18])
def test_contexts_are_whole_words(spark, top):
    rows = with_phrases()
    want, kept = plain_scores(rows)
    assert any(len(c) == suffix_tree.DEPTH for c in kept)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["score"] for r in suffix_tree.score(frame, top).collect()}
    assert got == pytest.approx(want, rel=1e-9)
    assert got[1000] > got[1001] + 3  # a phrase of ordinary words against the same words reversed


class Everything:
    def passes(self, keys):
        return np.ones(len(keys), bool)


def pair_rows(texts, codes, bits):
    batch = pa.RecordBatch.from_arrays(
        [pa.array([0] * len(texts)), pa.array(texts)], ["doc_id", "text"]
    )
    return list(suffix_tree._pair_counts([batch], 1, Everything(), Everything(), codes, bits))


@pytest.mark.parametrize("most", [0, 40, 1000])  # words that have numbers
def test_pairs_are_counted_from_few_bytes(most, monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(f"v{rng.randrange(250)}" for _ in range(200)) for _ in range(200)]
    block = next(suffix_tree.blocks(pa.array(texts)))
    hashes, row = suffix_tree.text_words(block)
    line, _, before = suffix_tree.between_ends(hashes, row)
    want = Counter((int(line[i - 1]), int(line[i])) for i in np.flatnonzero(before))
    words = np.unique(line)[:most]
    codes = suffix_tree.Codes(words, words)
    found = pair_rows(texts, codes, 3)
    if most > len(set(line.tolist())):
        numbered = sum((suffix_tree.Numbers(words).of(np.unique(line)) >= 0).tolist())
        coded = [r for b in found for r in b.to_pylist() if r["coded"]]
        pairs = sum(r["size"] for r in coded)
        assert numbered > 100 and pairs > numbered**2 // 3
        assert sum(len(r["a"]) + len(r["n"]) for r in coded) < 5 * pairs  # as two hashes and a count: 24
    monkeypatch.setattr(suffix_tree, "HELD", 1000)
    many = pair_rows(texts, codes, 3)
    for batches in (found, many):
        table = pa.Table.from_batches(batches)
        got = []
        for bucket in set(table["bucket"].to_pylist()):
            own = table.filter(pa.compute.equal(table["bucket"], bucket))
            out = suffix_tree._frequent_pairs(own, codes)
            got += zip(*(out[c].to_numpy() for c in ("context", "next", "n")))
        got = {tuple(int(v) % 2**64 for v in r[:2]): r[2] for r in got}
        assert got == {p: n for p, n in want.items() if n >= suffix_tree.LEAST_NEXT}


def test_keys_are_packed_without_loss():
    rng = np.random.default_rng(4)
    for size in (0, 1, 1000):
        keys = np.sort(rng.integers(0, 2**64, size, np.uint64, endpoint=False))
        assert (suffix_tree.unpacked(suffix_tree.packed(keys), size) == keys).all()


def test_summands_are_joined_by_bucket(spark):
    """Keys that no task has at hand: no join makes a row for each key of each text."""
    frame = spark.createDataFrame(with_phrases(), "doc_id long, text string")
    plan = suffix_tree.score(frame, 0)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "FlatMapGroupsInArrow" in plan

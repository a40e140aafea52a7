"""Language identification and toxicity: held-out accuracy, and rows without content."""

import random
import zlib

import numpy as np

from tagloom.llm import language_id, toxicity

SYLLABLES = {
    "aa": ["ba", "do", "ki", "lum", "ster"],
    "bb": ["zu", "pri", "che", "lla", "ño"],
    "cc": ["ön", "täk", "vär", "mii", "suo"],
}


def word(rng, lang):
    return "".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4)))


def texts(rng, lang, n):
    return [" ".join(word(rng, lang) for _ in range(rng.randint(4, 60))) for _ in range(n)]


def held_out(doc):
    return zlib.crc32(str(doc).encode()) % 4 == 2


def test_codewords_are_apart():
    for n in (2, 3, 4, 5, 9, 20):
        code = language_id.codewords(n)
        apart = min((a != b).sum() for i, a in enumerate(code) for b in code[:i])
        assert apart >= (1 if n == 2 else 2) and set(np.unique(code)) <= {-1, 1}


def test_languages(spark):
    rng = random.Random(2)
    given = [(t, lang) for lang in SYLLABLES for t in texts(rng, lang, 80)]
    rng.shuffle(given)
    rows = [(i, t, lang, "s") for i, (t, lang) in enumerate(given)]
    rows += [(1000, None, "aa", "s"), (1001, "", "aa", "s"), (1002, "12 %", "bb", None), (1003, "bado", None, "s")]
    rows += [(1004, "baki " * 100_000, None, "s"), rows[0]]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    got = language_id.identify(frame).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    right = [by_id[i]["lang_pred"] == lang for i, _, lang, _ in rows[:240] if held_out(i)]
    assert len(right) > 40 and np.mean(right) > 0.95
    assert all(r["held_out"] == held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in got)
    assert [by_id[i]["lang_pred"] for i in range(1000, 1005)] == ["und", "und", "und", "aa", "aa"]
    kept = language_id.keep_identified(frame)
    assert kept.columns == frame.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert not ids & {1000, 1001, 1002} and len(ids) >= 235


def test_languages_without_labels(spark):
    frame = spark.createDataFrame([(1, "a b", None), (None, None, None)], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in language_id.identify(frame).collect()} == {"und"}
    assert language_id.identify(frame.limit(0)).collect() == []
    one = spark.createDataFrame([(1, "a b", "aa")] * 3, "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in language_id.identify(one).collect()} <= {"aa", "und"}


def test_toxic_texts_and_misspellings(spark):
    rng = random.Random(6)
    rows, labels = [], []
    bad = ["idiotic", "scumbag", "trashy"]
    for i in range(1200):
        words = [word(rng, "aa") for _ in range(rng.randint(5, 120))]
        toxic = int(i % 4 == 0)
        if toxic:
            ugly = rng.choice(bad)
            if held_out(i):  # spellings that training never saw
                ugly = ugly[:-1] + ugly[-1] * 2
            words.insert(rng.randrange(len(words)), ugly)
        rows.append((i, " ".join(words), toxic))
        labels.append((i, 0, toxic))
    rows += [(9000, None, 0), (9001, "", 0), (9002, "ba " * 50_000, 0), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    marks = spark.createDataFrame(
        labels + [(None, 0, 1), (5, None, None), (0, 0, 0)], "doc_id long, quality int, toxic int"
    )
    got = toxicity.toxicity(docs, marks).collect()
    assert len(got) == len(rows)
    unseen = [r for r in got if r["held_out"] and r["doc_id"] < 1200]
    truth = {i: t for i, _, t in rows}
    hit = [r["predicted"] for r in unseen if truth[r["doc_id"]]]
    miss = [r["predicted"] for r in unseen if not truth[r["doc_id"]]]
    assert np.mean(hit) > 0.85 and np.mean(miss) < 0.1
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in toxicity.toxicity(docs, none).collect()} == {0.0}
    assert toxicity.toxicity(docs.limit(0), none).collect() == []

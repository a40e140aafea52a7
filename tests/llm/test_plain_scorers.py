"""Predictions of the fitted classifiers against scorers in plain Python, a text at a time."""

import math
import random
import re

import numpy as np
import pytest

from tagloom.llm import language_id, toxicity
from tagloom.llm.words import mix

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def buckets(word, sizes, bits):
    """Numbers of the n-grams of a lower-cased word between two marks."""
    marked = [2, *word.lower(), 2]  # bytes.lower changes A-Z only
    for n in sizes:
        for i in range(len(marked) - n + 1):
            value = 0
            for code in marked[i : i + n]:
                value = (value * 0x100000001B3 + code + 1) % 2**64
            yield int(mix(np.array([value ^ (n << 56)], np.uint64))[0]) >> (64 - bits)


def made_up(seed, n):
    rng = random.Random(seed)
    parts = {"aa": ["ba", "Do", "ki", "lum"], "bb": ["zu", "pri", "ñoch"], "cc": ["ön", "täk", "vä"]}
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(parts))
        words = ["".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(1, 40))]
        toxic = rng.random() < 0.4
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["grumblefoo", "Grumbelfoo", "blarghit"])
        rows.append((i, " ".join(words), lang, int(toxic)))
    return rows + [(n, None, None, 0), (n + 1, "", None, 0), (n + 2, "x" * 9000 + " 12", None, 0)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = made_up(4, 240)
    schema = "doc_id long, text string, lang string, toxic int"
    return rows, spark.createDataFrame(rows, schema)


def test_languages(docs):
    rows, frame = docs
    model = language_id.fit(frame)
    trust = [t / sum(model["trust"]) for t in model["trust"]]
    got = {r.doc_id: r for r in language_id.predict(frame, model).collect()}
    for doc, text, _, _ in rows:
        if not any(c.isalpha() for c in text or ""):
            assert (got[doc].lang_pred, got[doc].score) == ("und", 0)
            continue
        found = [b for w in WORD.findall(text.encode()) for b in buckets(w, language_id.SIZES, language_id.BITS)]
        margins = [
            math.fsum(float(model["weight"][b][j]) for b in found) / len(found) + model["bias"][j]
            for j in range(len(trust))
        ]
        loss = [
            math.fsum(t * math.log1p(math.exp(-m * c)) for t, m, c in zip(trust, margins, word))
            for word in model["code"]
        ]
        best = loss.index(min(loss))
        score = 1 / sum(math.exp(-(x - min(loss)) * len(trust)) for x in loss)
        assert got[doc].lang_pred == model["langs"][best]
        assert got[doc].score == pytest.approx(score, abs=1e-4)
        second = sorted(loss)[1] - min(loss)
        if abs(second - language_id.MARGIN) > 1e-4:
            assert got[doc].ambiguous == (second < language_id.MARGIN)


def test_toxicity(spark, docs, monkeypatch):
    rows, frame = docs
    fitted = toxicity.fit(frame.drop("toxic"), frame.select("doc_id", "toxic"))
    monkeypatch.setattr(toxicity, "fit", lambda *_: fitted)
    table, (_, bias) = fitted
    got = {r.doc_id: r for r in toxicity.toxicity(frame.drop("toxic"), frame).collect()}
    half = toxicity.WINDOW // 2
    for doc, text, _, _ in rows:
        each = []
        for word in WORD.findall((text or "").encode()):
            found = list(buckets(word, toxicity.SIZES, toxicity.BITS))
            each.append(math.fsum(float(table[b]) for b in found) / len(found))
        worst = 0.0
        if each:
            begins = range(0, max(1, len(each) - half), half)
            worst = max(
                np.mean(each[max(0, min(b, len(each) - toxicity.WINDOW)) :][: toxicity.WINDOW])
                for b in begins
            )
        score = 1 / (1 + math.exp(-(worst + bias)))
        assert got[doc].score == pytest.approx(score, abs=1e-4)
        assert got[doc].predicted == int(got[doc].score >= toxicity.THRESHOLD)

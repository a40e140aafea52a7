"""Substring dedup against all windows in plain Python."""

import hashlib
import random
import re

from tagloom.llm import substring_dedup as dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(given):
    texts = [(doc, WORD.findall(text or "")) for doc, text in given]
    first = {}
    for doc, words in texts:
        for k in range(len(words) - 12):
            if doc is not None:
                window = tuple(words[k : k + 13])
                first[window] = min(first.get(window, doc), doc)
    out = []
    for doc, words in texts:
        gone = set()
        for k in range(len(words) - 12):
            if doc is not None and first[tuple(words[k : k + 13])] < doc:
                gone.update(range(k, k + 13))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(frame):
    return sorted((tuple(r) for r in dedup.remove_repeats(frame).collect()), key=repr)


def test_all_windows(spark, monkeypatch):
    monkeypatch.setattr(dedup, "SHARD_WINDOWS", 150)
    monkeypatch.setattr(dedup, "SHARD_TEXT", 8000)
    monkeypatch.setattr(dedup, "STRETCH", 10)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)] + ["É", "é", "W1"]
    passages = [[rng.choice(words) for _ in range(rng.randint(5, 50))] for _ in range(25)]
    given = []
    for _ in range(400):
        text = []
        for _ in range(rng.randint(0, 4)):
            if rng.random() < 0.5:
                text += rng.choice(passages)[rng.randint(0, 6) :]
            else:
                text += [rng.choice(words) for _ in range(rng.randint(0, 30))]
        given.append((rng.randrange(350), rng.choice([" ", "\n", "  "]).join(text)))
    frame = spark.createDataFrame(given + given[:20], "doc_id long, text string").repartition(4)
    assert found(frame) == expected(given + given[:20])


def test_edge_cases(spark):
    line = " ".join(f"a{i}" for i in range(13))
    given = [
        (1, line), (2, line), (2, line), (3, line.upper()), (4, ""), (5, None), (6, " \n"),
        (None, line), (7, "x " * 40), (8, "x " * 14), (9, "x " * 12), (10, f"b {line} c {line}"),
        (0, "y " * 30_000 + line), (11, "y " * 100),
    ]
    frame = spark.createDataFrame(
        [(d, t, 1, "u") for d, t in given], "doc_id long, text string, n_words int, uid string"
    )
    assert found(frame) == expected(given)
    assert found(frame.limit(0)) == []


def test_one_passage_in_most_documents(spark):
    line = " ".join(f"p{i}" for i in range(20))
    given = [(i, f"own{i} {line} tail{i}") for i in range(600)]
    frame = spark.createDataFrame(given, "doc_id long, text string").repartition(5)
    assert found(frame) == expected(given)

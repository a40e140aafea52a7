"""Decontamination against a whole edit-distance table."""

import random
import re

import pytest

from tagloom.llm import decontaminate


def normal(text):
    return re.sub(rb"[^0-9a-z\x80-\xff]+", b" ", (text or "").encode().lower()).strip()


def least_edits(item, text):
    """Of any region of `text` to `item`."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def expected(text, items):
    text, out = normal(text), set()
    for name, item in items:
        item = normal(item)
        if len(item) >= decontaminate.SHORTEST:
            if least_edits(item, text) <= int(decontaminate.BUDGET * len(item)):
                out.add(name)
        elif item and b" " + item + b" " in b" " + text + b" ":
            out.add(name)
    return sorted(out)


def sentence(rng, n):
    return " ".join(rng.choice(["the", "of", "thion", "an", "erst", "wh", "ing", "ré"]) for _ in range(n))


def given():
    rng = random.Random(3)
    items = [(i, sentence(rng, rng.randint(14, 40))) for i in range(12)]
    items += [(50, "Short one"), (51, "tiny"), (52, ""), (53, None), (2, "an other text"), (54, "x" * 49)]
    rows = []
    for i in range(60):
        name, item = rng.choice(items[:12])
        text = list(item)
        for _ in range(int(len(normal(item)) * rng.choice([0, 0.04, 0.08, 0.1, 0.11, 0.14]))):
            at = rng.randrange(len(text))
            text[at : at + rng.randint(0, 1)] = rng.choice(["", "z", " ", "q"])
            text = text or ["a"]
        rows.append((i, sentence(rng, rng.randint(0, 30)) + " " + "".join(text).upper() + ", " + sentence(rng, 5)))
    rows += [
        (100, None), (101, ""), (102, "a TINY, thing"), (103, "short  one"), (104, "shorty one"),
        (105, items[0][1]), (105, items[0][1]), (106, "word " * 60_000 + items[1][1]), (None, items[0][1]),
    ]
    return items, rows


@pytest.mark.parametrize("item_bytes", [8 << 20, 400])
def test_regions(spark, monkeypatch, item_bytes):
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", item_bytes)
    items, rows = given()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, items string")
    benchmark = spark.createDataFrame([(*r, "y") for r in items], "item_id long, text string, doc_id string")
    got = decontaminate.contamination(docs, benchmark).collect()
    want = {d: expected(t, items) if d != 106 else [1] for d, t in rows}
    assert {r["doc_id"] for r in got} == set(want)
    for r in got:
        assert r["item_ids"] == want[r["doc_id"]] and r["contaminated"] == bool(want[r["doc_id"]])
    kept = decontaminate.keep_clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d in want if not want[d]}


def test_places(spark):
    item = "Some passage of a benchmark that is long enough to be looked for with edits."
    docs = spark.createDataFrame([(1, f"Before. {item} After.")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, item)], "item_id long, text string")
    row = decontaminate.contamination(docs, benchmark).first()
    assert row["regions"] == f"7:8:{8 + len(item) - 1}:0"  # the last stop is no part of a word


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, "text")], "item_id long, text string")
    assert decontaminate.contamination(docs.limit(0), benchmark).collect() == []
    assert decontaminate.contamination(docs, benchmark.limit(0)).first()["contaminated"] is False
    assert decontaminate.keep_clean(docs, benchmark.limit(0)).count() == 1


def test_short_items_have_edits(spark):
    for m in range(decontaminate.SHORTEST, 500):
        k, q = decontaminate.edit_budget(m), decontaminate.gram_size(m)
        assert k == int(decontaminate.BUDGET * m)  # the whole budget
        assert m + 1 - q - k * q > 0  # and the lemma still says something
    item = "the quick brown fox jumps over the lazy dog"  # 43 bytes
    docs = spark.createDataFrame(
        [(1, f"so {item} it says"), (2, f"so {item} it says".replace("jumps", "jumqs")), (3, "the quick dog")],
        "doc_id long, text string",
    )
    benchmark = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {r["doc_id"]: r["contaminated"] for r in decontaminate.contamination(docs, benchmark).collect()}
    assert got == {1: True, 2: True, 3: False}


@pytest.mark.parametrize("m, edits", [(20, 2), (23, 2), (30, 3), (31, 3), (16, 1), (32, 3)])
def test_items_of_any_length_have_their_whole_budget(spark, m, edits):
    rng = random.Random(m)
    item = "".join(rng.choice("abcdefghij") for _ in range(m))
    texts = {}
    for number in range(30):
        text = list(item)
        for at in rng.sample(range(m), edits + number % 2):
            text[at] = "z"
        texts[number] = "so " + "".join(text) + " it goes"
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = decontaminate.contamination(docs, benchmark).collect()
    assert {r.doc_id for r in got if r.contaminated} == {
        i for i, t in texts.items() if expected(t, [(7, item)])
    } >= set(range(0, 30, 2))


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    """Rows are told apart by more than their id, and regions of one item by more than its id."""
    items, rows = given()
    twice = [(1, items[3][1]), (1, "clean"), (None, items[4][1]), (None, "clean too"), (1, "clean")]
    both = items[0][1] + " " + items[1][1] + " and " + items[1][1]
    rows = rows + twice + [(300, both)]
    items = items + [(0, items[5][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")

    def found():
        got = decontaminate.contamination(docs, benchmark).collect()
        return sorted((tuple(r) for r in got), key=repr)

    want = found()
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 300)
    assert found() == want


def test_what_goes_to_tasks_is_no_larger_than_the_items():
    import pickle

    import pyarrow as pa

    rng = random.Random(1)
    texts = [sentence(rng, 60) for _ in range(2000)]
    items = decontaminate.index_items(list(range(2000)), pa.array(texts))
    size = sum(len(t.encode()) for t in texts)
    assert items.indexes and len(pickle.dumps(items)) < 1.5 * size

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from tagloom.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_ranks(docs, items, top=10):
    """The ranks by the formula, a document and an item at a time."""
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for doc, bag in bags:
            m = 25 + (75 * sum(bag.values()) * n_docs) // n_terms
            score = 0
            for t in terms(text):
                if t in bag:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        scores.sort()
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(scores[:top])]
    return sorted(out, key=repr)


def ranks(spark, docs, items, **kw):
    found = lexical_search.ranked(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string"),
        **kw,
    )
    return sorted((tuple(r) for r in found.collect()), key=repr)


def made_up(seed, n):
    rng = np.random.default_rng(seed)
    some = ["alpha", "Beta", "GAMMA", "δέλτα", "e1", "zeta", "été", "eta"]
    return [
        (int(i), " ".join(rng.choice(some, rng.integers(0, 12)).tolist())) for i in range(n)
    ]


def test_ranks_are_those_of_the_formula(spark):
    docs = made_up(1, 300) + [(400 + i, "alpha beta, alpha") for i in range(40)]
    items = [(1, "Alpha beta beta"), (2, "été-été δέλτα"), (3, "nowhere"), (4, None), (5, "")]
    assert ranks(spark, docs, items) == plain_ranks(docs, items)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "a b"), (5, "a " * 5000), (4, "a b")]
    items = [(1, "a"), (1, "b a"), (None, "b")]
    assert ranks(spark, docs, items) == plain_ranks(docs, items)
    assert ranks(spark, [], items) == []
    assert ranks(spark, docs, []) == []
    assert ranks(spark, [(1, None)], items) == []


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    docs, items = made_up(2, 200), [(i, t) for i, t in made_up(3, 30)]
    want = ranks(spark, docs, items)
    monkeypatch.setattr(lexical_search, "ITEM_BYTES", 100)
    assert ranks(spark, docs, items) == want


def test_small_slices_change_nothing(spark):
    best = lexical_search._Best(2, 2)
    for scores, first in (([[5, 0], [5, 1]], [9, 3]), ([[5, 7], [6, 1]], [1, 8])):
        best.offer(np.array(scores, float), np.array(first), np.array(first) * 10)
    assert best.item.tolist() == [0, 0, 1, 1]
    assert best.score.tolist() == [6, 5, 7, 1]
    assert best.row.tolist() == [80, 10, 10, 30]
    assert list(lexical_search._slices(np.array([1, 2, 3]), 1 << 30)) == [(0, 1), (1, 2), (2, 3)]


@pytest.mark.parametrize("copies", [5000])
def test_a_class_of_many_copies_is_scored_once(spark, copies):
    docs = [(i, "alpha beta") for i in range(copies)] + [(copies, "alpha beta gamma")]
    items = [(1, "beta"), (2, "gamma alpha")]
    assert ranks(spark, docs, items) == plain_ranks(docs, items)
    items = lexical_search.Items(["beta", "gamma alpha"])
    rows = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = lexical_search.vectors(rows, items.vocabulary)
    assert lexical_search.classes(found, copies + 1, 2 * copies + 3, 10).count() == 2


def test_sql_gives_the_same(spark, sf_dir):
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS FROM '{sf_dir}/{table}.parquet'")
    want = connection.execute(lexical_search.ORACLE).fetchall()
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    found = lexical_search.ranked(docs, items.withColumn("doc_id", items.item_id))
    assert sorted(tuple(r) for r in found.collect()) == sorted(want)

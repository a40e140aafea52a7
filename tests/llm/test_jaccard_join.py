"""The n-gram Jaccard join against all pairs in plain Python."""

import random
import re
from collections import Counter

import pytest

from tagloom.llm import jaccard_join as join

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def expected(given):
    sets = [shingles(text) for _, text in given]
    parent = list(range(len(given)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    nodes, holders = {}, {}
    for k, (doc, _) in enumerate(given):
        if doc is not None and sets[k]:  # rows of one doc_id are one node
            parent[root(k)] = root(nodes.setdefault(doc, k))
    for k, own in enumerate(sets):
        if given[k][0] is None:
            continue
        shared = Counter(j for g in own for j in holders.get(g, ()))
        for j, n in shared.items():
            if 100 * n >= 80 * (len(own) + len(sets[j]) - n):
                parent[root(k)] = root(j)
        for g in own:
            holders.setdefault(g, []).append(k)
    least = {}
    for k, (doc, _) in enumerate(given):
        if doc is not None:
            least[root(k)] = min(least.get(root(k), doc), doc)
    return sorted(
        (
            (doc, len(sets[k]), None if doc is None else least[root(k)] if sets[k] else doc)
            for k, (doc, _) in enumerate(given)
        ),
        key=repr,
    )


def found(frame):
    return sorted(
        (tuple(r) for r in join.link_components(frame).select("doc_id", "n_shingles", "component_id").collect()),
        key=repr,
    )


def corpus(seed, n, repeat=False):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    texts = [[rng.choice(words) for _ in range(rng.randint(1, 90))] for _ in range(n // 20)]
    passage = [rng.choice(words) for _ in range(40)]
    given = []
    for i in range(n):
        text = list(rng.choice(texts))
        if rng.random() < 0.3:
            text += passage
        for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
            at = rng.randrange(len(text) + 1)
            text[at : at + rng.randint(0, 1)] = [rng.choice(words)]
        given.append((rng.randrange(n) if repeat else i, " ".join(text)))
    return given


@pytest.mark.parametrize("seed, heavy_from", [(1, 64), (2, 1)])
def test_all_links_are_found(spark, monkeypatch, seed, heavy_from):
    monkeypatch.setattr(join, "HEAVY_FROM", heavy_from)
    monkeypatch.setattr(join, "SHARE", 2)
    given = corpus(seed, 500)
    assert found(spark.createDataFrame(given, "doc_id long, text string").repartition(3)) == expected(given)


def test_edges_cases(spark):
    given = [
        (9, "a b"), (8, "A  b"), (7, ""), (6, None), (5, " \t"), (4, "x y z v w"), (3, "x y z v w"),
        (2, "one"), (1, "é"), (0, "É"), (None, "a b"), (4, "a b"), (3, "x y z v w"),
        (20, "long " * 20_000), (21, "long " * 20_001),
    ]
    frame = spark.createDataFrame(
        [(d, t, "en", 1) for d, t in given], "doc_id long, text string, class_id string, n int"
    )
    assert found(frame) == expected(given)
    assert found(frame.limit(0)) == []


def test_similarity_at_the_limit(spark):
    base = [f"b{i}" for i in range(49)]  # 45 shingles
    given = [(0, " ".join(base))]
    for i in range(1, 12):  # i words more: 45 / (45 + i)
        given.append((i, " ".join(base + [f"c{i}{j}" for j in range(i)])))
    assert found(spark.createDataFrame(given, "doc_id long, text string")) == expected(given)


def test_a_large_group_of_near_copies(spark):
    """Thousands of different texts that are all alike cost rows in proportion."""
    base = [f"b{i}" for i in range(80)]
    given = []
    for i in range(1500):
        text = list(base)
        text[i % 80] = f"n{i}"
        given.append((i, " ".join(text)))
    given += [(5000 + i, " ".join(base)) for i in range(800)]
    got = found(spark.createDataFrame(given, "doc_id long, text string").repartition(4))
    assert {c for _, _, c in got} == {0} and len(got) == len(given)


def test_one_of_each_group_stays(spark):
    given = [(3, "a b c d e f"), (1, "a b c d e f"), (2, "other words are here now"), (4, "")]
    frame = spark.createDataFrame([(d, t, "x") for d, t in given], "doc_id long, text string, extra string")
    kept = join.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4]


def joined_rows(frame):
    """Rows that the joins of a frame's plan on prefix shingles make."""
    frame.collect()
    found, left = 0, [frame._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            left.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            left.append(node.plan())
        elif name.endswith("Join"):
            found += node.metrics().apply("numOutputRows").value()
        children = node.children()
        left += [children.apply(i) for i in range(children.size())]
    return found


def family(seed, n, changes):
    """Near copies of one text, of which many do not link with each other, and their own words."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(120)]
    given = []
    for i in range(n):
        text = list(base)
        for at in rng.sample(range(120), rng.choice(changes)):
            text[at] = f"n{i}x{at}"
        given.append((i, " ".join(text)))
    return given


def test_a_family_of_far_copies_joins_few_rows(spark, monkeypatch):
    """The join on prefix shingles makes a row or so a pair, not one for each shared shingle."""
    given, made = family(3, 120, [3, 4, 5]), []
    real = join._group_pairs

    def counted(entries, mixed):
        pairs = real(entries, mixed)
        made.append((joined_rows(pairs), entries.count()))
        return pairs

    monkeypatch.setattr(join, "_group_pairs", counted)
    assert found(spark.createDataFrame(given, "doc_id long, text string")) == expected(given)
    [(rows, entries)] = made
    assert rows < entries


def test_hubs_join_a_family(spark, monkeypatch):
    """Copies that link through the least changed ones are one component before the last round."""
    monkeypatch.setattr(join, "CROWDED", 50)
    monkeypatch.setattr(join, "FIRST", 1)
    given, seen = family(4, 150, [0, 1, 2, 3]), []
    real = join._group_pairs

    def counted(entries, mixed):
        seen.append((mixed.agg({"pairs": "sum"}).first()[0] or 0, entries.count()))
        return real(entries, mixed)

    monkeypatch.setattr(join, "_group_pairs", counted)
    assert found(spark.createDataFrame(given, "doc_id long, text string")) == expected(given)
    [(pairs, entries)] = seen
    assert pairs < 20 * entries

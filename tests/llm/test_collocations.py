import re
from collections import Counter, defaultdict

import duckdb
import numpy as np

from tagloom.llm import collocations

LOWER = {i: i + 32 for i in range(65, 91)}
SCHEMA = "lang string, text string"


def plain(docs, support, most):
    """The rows by the definition, from counts of all phrases."""
    n, f = Counter(), defaultdict(Counter)
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    f[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, counts in f.items():
        rows = []
        for p, a in counts.items():
            if len(p) < 2 or a < support:
                continue
            cuts = [(2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            longer = (
                q
                for q, b in counts.items()
                if len(q) > len(p) and b >= support and 100 * b >= 80 * a
            )
            if any(q[i : i + len(p)] == p for q in longer for i in range(len(q) - len(p) + 1)):
                continue
            rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:most]):
            out.append((lang, rank + 1, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def found(spark, docs, support, most):
    df = spark.createDataFrame(docs, SCHEMA)
    return sorted(tuple(r) for r in collocations.collocations(df, support, most).collect())


def made_up(seed, texts):
    rng = np.random.default_rng(seed)
    some = ["an", "Bo", "cé", "d'e", "ff", "#g", "界", "i"]
    marks = [" ", "  ", "\t", ". ", ",", "\n", "; ", " ", " ", " "]
    return [
        (
            str(rng.choice(["en", "de", ""])),
            "".join(rng.choice(some) + rng.choice(marks) for _ in range(rng.integers(0, 60))),
        )
        for _ in range(texts)
    ]


def test_phrases_are_those_of_the_definition(spark):
    docs = made_up(1, 150) + [(None, "One two three four five. one two three four")] * 40
    for support, most in ((3, 2000), (30, 2000), (5, 7)):
        assert found(spark, docs, support, most) == plain(docs, support, most)


def test_odd_texts(spark):
    docs = [("en", None), ("en", ""), ("en", " . \n\t,"), (None, "a"), ("x", "a a a a a a a a")]
    docs += [("en", "Ab cd " * 3000), ("en", "ab, cd"), ("EN", "ab cd")] * 2
    assert found(spark, docs, 2, 50) == plain(docs, 2, 50)
    assert found(spark, [], 2, 50) == []
    assert found(spark, [("en", None)], 2, 50) == []


def test_small_blocks_part_no_piece(spark, monkeypatch):
    docs = made_up(2, 120)
    want = plain(docs, 3, 2000)
    for name, value in (("TEXT_AT_ONCE", 64), ("ROW_WORDS", 4), ("COMBINE", 10)):
        monkeypatch.setattr(collocations, name, value)
    assert found(spark, docs, 3, 2000) == want


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    docs = made_up(3, 100)

    class Everything(collocations.GroupFilter):
        def __init__(self, groups, names):
            self.bits = np.full(collocations.FILTER_BITS // 8, 255, np.uint8)

    monkeypatch.setattr(collocations, "GroupFilter", Everything)
    assert found(spark, docs, 4, 2000) == plain(docs, 4, 2000)


def test_tasks_hand_on_a_row_for_each_bucket(spark, monkeypatch):
    monkeypatch.setattr(collocations, "COUNTS_OF_BUCKET", 8)
    text = " ".join(f"w{i * i % 101}" for i in range(400))
    docs = spark.createDataFrame([("en", text)] * 3, SCHEMA).coalesce(1)
    every = collocations.GroupFilter(collocations.word_counts(docs).selectExpr("w as w1"), ["w1"])
    relation = collocations.first_relation(docs, every)
    want = Counter(Counter(zip(text.split(), text.split()[1:])).values())
    for places in (0, 20, 200):
        packed = collocations.packed_counts(relation, 2, places).collect()
        buckets = [row["bucket"] for row in packed]
        assert len(set(buckets)) == len(buckets) <= max(4, places // 4)
        n = np.concatenate([np.frombuffer(row["n"], np.int32) for row in packed])
        assert n.sum() == 3 * 399
        counted = collocations.phrase_counts(relation, 2, places, 1).collect()
        assert Counter(row["n"] for row in counted) == {3 * n: many for n, many in want.items()}
        often = collocations.phrase_counts(relation, 2, places, 12).collect()
        assert sorted(often) == sorted(row for row in counted if row["n"] >= 12)


def test_small_buckets_change_nothing(spark, monkeypatch):
    docs = made_up(4, 120)
    monkeypatch.setattr(collocations, "COUNTS_OF_BUCKET", 2)
    monkeypatch.setattr(collocations, "COMBINE", 50)
    assert found(spark, docs, 3, 2000) == plain(docs, 3, 2000)


def test_the_join_is_by_adjacent_position():
    place = np.array([0, 1, 3, 4, 5, (1 << 32) + 6])
    left, (a, b) = collocations.merge_join(place, [np.array([10, 11, 12, 13, 14, 15])])
    assert left.tolist() == [0, 2, 3]
    assert (a.tolist(), b.tolist()) == ([10, 12, 13], [11, 13, 14])


def test_sql_gives_the_same(spark, sf_dir):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS FROM '{sf_dir}/documents.parquet'")
    want = connection.execute(collocations.ORACLE).fetchall()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("word", collocations.F.lit(1))
    assert want
    assert sorted(tuple(r) for r in collocations.collocations(docs).collect()) == sorted(want)

"""Nearest neighbours against brute force; packing against a plain best fit."""

import random

import numpy as np
import pytest

from tagloom.llm import ann_tree, packing


def brute(rows, every, k=10):
    out = {}
    for i, (q, x) in enumerate(rows):
        if q is None or q % every:
            continue
        away = sorted(
            (float(np.sqrt(((np.array(y) - np.array(x)) ** 2).sum())), v)
            for j, (v, y) in enumerate(rows)
            if j != i
        )
        out[q] = away[:k]
    return out


def test_recall(spark, monkeypatch):
    monkeypatch.setattr(ann_tree, "BLOCK", 64)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 16)) * 4
    rows = [(i, (centres[i % 30] + rng.normal(size=16)).tolist()) for i in range(3000)]
    rows += [(4000 + i, rows[7][1]) for i in range(400)]  # equal vectors
    frame = spark.createDataFrame([(i, v, 1.0) for i, v in rows], "vec_id long, embedding array<double>, score double")
    got = ann_tree.nearest(frame.repartition(3), "vec_id", "embedding").collect()
    want = brute(rows, 100)
    assert len(got) == 10 * len(want)
    assert all(r["rank"] in range(1, 11) for r in got)
    close = [r["score"] <= want[r["query_id"]][-1][0] + 1e-12 for r in got]
    assert np.mean(close) >= 0.9
    for q in (4000, 4100):  # ties go to the smaller id
        assert [r["vec_id"] for r in got if r["query_id"] == q] == [v for _, v in want[q]]


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]),
        (6, []), (7, [1.0, 1.0, 1.0]), (8, [1.0, 2.0]), (9, [1.0, 2.0]), (None, [1.0, 3.0]), (100, [0.0, 0.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann_tree.nearest(frame, "vec_id", "embedding").collect()
    assert [tuple(r) for r in got] == [(0, 1, 8, 2.0), (0, 2, 9, 2.0)]
    assert ann_tree.nearest(frame.limit(0), "vec_id", "embedding").collect() == []
    alone = ann_tree.nearest(frame.where("vec_id = 0"), "vec_id", "embedding")
    assert alone.collect() == []


def plain_best_fit(sizes, lengths, cost):
    """The same rules, looking at every bin and every piece each time."""
    todo = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    rooms, used, touched, where = [], [], [], {}

    def fill(room, rest):
        total = 0
        for size in (sizes[i] for i in rest):
            if total + size <= room:
                total += size
        return total

    for n, piece in enumerate(todo):
        size = sizes[piece]
        fitting = [(room, -touched[b], b) for b, room in enumerate(rooms) if room >= size]
        if fitting:
            number = min(fitting)[2]  # of equal rooms the one last put into
        else:
            number = len(rooms)
            rest = todo[n + 1 :]
            rooms.append(
                min(
                    (x for x in lengths if x >= size),
                    key=lambda x: (cost(x) / (size + fill(x - size, rest)), -x),
                )
            )
            used.append(0)
            touched.append(n)
        rooms[number] -= size
        used[number] += size
        touched[number] = n
        where[piece] = number
    return where, [min(x for x in lengths if x >= u) for u in used]


@pytest.mark.parametrize("seed", range(6))
def test_pack_like_a_plain_best_fit(seed):
    rng = random.Random(seed)
    lengths = (8, 16, 40)
    sizes = [rng.randint(1, 40 if seed % 2 else 14) for _ in range(80)]
    where, offset, final = packing.pack(sizes, lengths)
    plain_where, plain_final = plain_best_fit(sizes, lengths, packing.bin_cost)
    assert where == [plain_where[i] for i in range(len(sizes))] and final == plain_final
    for number, length in enumerate(final):
        inside = sorted((offset[i], sizes[i]) for i in range(len(sizes)) if where[i] == number)
        assert [o for o, _ in inside] == [sum(s for _, s in inside[:i]) for i in range(len(inside))]
        assert sum(s for _, s in inside) <= length


def test_documents_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK", 7)
    given = [(1, "a " * 9000), (2, None), (3, ""), (4, "x y"), (4, "x y"), (None, "z"), (5, "q " * 4096)]
    given += [(10 + i, "w " * (i * 37 % 900)) for i in range(40)]
    frame = spark.createDataFrame([(d, t, "b") for d, t in given], "doc_id long, text string, bin_id string")
    got = packing.best_fit_packing(frame.repartition(2)).collect()
    tokens = {}
    for r in got:
        tokens[r["doc_id"]] = tokens.get(r["doc_id"], 0) + r["n_tokens"]
        assert (r["bin_id"] is None) == (r["n_tokens"] == 0)
    want = {}
    for doc, text in given:
        want[doc] = want.get(doc, 0) + len((text or "").split())
    assert tokens == want
    bins = {}
    for r in got:
        if r["bin_id"] is not None:
            bins.setdefault((r["bin_id"], r["capacity"]), []).append((r["offset"], r["n_tokens"]))
    assert len({b for b, _ in bins}) == len(bins)
    for (_, capacity), held in bins.items():
        held.sort()
        assert held[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(held, held[1:]))
        assert held[-1][0] + held[-1][1] <= capacity and capacity in packing.LENGTHS
    assert packing.best_fit_packing(frame.limit(0)).collect() == []


def test_bins_fill_alike_however_the_rows_are_stored(spark):
    docs = spark.range(4000).selectExpr(
        "id as doc_id", "repeat('w ', int(pmod(xxhash64(id), 900)) + 1) as text"
    )
    fill = []
    for parts in (1, 8, 200):
        got = packing.best_fit_packing(docs.repartition(parts))
        bins = got.groupBy("bin_id", "capacity").agg({"n_tokens": "sum"}).collect()
        fill.append(sum(b[2] for b in bins) / sum(b["capacity"] for b in bins))
    assert min(fill) > 0.99 and max(fill) - min(fill) < 0.005


def test_large_leaves_get_trees_of_their_own(spark, monkeypatch):
    """Leaves stay small however large the table is against the first sample."""
    for name, value in (
        ("SAMPLE", 100), ("LEAF_SAMPLE", 6), ("LEAF_ROWS", 40), ("LARGE", 120),
        ("SUB_SAMPLE", 200), ("ASSIGNED", 150), ("BLOCK", 64),
    ):
        monkeypatch.setattr(ann_tree, name, value)
    compared = []
    real = ann_tree._with_trees
    monkeypatch.setattr(
        ann_tree, "_with_trees", lambda *a: compared.append(a[3]) or real(*a)
    )
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(60, 12)) * 3
    rows = [(i, (centres[i % 60] + rng.normal(size=12)).tolist()) for i in range(5000)]
    rows += [(6000 + i, rows[7][1]) for i in range(300)]  # equal vectors cannot be told apart
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann_tree.nearest(frame.repartition(3), "vec_id", "embedding").collect()
    assert sorted(set(compared)) == ["q", "query_row", "row"]
    want = brute(rows, 100)
    assert len(got) == 10 * len(want)
    close = [r["score"] <= want[r["query_id"]][-1][0] + 1e-12 for r in got]
    assert np.mean(close) >= 0.9
    for q in (6000, 6100):
        assert [r["vec_id"] for r in got if r["query_id"] == q] == [v for _, v in want[q]]

"""Connected components against union and find."""

import random

import pytest

from tagloom.llm import graph
from tagloom.llm.graph import components


def expected(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return sorted((x, root(x)) for x in parent)


GRAPHS = {
    "chain": [(i, i + 1) for i in range(300)],
    "hub": [(10_000, i) for i in range(500)] + [(0, 1)],
    "random": [(random.Random(i).randrange(400), random.Random(-i - 1).randrange(400)) for i in range(250)],
    "loops": [(5, 5), (7, 8), (8, 7)],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_components(spark, name):
    edges = GRAPHS[name]
    frame = spark.createDataFrame(edges, "a long, b long").repartition(3)
    got = sorted(map(tuple, components(frame).collect()))
    assert got == expected([(a, b) for a, b in edges if a != b])


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_a_workspace_leaves_only_its_result(spark):
    frame = spark.range(3).toDF("a")
    with graph.workspace(spark) as outer:
        with graph.workspace(spark) as keep:
            inner = graph.stored(frame, "step")
            result = keep(inner.selectExpr("a + 1 as a"))
        with pytest.raises(Exception):
            inner.collect()
        assert sorted(r.a for r in result.collect()) == [1, 2, 3]
        last = outer(result.where("a > 1"))
    assert sorted(r.a for r in last.collect()) == [2, 3]
    with pytest.raises(Exception):
        result.collect()

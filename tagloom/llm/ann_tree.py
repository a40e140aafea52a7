"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted in numpy on a bounded sample (SAMPLE vectors, the first by a hash of the id);
every vector is then put into the leaf that the tree leads it to. Leaves that hold more than
LARGE rows get a tree of their own, fitted in a task on a sample of that leaf (about SUB_SAMPLE
vectors), so leaves hold about LEAF_ROWS rows and not a share of the table. These trees are rows
of a table that meets the vectors and queries of their leaf; they are sent to no other task.

A query goes through the tree best bin first: a priority queue holds branches by the distance to
their centres, and leaves are visited in the order in which they come out. How many leaves are visited is calibrated: for a
few sampled queries the true neighbours are found by brute force over all rows, and the visits
are widened until RECALL of them lie in visited leaves; in leaves with a tree of their own, the
visits there are calibrated in the same way. A query goes on, whatever the number,
until its leaves hold enough rows for k neighbours.

Queries meet the rows of their leaves in a join on the leaf; large leaves are dealt to blocks,
so equal vectors in any number make more blocks and not a larger one. Each block gives its best k
per query, and these are merged.

Defined results: vectors that are NULL, empty, zero, hold a NULL or non-finite component, or
are not of the most frequent length take no part; a NULL id neither; an id on several rows is
several candidates, a query row for each, none of which is its own candidate.
"""

from __future__ import annotations

import heapq
import pickle
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.graph import stored, workspace

SAMPLE = 20_000
BRANCHES = 8
LEAF_ROWS = 1024  # rows a leaf should hold, as far as the sample allows
LEAF_SAMPLE = 12  # sampled vectors a leaf needs at least
BLOCK = 2048  # rows of a leaf that are compared at once
CALIBRATED = 64  # queries
RECALL = 0.97
MARGIN = 1.25  # visits beyond those of the calibration
LARGE = 8 * LEAF_ROWS  # rows from which a leaf gets a tree of its own
SUB_SAMPLE = 4_000
SUB_LEAVES = 1 << 16  # more than such a tree can have: leaf * SUB_LEAVES + leaf of its own tree
ASSIGNED = 20_000  # rows that a task puts into such a tree at once


@dataclass
class Tree:
    """Nodes with the centres of their children; a leaf has none."""

    centres: list[np.ndarray | None] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0

    def grow(self, rows: np.ndarray, most: int, rng) -> int:
        """A node over some sampled vectors; its number."""
        node = len(self.centres)
        self.centres.append(None)
        self.children.append([])
        self.leaf.append(-1)
        centres, group = _kmeans(rows, BRANCHES, rng) if len(rows) > most else (None, None)
        if centres is None or len(centres) < 2:
            self.leaf[node] = self.leaves
            self.leaves += 1
            return node
        self.centres[node] = centres
        self.children[node] = [
            self.grow(rows[group == g], most, rng) for g in range(len(centres))
        ]
        return node

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each vector: always on to the nearest centre."""
        out = np.zeros(len(rows), np.int64)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, at = todo.pop()
            if self.centres[node] is None:
                out[at] = self.leaf[node]
                continue
            nearest = _squares(rows[at], self.centres[node]).argmin(1)
            todo += [
                (child, at[nearest == g])
                for g, child in enumerate(self.children[node])
                if (nearest == g).any()
            ]
        return out

    def best_bins(self, query: np.ndarray):
        """Leaves, the most promising first."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            while self.centres[node] is not None:
                away = ((self.centres[node] - query) ** 2).sum(1)
                first = int(away.argmin())
                for g, child in enumerate(self.children[node]):
                    if g != first:
                        heapq.heappush(queue, (float(away[g]), child))
                node = self.children[node][first]
            yield self.leaf[node]


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x**2).sum(1)[:, None] - 2 * x @ y.T + (y**2).sum(1)[None]


def _kmeans(rows: np.ndarray, k: int, rng, rounds: int = 8):
    """Centres that have rows, and each row's centre."""
    start = np.unique(rows, axis=0)
    if len(start) < 2:
        return None, None
    centres = start[rng.choice(len(start), min(k, len(start)), replace=False)]
    group = _squares(rows, centres).argmin(1)
    for _ in range(rounds):
        used, group = np.unique(group, return_inverse=True)
        sums = np.zeros((len(used), rows.shape[1]))
        np.add.at(sums, group, rows)
        centres = sums / np.bincount(group)[:, None]
        group = _squares(rows, centres).argmin(1)
    used, group = np.unique(group, return_inverse=True)
    return centres[used], group


def usable(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """id and vector (doubles) of the rows that take part."""
    rows = vectors.select(
        F.col(key).cast("long").alias("vec_id"),
        F.col(column).cast("array<double>").alias("vector"),
    ).where(
        "vec_id is not null and size(vector) > 0"
        " and not exists(vector, x -> x is null or isnan(x) or abs(x) = double('Infinity'))"
        " and exists(vector, x -> x != 0)"
    )
    size = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n"))
    first = size.first()
    return rows.where(F.size("vector") == (first["n"] if first else 0))


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def fit(rows: DataFrame, n: int) -> Tree:
    cut = int(min(1.0, (SAMPLE + 500) / max(1, n)) * (1 << 30))
    order = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(1 << 30))
    draw = rows.where(order < cut).orderBy(order, "vec_id").limit(SAMPLE).select("vector").toArrow()
    sample = _matrix(draw["vector"])
    tree = Tree()
    most = max(LEAF_SAMPLE, int(np.ceil(LEAF_ROWS * len(sample) / max(1, n))))
    tree.grow(sample, most, np.random.default_rng(11))
    return tree


def _nearest(queries, query_rows, ids, row_keys, vectors, k):
    """For each query the k nearest of some rows, itself left out: index of query and row, distance."""
    out_q, out_r, out_d = [], [], []
    for q in range(len(queries)):
        gap = vectors - queries[q]
        away = np.sqrt((gap * gap).sum(1))
        other = row_keys != query_rows[q]
        at = np.flatnonzero(other)
        if len(at) > k:
            edge = np.partition(away[at], k - 1)[k - 1]
            at = at[away[at] <= edge]
        at = at[np.lexsort((ids[at], away[at]))][:k]
        out_q.append(np.full(len(at), q))
        out_r.append(at)
        out_d.append(away[at])
    return np.concatenate(out_q), np.concatenate(out_r), np.concatenate(out_d)


def _true_neighbours(rows: DataFrame, picked: pa.Table, tree: Tree, k: int) -> list[tuple]:
    """For sampled queries (number, leaf, vector) of the true neighbours, by brute force over all
    rows."""
    queries, own = _matrix(picked["vector"]), picked["row"].to_numpy()

    def block(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column("vector"))
            ids = batch.column("vec_id").to_numpy()
            q, r, d = _nearest(queries, own, ids, batch.column("row").to_numpy(), vectors, k)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(q),
                    pa.array(ids[r]),
                    pa.array(tree.assign(vectors)[r]),
                    pa.array(d),
                    batch.column("vector").take(pa.array(r)),
                ],
                ["q", "vec_id", "leaf", "score", "vector"],
            )

    best = Window.partitionBy("q").orderBy("score", "vec_id")
    found = (
        rows.mapInArrow(
            block, "q bigint, vec_id bigint, leaf bigint, score double, vector array<double>"
        )
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("q", "leaf", "vector")
        .collect()
    )
    return [tuple(r) for r in found]


def calibrate(rows: DataFrame, asked: DataFrame, tree: Tree, k: int) -> tuple[int, list]:
    """Leaves to visit so that RECALL of the true neighbours of sampled queries are met; and
    (number, leaf, query, neighbour) of these."""
    picked = asked.orderBy(F.xxhash64("vec_id", "row")).limit(CALIBRATED).toArrow()
    if not picked.num_rows or tree.leaves < 2:
        return 1, []
    true = _true_neighbours(rows, picked, tree, k)
    visits, queries = [], _matrix(picked["vector"])
    for q, query in enumerate(queries):
        rank = {leaf: i + 1 for i, leaf in enumerate(tree.best_bins(query))}
        visits += [rank[leaf] for number, leaf, _ in true if number == q]
    visits = np.sort(visits)
    widened = 1
    while visits.size and (visits <= widened).mean() < RECALL:
        widened += 1
    pairs = [(q, leaf, queries[q].tolist(), list(vector)) for q, leaf, vector in true]
    return min(tree.leaves, int(np.ceil(widened * MARGIN))), pairs


def fit_large(placed: DataFrame, counts: dict[int, int]) -> DataFrame:
    """leaf and tree (pickled) of the leaves that hold more than LARGE rows."""
    share = F.create_map(
        *(F.lit(x) for leaf, c in counts.items() for x in (leaf, min(1.0, SUB_SAMPLE / c)))
    )[F.col("leaf")]
    drawn = F.pmod(F.xxhash64("vec_id", "vector", "row"), F.lit(1 << 30)) < share * (1 << 30)
    sizes = dict(counts)

    def grow(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        sample = np.stack(rows.sort_values(["vec_id", "row"])["vector"].to_list())
        tree = Tree()
        most = max(LEAF_SAMPLE, int(np.ceil(LEAF_ROWS * len(sample) / sizes[key[0]])))
        tree.grow(sample, most, np.random.default_rng(11))
        return pd.DataFrame({"leaf": [key[0]], "tree": [pickle.dumps(vars(tree))]})

    large = placed.where(F.col("leaf").isin(list(counts))).where(drawn)
    return large.groupBy("leaf").applyInPandas(grow, "leaf bigint, tree binary")


def _numbers(count):
    """0 to count - 1."""
    return F.sequence(F.lit(0).cast("long"), count.cast("long") - 1)


def _with_trees(rows: DataFrame, trees: DataFrame, counts: dict[int, int], by: str, meet, schema):
    """meet(rows, tree) for the rows of each leaf with a tree, ASSIGNED of them at a time."""
    parts = {leaf: -(-c // ASSIGNED) for leaf, c in counts.items()}
    number = F.create_map(*(F.lit(x) for pair in parts.items() for x in pair))
    dealt = rows.where(F.col("leaf").isin(list(counts))).withColumn(
        "part", F.pmod(F.xxhash64(by), number[F.col("leaf")]).cast("long")
    )
    spread = trees.withColumn(
        "part", F.explode(_numbers(number[F.col("leaf")]))
    )

    def run(_: tuple, some: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        if not len(some) or not len(tree):
            return some.iloc[:0].reindex(columns=names)
        return meet(some, Tree(**pickle.loads(tree["tree"].iloc[0])))[names]

    names = [f.split()[0] for f in schema.split(", ")]
    return (
        dealt.groupBy("leaf", "part")
        .cogroup(spread.groupBy("leaf", "part"))
        .applyInPandas(run, schema)
    )


_PLACED = "vec_id bigint, vector array<double>, row bigint, leaf bigint"


def _place_in_trees(placed: DataFrame, trees: DataFrame, counts: dict[int, int]) -> DataFrame:
    """All rows, those of large leaves in the leaves of their own trees."""

    def assign(rows: pd.DataFrame, tree: Tree) -> pd.DataFrame:
        own = tree.assign(np.stack(rows["vector"].to_list()))
        return rows.assign(leaf=rows["leaf"] * SUB_LEAVES + own)

    fine = _with_trees(placed, trees, counts, "row", assign, _PLACED)
    rest = placed.where(~F.col("leaf").isin(list(counts)))
    return fine.unionByName(rest.withColumn("leaf", F.col("leaf") * SUB_LEAVES))


def _visits_in_trees(
    true: DataFrame, trees: DataFrame, counts: dict[int, int]
) -> int:
    """Leaves to visit in a leaf's own tree, from (vector of a query, vector of a neighbour)."""

    def ranks(rows: pd.DataFrame, tree: Tree) -> pd.DataFrame:
        found = tree.assign(np.stack(rows["neighbour"].to_list()))
        out = []
        for query, leaf in zip(rows["query"], found.tolist()):
            order = enumerate(tree.best_bins(np.asarray(query)), 1)
            out.append(next(i for i, bin_ in order if bin_ == leaf))
        return pd.DataFrame({"visits": out})

    seen = _with_trees(true, trees, counts, "q", ranks, "visits bigint").toArrow()
    visits = np.sort(seen["visits"].to_numpy())
    at = min(len(visits) - 1, int(np.ceil(RECALL * len(visits)))) if len(visits) else 0
    return int(np.ceil(visits[at] * MARGIN)) if len(visits) else 1


def nearest(
    vectors: DataFrame, key: str, column: str, every: int = 100, k: int = 10
) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is divisible by `every`."""
    with workspace(vectors.sparkSession) as keep:
        return keep(_searched(vectors, key, column, every, k))


def _searched(vectors: DataFrame, key: str, column: str, every: int, k: int) -> DataFrame:
    rows = usable(vectors, key, column).withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows, "vectors")
    n = rows.count()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not n:
        return vectors.sparkSession.createDataFrame([], schema)
    tree = fit(rows, n)
    asked = rows.where(F.col("vec_id") % every == 0)
    visits, true = calibrate(rows, asked, tree, k)

    def to_leaves(batches):
        for batch in batches:
            leaf = tree.assign(_matrix(batch.column("vector")))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaf, pa.int64())], [*batch.schema.names, "leaf"]
            )

    placed = stored(rows.mapInArrow(to_leaves, _PLACED), "leaves")
    counts = {r[0]: r[1] for r in placed.groupBy("leaf").count().collect()}  # a row per leaf
    large = {leaf: c for leaf, c in counts.items() if c > LARGE}

    def to_visits(batches):
        for batch in batches:
            number, leaf = [], []
            for i, query in enumerate(_matrix(batch.column("vector"))):
                seen = held = 0
                for bin_ in tree.best_bins(query):
                    if seen >= visits and held > k:
                        break
                    seen += 1
                    held += counts.get(bin_, 0)
                    number.append(i)
                    leaf.append(bin_)
            take = pa.array(number, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(take),
                    batch.column("row").take(take),
                    batch.column("vector").take(take),
                    pa.array(leaf, pa.int64()),
                ],
                ["query_id", "query_row", "query", "leaf"],
            )

    sent_schema = "query_id bigint, query_row bigint, query array<double>, leaf bigint"
    sent = asked.select("vec_id", "row", "vector").mapInArrow(to_visits, sent_schema)
    if large:
        trees = stored(fit_large(placed, large), "trees")
        pairs = vectors.sparkSession.createDataFrame(
            true, "q bigint, leaf bigint, query array<double>, neighbour array<double>"
        )
        inside = _visits_in_trees(pairs, trees, large)
        placed = stored(_place_in_trees(placed, trees, large), "fine")

        def into_tree(some: pd.DataFrame, tree: Tree) -> pd.DataFrame:
            number, leaf = [], []
            for i, (query, top) in enumerate(zip(some["query"], some["leaf"].tolist())):
                for seen, bin_ in enumerate(tree.best_bins(np.asarray(query))):
                    # each leaf holds a row of the sample at least, so these hold k others
                    if seen >= max(inside, k + 1):
                        break
                    number.append(i)
                    leaf.append(top * SUB_LEAVES + bin_)
            out = some.iloc[number].reset_index(drop=True)
            return out.assign(leaf=leaf)

        asked_of = {leaf: max(1, n // every) for leaf in large}
        fine = _with_trees(sent, trees, asked_of, "query_row", into_tree, sent_schema)
        rest = sent.where(~F.col("leaf").isin(list(large)))
        sent = fine.unionByName(rest.withColumn("leaf", F.col("leaf") * SUB_LEAVES))
        sent = stored(sent, "visits")
    sizes = placed.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    sizes = stored(sizes, "sizes")
    sent = sent.join(sizes, "leaf").select(
        "query_id", "query_row", "query", "leaf", F.explode(_numbers(F.col("blocks"))).alias("part")
    )
    part = F.pmod(F.xxhash64("row"), F.col("blocks")).cast("long").alias("part")
    dealt = placed.join(sizes, "leaf").select("vec_id", "vector", "row", "leaf", part)

    def meet(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "query_row": [], "vec_id": [], "score": []})
        ids = right["vec_id"].to_numpy()
        q, r, d = _nearest(
            np.stack(left["query"].to_list()),
            left["query_row"].to_numpy(),
            ids,
            right["row"].to_numpy(),
            np.stack(right["vector"].to_list()),
            k,
        )
        return pd.DataFrame(
            {
                "query_id": left["query_id"].to_numpy()[q],
                "query_row": left["query_row"].to_numpy()[q],
                "vec_id": ids[r],
                "score": d,
            }
        )

    best = Window.partitionBy("query_id", "query_row").orderBy("score", "vec_id")
    return (
        sent.groupBy("leaf", "part")
        .cogroup(dealt.groupBy("leaf", "part"))
        .applyInPandas(meet, "query_id bigint, query_row bigint, vec_id bigint, score double")
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

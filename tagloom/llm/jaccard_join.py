"""N-gram Jaccard join by grouped prefixes.

A document's set holds its distinct shingles of SHINGLE words, as 64-bit values. Two documents
link if the Jaccard similarity of their sets is SIMILARITY percent or more. In one global order
of shingles, two such sets share a shingle among the first |set| - required + 1 of each, the
prefix. So:

1. Shingles that many documents hold go to the end of the order, the most frequent ones last;
   the others are ordered by value. How often a shingle occurs is estimated from all documents,
   from a share of their (document, shingle) pairs; at most HEAVY_MOST of the most frequent ones
   are treated so. Any such list gives the same links; it only spares candidates.
2. Documents with the same set are one class, and classes with the same prefix and size are
   one group; only groups enter the join.
3. A first round verifies a few neighbours of each class (those that share one of its first
   shingles, the least class first) and joins what links into components.
   Where large groups of near copies still leave more pairs to look at than follow from the
   number of entries, the least changed copies are tried against the others in the same way.
4. The last round pairs groups over all prefix shingles, but only across components, filters
   pairs by size and by the most shingles they can share given the matches in their prefixes,
   expands the rest to members and verifies these on whole sets. Nothing is capped: what the
   first round has settled just need not be paired again. That bound holds already at each
   match, with the shingles that either part shares with any other component from there on,
   the rarest first. So pairs that share one passage, and families of copies that each have
   changed too much, fail it in the join itself, and a pair makes no row at its later matches.

Pairs inside a component are not listed: one link chain holds it together. The result has one
row per input row.

Defined results: NULL, empty and wordless texts have an empty set, link with nothing and are
their own component; a text of fewer words than a shingle has one element, its whole sequence;
rows that repeat a doc_id are one node (their component is that of the smallest doc_id reached
by any of them) and each keeps its own set size; rows with a NULL doc_id get a NULL component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.graph import components, step_settings, stored, workspace
from tagloom.llm.id_filter import IdFilter, chosen, with_bit
from tagloom.llm.words import (
    LOWER,
    NOT_SPACE,
    Block,
    blocks,
    gram_hashes,
    gram_starts,
    mix,
    word_hashes,
    words,
)

SHINGLE = 5
SIMILARITY = 80  # percent
HEAVY_MOST = 1 << 17  # shingles at the end of the order, 1 MB to every task
HEAVY_FROM = 64  # estimated documents that make a shingle heavy
SHARE = 32  # one in so many (document, shingle) pairs is counted
FIRST = 8  # shingles that find neighbours in the first round
# If crowded shingles promise more than so many pairs per entry, their hubs are tried.
PAIRS_PER_ENTRY = 2
CROWDED = 1000  # pairs

_U = np.uint64


def shingle_sets(block: Block, k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle values of each text of a block."""
    found = words(block, NOT_SPACE)
    hashes = word_hashes(LOWER[block.data], found)
    grams = gram_hashes(hashes, k)
    starts = gram_starts(found, k)[: len(grams)]
    out = []
    for a, b in zip(found.row[:-1].tolist(), found.row[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(grams[a:b][starts[a:b]]))
        elif b > a:
            out.append(gram_hashes(hashes[a:b], b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def prefix_length(n):
    """Elements that must hold a common one: a linked partner shares s % of the set at least."""
    return n - -(-SIMILARITY * n // 100) + 1  # n minus the ceiling, and one


def _pairs_counted(batches):
    """A share of all (document, shingle) pairs, drawn by a hash of both."""
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        drawn = []
        for block in blocks(batch.column("text")):
            for i, values in enumerate(shingle_sets(block)):
                salt = mix(np.array([(ids[block.first + i] or 0) & (2**64 - 1)], np.uint64))
                drawn.append(values[mix(values ^ salt) % _U(SHARE) == 0])
        values, n = np.unique(np.concatenate(drawn or [np.zeros(0, _U)]), return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(values.view(np.int64)), pa.array(n)], ["shingle", "n"]
        )


class Heavy:
    """The most frequent shingles, at most HEAVY_MOST: sorted, with their places by frequency."""

    def __init__(self, rarest_first: np.ndarray):
        place = np.argsort(rarest_first)
        self.values, self.place = rarest_first[place], place

    def places(self, values: np.ndarray) -> np.ndarray:
        """Each shingle's place among the heavy ones, -1 for the others."""
        if not len(self.values):
            return np.full(len(values), -1)
        at = np.minimum(np.searchsorted(self.values, values), len(self.values) - 1)
        return np.where(self.values[at] == values, self.place[at], -1)


def heavy_shingles(docs: DataFrame) -> Heavy:
    counts = (
        docs.mapInArrow(_pairs_counted, "shingle bigint, n bigint")
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") * SHARE >= HEAVY_FROM)
    )
    with step_settings(docs.sparkSession):
        top = counts.orderBy(F.desc("n"), "shingle").limit(HEAVY_MOST).toArrow()
    order = np.lexsort((top["shingle"].to_numpy(), top["n"].to_numpy()))
    return Heavy(top["shingle"].to_numpy()[order].view(np.uint64))


def ordered(values: np.ndarray, heavy: Heavy) -> np.ndarray:
    """The set in the global order."""
    place = heavy.places(values)
    late = place >= 0
    return np.concatenate((values[~late], values[late][np.argsort(place[late])]))


def _order_number(value: np.ndarray, heavy: Heavy) -> int:
    """Where a shingle stands in the global order: 62 bits of its value, or a place above these."""
    place = int(heavy.places(np.array([value], np.uint64))[0])
    return (1 << 62) + place if place >= 0 else int(value >> _U(2))


def _profiles(batches, heavy):
    """What the grouping needs of each document: sizes, digests and the first shingles."""
    for batch in batches:
        out = {name: [] for name in ("n", "set_a", "set_b", "prefix_id", "last", "first")}
        for block in blocks(batch.column("text")):
            for values in shingle_sets(block):
                order = ordered(values, heavy)
                head = order[: prefix_length(len(values))] if len(values) else values
                ramp = np.arange(len(head), dtype=np.uint64)
                out["n"].append(len(values))
                out["set_a"].append(_digest(values))
                out["set_b"].append(_digest(values ^ _U(0x5BD1E995)))
                out["prefix_id"].append(_digest(head + ramp))
                out["last"].append(_order_number(head[-1], heavy) if len(head) else 0)
                out["first"].append(head[:FIRST].view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id")]
            + [
                pa.array(v, pa.list_(pa.int64()) if k == "first" else pa.int64())
                for k, v in out.items()
            ],
            ["doc_id", *out],
        )


def _digest(values: np.ndarray) -> int:
    return int(mix(values).sum(dtype=np.uint64).view(np.int64))


def _whole_sets(batches, members):
    for batch in chosen(batches, members):
        sets = [s.tobytes() for block in blocks(batch.column("text")) for s in shingle_sets(block)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sets, pa.binary())], ["doc_id", "elements"]
        )


def _prefix_rows(batches, members, heavy):
    for batch in chosen(batches, members):
        ids = batch.column("doc_id").to_numpy()
        at = 0
        for block in blocks(batch.column("text")):
            heads = [
                ordered(v, heavy)[: prefix_length(len(v))] if len(v) else v
                for v in shingle_sets(block)
            ]
            sizes = [len(h) for h in heads]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(ids[at : at + block.rows], sizes)),
                    pa.array(np.concatenate(heads).view(np.int64)),
                ],
                ["part_id", "shingle"],
            )
            at += block.rows


def _verified(batches):
    for batch in batches:
        keep = []
        for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
            x = np.frombuffer(left.as_buffer(), np.uint64)
            y = np.frombuffer(right.as_buffer(), np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= SIMILARITY * (len(x) + len(y) - both))
        yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those pairs (a, b) of documents whose whole sets link."""
    pairs = stored(pairs.distinct(), "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    members = IdFilter(wanted, "id")
    sets = texts.where("doc_id is not null").mapInArrow(
        lambda batches: _whole_sets(batches, members), "doc_id bigint, elements binary"
    )
    sets = stored(sets, "sets")
    return (
        pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("elements").alias("left")), "a")
        .join(sets.select(F.col("doc_id").alias("b"), F.col("elements").alias("right")), "b")
        .select("a", "b", "left", "right")
        .mapInArrow(_verified, "a bigint, b bigint")
    )


def _fits(n: str, m: str) -> str:
    """Sizes whose sets can link."""
    return f"100 * least({n}, {m}) >= {SIMILARITY} * greatest({n}, {m})"


def _first_pairs(classes: DataFrame) -> DataFrame:
    """Each class with the most central one and the next smaller one that share a first shingle.

    Central is here a class whose first shingles are held by many: of near copies one that was
    changed little, which the others are nearest to.
    """
    entries = classes.select(
        F.col("class_id").alias("b"), "n", F.explode("first").alias("shingle")
    )
    held = entries.groupBy("shingle").agg(F.count("*").alias("many")).where("many > 1")
    entries = entries.join(held, "shingle")
    centre = entries.groupBy("b").agg(F.sum(F.log2("many")).alias("centre"))
    placed = entries.join(centre, "b")
    hubs = placed.groupBy("shingle").agg(
        F.max_by(F.struct("b", "n"), F.struct("centre", -F.col("b"))).alias("hub")
    )
    star = (
        placed.join(hubs, "shingle")
        .where("b != hub.b")
        .selectExpr("hub.b as a", "b", "hub.n as m", "n")
    )
    # the class before it in order of size; the classes of a shingle are dealt to several
    # windows by their ids, which only leaves out some neighbours in this round
    spread = Window.partitionBy("shingle", F.pmod(F.xxhash64("b"), F.lit(16))).orderBy("n", "b")
    chain = entries.select(
        F.lag("b").over(spread).alias("a"), "b", F.lag("n").over(spread).alias("m"), "n"
    ).where("a is not null")
    return (
        star.unionByName(chain)
        .where(_fits("m", "n"))
        .where("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    )


def _shared_entries(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """Prefix shingles that several group parts hold."""
    several = rows.withColumn("many", F.count("*").over(Window.partitionBy("shingle")))
    return stored(several.where("many > 1").drop("many").join(heads, "part_id"), "entries")


def _mixed_shingles(entries: DataFrame) -> DataFrame:
    """Shingles of several components: the usual one, and the pairs that they would give."""
    return (
        entries.groupBy("shingle", "component")
        .agg(F.count("*").alias("many"))
        .groupBy("shingle")
        .agg(
            F.max_by("component", F.struct("many", "component")).alias("usual"),
            F.count("*").alias("components"),
            F.sum("many").alias("held"),
            ((F.sum("many") - F.max("many")) * F.sum("many")).alias("pairs"),
        )
        .where("components > 1")
    )


def _hub_pairs(entries: DataFrame, mixed: DataFrame) -> DataFrame:
    """In crowded shingles, each part with the most central one, if in another component.

    Central is what shares most of its prefix with others: of near copies the one that was
    changed least, which the others are nearest to.
    """
    length = f"(n - ceil({SIMILARITY} * n / 100.0) + 1)"
    central = entries.groupBy("part_id", "n").agg(F.count("*").alias("shared"))
    central = central.selectExpr("part_id", f"shared / {length} as centre")
    crowded = mixed.where(f"pairs >= {CROWDED}").select("shingle")
    near = stored(entries.join(crowded, "shingle").join(central, "part_id"), "crowded")
    hubs = near.groupBy("shingle").agg(
        F.max_by(
            F.struct("part_id", "component", "n"), F.struct("centre", -F.col("part_id"))
        ).alias("hub")
    )
    return (
        near.join(hubs, "shingle")
        .where("component != hub.component")
        .where(_fits("n", "hub.n"))
        .select(
            F.greatest("part_id", "hub.part_id").alias("a"),
            F.least("part_id", "hub.part_id").alias("b"),
        )
    )


def _with_component(rows: DataFrame, node: str, links: DataFrame) -> DataFrame:
    """`rows` with the component of each node; nodes without links are their own."""
    found = components(links).withColumnRenamed("node", node)
    return rows.join(found, node, "left").withColumn("component", F.coalesce("component", node))


def _group_pairs(entries: DataFrame, mixed: DataFrame) -> DataFrame:
    """Pairs of group parts in different components that pass the prefix bound."""
    # the component that most entries of a shingle have is not paired with itself, so a large
    # group of copies costs as many rows as it has entries beside it
    mixed = entries.join(mixed.select("shingle", "usual", "held"), "shingle")
    # In the order of their holders, rarest first, these shingles are a prefix join once more: a
    # pair that needs t matches has its first one where t of either part are still to come, and
    # only matches up to there are joined. So the shingles that many parts hold mostly drop out.
    rarest_last = Window.partitionBy("part_id").orderBy(F.desc("held"), "shingle")
    mixed = stored(
        mixed.withColumn("to_come", F.row_number().over(rarest_last)).drop("held"),
        "mixed_entries",
    )
    part = F.struct("part_id", "n", "last")
    left = mixed.where("component != usual").select(
        "shingle", "component", "to_come", part.alias("x")
    )
    right = mixed.select(
        "shingle",
        F.col("component").alias("component_b"),
        F.col("to_come").alias("to_come_b"),
        (F.col("component") == F.col("usual")).alias("is_usual"),
        part.alias("y"),
    )
    # of the set whose prefix ends first, all up to that end is compared
    rest = [f"({v}.n - ({v}.n - ceil({SIMILARITY} * {v}.n / 100.0) + 1))" for v in "xy"]
    enough = (
        f" + case when x.last < y.last then {rest[0]} when x.last > y.last then {rest[1]}"
        f" else greatest({rest[0]}, {rest[1]}) end"
        f" >= ceil({SIMILARITY} * (x.n + y.n) / {100 + SIMILARITY}.0)"
    )
    return (
        left.join(right, "shingle")
        .where("component != component_b and (is_usual or x.part_id < y.part_id)")
        .where(_fits("x.n", "y.n"))
        .where(f"least(to_come, to_come_b) {enough}")
        .select(
            F.least("x", "y").alias("x"),
            F.greatest("x", "y").alias("y"),
            F.least("to_come", "to_come_b").alias("to_come"),
        )
        .groupBy("x", "y")
        # behind the last joined match there may be as many more as are to come
        .agg((F.count("*") + F.min("to_come") - 1).alias("matches"))
        .where(f"matches {enough}")
        .selectExpr("x.part_id as part_a", "y.part_id as part_b")
    )


def link_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, class_id, component_id; one row per row of `docs`."""
    with workspace(docs.sparkSession) as keep:
        return keep(_linked(docs))


def _linked(docs: DataFrame) -> DataFrame:
    given = docs.schema["doc_id"].dataType
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    marked = with_bit(texts)
    heavy = heavy_shingles(texts)
    profiles = stored(
        texts.mapInArrow(
            lambda batches: _profiles(batches, heavy),
            "doc_id bigint, n bigint, set_a bigint, set_b bigint, prefix_id bigint, last bigint,"
            " first array<bigint>",
        ),
        "profiles",
    )
    key = ["n", "set_a", "set_b"]
    ids = (
        profiles.where("n > 0 and doc_id is not null")
        .groupBy(*key)
        .agg(F.min("doc_id").alias("class_id"))
    )
    members = stored(profiles.join(ids, key, "left"), "members")
    classes = stored(
        members.where("doc_id = class_id")
        .dropDuplicates(["class_id", *key])
        .select("class_id", "n", "prefix_id", "last", "first"),
        "classes",
    )
    found = stored(verify(_first_pairs(classes), marked), "links")
    parts = stored(_with_component(classes.drop("first"), "class_id", found), "parts")
    group = ["n", "prefix_id", "component"]
    groups = parts.groupBy(*group).agg(F.min("class_id").alias("part_id"))
    inside = stored(parts.join(groups, group), "groups")
    heads = inside.where("class_id = part_id").select("part_id", "component", "n", "last")
    wanted = IdFilter(heads, "part_id")
    rows = marked.where("doc_id is not null").mapInArrow(
        lambda batches: _prefix_rows(batches, wanted, heavy), "part_id bigint, shingle bigint"
    )
    entries = _shared_entries(rows, heads)
    mixed = stored(_mixed_shingles(entries), "mixed")
    expected = mixed.where(f"pairs >= {CROWDED}").agg(F.sum("pairs")).first()[0] or 0
    if expected > PAIRS_PER_ENTRY * entries.count():
        # once: a shingle's hub does not depend on components, so it would be the same again
        hubs = verify(_hub_pairs(entries, mixed), marked)
        found = stored(found.unionByName(hubs), "links")
        entries = stored(
            _with_component(entries.drop("component"), "part_id", found), "entries"
        )
        mixed = stored(_mixed_shingles(entries), "mixed")
    pairs = _group_pairs(entries, mixed)
    more = verify(
        pairs.join(inside.selectExpr("part_id as part_a", "class_id as a"), "part_a")
        .join(inside.selectExpr("part_id as part_b", "class_id as b"), "part_b")
        .where("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")),
        marked,
    )
    repeated = (  # rows of one doc_id with different sets are one node
        members.where("class_id is not null")
        .groupBy("doc_id")
        .agg(F.max("class_id").alias("a"), F.min("class_id").alias("b"))
        .where("a != b")
        .select("a", "b")
    )
    final = components(found.unionByName(more).unionByName(repeated))
    return members.join(final.withColumnRenamed("node", "class_id"), "class_id", "left").select(
        F.col("doc_id").cast(given).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id"))
        .cast(given)
        .alias("class_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class_id", "doc_id"))
        .cast(given)
        .alias("component_id"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, one document of each component: the smallest doc_id.

    Rows with a NULL doc_id stay; of rows that repeat a doc_id one stays.
    """
    verdict = link_components(docs).where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(verdict, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.select(*docs.columns).unionByName(docs.where("doc_id is null"))


ORACLE = """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS row, doc_id,
         coalesce(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x20\\x09-\\x0D]+'), []) AS words
  FROM documents
),
shingle AS (
  SELECT DISTINCT row, array_to_string(words[i:i + 4], ' ') AS s
  FROM (SELECT row, words, unnest(range(1, greatest(len(words) - 3, least(len(words), 1) + 1))) AS i
        FROM d)
),
size AS (SELECT row, count(*) AS n, list_sort(list(s)) AS elements FROM shingle GROUP BY 1),
class AS (
  SELECT elements, min(doc_id) AS class_id FROM size JOIN d USING (row) GROUP BY 1
),
pair AS (
  SELECT a.row AS x, b.row AS y, count(*) AS shared
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.row < b.row GROUP BY 1, 2
),
link AS (
  SELECT dx.doc_id AS a, dy.doc_id AS b
  FROM pair JOIN size sx ON sx.row = x JOIN size sy ON sy.row = y
  JOIN d dx ON dx.row = x JOIN d dy ON dy.row = y
  WHERE 100 * shared >= 80 * (sx.n + sy.n - shared)
),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM d WHERE doc_id IS NOT NULL
  UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a
),
component AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles,
       CASE WHEN doc_id IS NOT NULL THEN coalesce(class_id, doc_id) END AS class_id, component_id
FROM d LEFT JOIN size USING (row) LEFT JOIN class USING (elements)
LEFT JOIN component USING (doc_id)"""

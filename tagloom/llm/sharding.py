"""Shards of equal bytes by histogram sort.

Every row gets a sort key: a 64-bit hash of its doc_id (so each shard is a mix of all sources)
and, where keys tie, its place among the stored rows. The splitters between shards are found
without moving a row:

* probes, candidate keys, are put between the bounds known so far;
* one pass counts the exact bytes and rows between neighbouring probes, in every partition, and
  adds them up: one small row per probe reaches the driver;
* each splitter keeps the two probes that enclose its target, and the next round probes between
  these, first by key, then by place where all bytes between two probes belong to one key;
* it is settled when the nearer of its two probes is within TOLERANCE of a shard's bytes, or no
  row boundary lies closer.

Then the rows are exchanged once. A shard is cut into pieces of about PIECE_BYTES by the same
splitters, so that a piece and not a shard is the work of a task; the counts say how many rows
of its shard come before a piece, so slots have no gaps across pieces.

Defined results: a NULL text has 0 bytes and size 1, its crc32 is that of the empty text; NULL
and repeated doc_ids are ordinary rows (a group of equal keys is cut like any other rows);
equal texts may come into different shards; with fewer rows than shards some shards stay empty;
other columns of the input are not read unless they are named in `keep`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.graph import stored

SHARDS = 16
# A splitter may miss its target by this share of a shard's bytes, or by half a row.
TOLERANCE = 0.001
PIECE_BYTES = 1 << 23
MOST_PIECES = 1 << 15  # of all shards, so probes and splitters have a fixed size
PROBES = 8  # a round puts so many between the bounds of a splitter
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


@dataclass
class Bounds:
    """Keys (value, place) in ascending order; a row lies below a bound if its key is smaller."""

    value: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, keys: list[tuple[int, int]]) -> Bounds:
        return cls(
            np.array([k for k, _ in keys], np.int64), np.array([p for _, p in keys], np.int64)
        )

    def below(self, value: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How many bounds are at or below each row's key: the number of its range."""
        number = np.searchsorted(self.value, value, "left")
        end = np.searchsorted(self.value, value, "right")
        tied = np.flatnonzero(end > number)
        # Rows whose value is that of some bounds; those are told apart by place.
        firsts, group = np.unique(number[tied], return_inverse=True)
        for i, first in enumerate(firsts):
            rows = tied[group == i]
            last = end[rows[0]]
            number[rows] += np.searchsorted(self.place[first:last], place[rows], "right")
        return number


def keyed_rows(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The rows with their sort key and size, stored so that no recomputation numbers them anew.

    The columns of `keep` travel in one struct, so that their names clash with none made here.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        "doc_id",
        F.xxhash64("doc_id").alias("key"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        *([F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row")] if keep else []),
    ).withColumn("place", F.monotonically_increasing_id())
    return stored(rows, "keyed")


def histogram(rows: DataFrame, bounds: Bounds) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows below each bound, and after the last one all of them."""

    def count(batches):
        n = len(bounds.value) + 1
        total, many = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for batch in batches:
            number = bounds.below(batch["key"].to_numpy(), batch["place"].to_numpy())
            weights = np.bincount(number, batch["size"].to_numpy(), minlength=n)
            total += weights.astype(np.int64)  # exact: a batch holds less than 2**53 bytes
            many += np.bincount(number, minlength=n)
        some = np.flatnonzero(many)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(total[some]), pa.array(many[some])], ["i", "size", "n"]
        )

    counted = rows.select("key", "place", "size").mapInArrow(
        count, "i bigint, size bigint, n bigint"
    )
    sums = counted.groupBy("i").agg(F.sum("size").alias("size"), F.sum("n").alias("n")).collect()
    size, n = (np.zeros(len(bounds.value) + 1, np.int64) for _ in range(2))
    for row in sums:
        size[row["i"]], n[row["i"]] = row["size"], row["n"]
    return np.cumsum(size), np.cumsum(n)


def _between(low: tuple[int, int], high: tuple[int, int], top_place: int) -> list[tuple[int, int]]:
    """Evenly spread keys strictly between two keys."""
    (a, p), (b, q) = low, high
    if b - a > 1:
        step = max(1, (b - a) // (PROBES + 1))
        return [(a + step * i, 0) for i in range(1, PROBES + 1) if a + step * i < b]
    if a != b:
        if q > 0:  # both values have rows here: part them first
            return [(b, 0)]
        q = top_place + 1
    step = max(1, (q - p) // (PROBES + 1))
    return [(a, p + step * i) for i in range(1, PROBES + 1) if p + step * i < q]


@dataclass
class Splitters:
    bounds: Bounds
    size_below: np.ndarray
    rows_below: np.ndarray
    rounds: int


def find_splitters(rows: DataFrame, targets: list[tuple[float, float]]) -> Splitters:
    """For each (bytes, allowed miss), in ascending order, a key with so many bytes below it.

    Every probe that was counted stays known, so the rounds only ask for new ones.
    """
    every = rows.agg(
        F.sum("size").alias("size"), F.count("*").alias("n"), F.max("place").alias("place")
    ).first()
    total, n, top = every["size"] or 0, every["n"], every["place"] or 0
    known = {(_LOW, 0): (0, 0), (_HIGH, top + 1): (total, n)}
    rounds = 0
    # The first probes lie evenly over all keys, which are hashes and do so too.
    first = PROBES * (len(targets) + 1)
    even = {(_LOW + (1 << 64) // first * i, 0) for i in range(1, first)}
    while True:
        order = sorted(known)
        below = np.array([known[k][0] for k in order], np.int64)
        probes: set[tuple[int, int]] = set()
        chosen = []
        for target, allowed in targets:
            at = int(np.searchsorted(below, target, "right"))
            at = min(max(at, 1), len(order) - 1)
            low, high = order[at - 1], order[at]
            near = min((low, high), key=lambda k: (abs(known[k][0] - target), k))
            chosen.append(near)
            settled = abs(known[near][0] - target) <= allowed
            if not settled and known[high][1] - known[low][1] > 1:
                probes.update(_between(low, high, top))
        if probes and not rounds:
            probes = even
        probes -= known.keys()
        if not probes:
            break
        asked = sorted(probes)
        size, many = histogram(rows, Bounds.of(asked))
        known |= {k: (int(s), int(m)) for k, s, m in zip(asked, size, many)}
        rounds += 1
    size, many = (np.array([known[k][i] for k in chosen], np.int64) for i in (0, 1))
    return Splitters(Bounds.of(chosen), size, many, rounds)


def sharded(
    docs: DataFrame,
    shards: int = SHARDS,
    keep: tuple[str, ...] = (),
    tolerance: float = TOLERANCE,
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (from 0, in key order); with `keep` also `row`,
    a struct of these columns."""
    rows = keyed_rows(docs, keep)
    total = rows.agg(F.sum("size")).first()[0] or 0
    per_shard = min(max(1, -(-total // (shards * piece_bytes))), max(1, MOST_PIECES // shards))
    pieces = shards * per_shard
    # Cuts between shards are held to the tolerance of a shard, those inside to half a piece.
    cuts = find_splitters(
        rows,
        [
            (
                total * i / pieces,
                tolerance * total / shards if i % per_shard == 0 else 0.5 * total / pieces,
            )
            for i in range(1, pieces)
        ],
    )
    first_row = np.concatenate([[0], cuts.rows_below]).astype(np.int64)  # rows before each piece
    bounds = cuts.bounds

    def place(batches):
        for batch in batches:
            piece = bounds.below(batch["key"].to_numpy(), batch["place"].to_numpy())
            shard = piece // per_shard
            before = first_row[piece] - first_row[shard * per_shard]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(piece), pa.array(shard, pa.int32()), pa.array(before)],
                [*batch.schema.names, "piece", "shard", "before"],
            )

    schema = T.StructType(
        [
            *rows.schema.fields,
            T.StructField("piece", T.LongType()),
            T.StructField("shard", T.IntegerType()),
            T.StructField("before", T.LongType()),
        ]
    )
    in_piece = Window.partitionBy("piece").orderBy("key", "place")
    slot = F.col("before") + F.row_number().over(in_piece) - 1
    placed = rows.mapInArrow(place, schema).withColumn("slot", slot.cast("long"))
    return placed.drop("key", "place", "piece", "before")


def shard_digest(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law (`bytes`), shard, slot, grown_shard (NULL under this law)."""
    return sharded(docs, shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Writes whole rows as Parquet, a folder per shard; `slot` gives their order.

    Columns of the input that are called shard or slot are replaced.
    """
    keep = tuple(c for c in docs.columns if c not in ("shard", "slot"))
    rows = sharded(docs, shards, keep).select("row.*", "shard", "slot")
    rows.write.partitionBy("shard").parquet(path)

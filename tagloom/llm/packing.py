"""Best-fit packing into sequences of several permitted lengths.

Documents become pieces of at most the largest length: a longer one is cut into full pieces and
a rest, so nothing is dropped. Rows of (doc_id, n_tokens) are numbered and stored, dealt by a hash
of the number to groups of about CHUNK rows, as many as the row count asks for, and each group
is packed in one task, longest piece first:

* a piece goes to the open bin that it leaves least room in (best fit);
* if it fits none, a bin is opened in the length whose cost per token is least when what is
  still to come is put in greedily, so all lengths are weighed against each other;
* at the end each bin is cut down to the shortest permitted length that holds its contents.

So a hot source or a group of copies is spread over all groups, how full bins get does not
depend on how the input is cut into files, a task holds about CHUNK lengths and no text, and a
lost task gives the same bins again. Only the two numbers of each row are shuffled.

Defined results: NULL and empty texts have no token and one row without a bin; repeated rows
are packed each; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.graph import stored
from tagloom.llm.words import blocks, words

LENGTHS = (512, 1024, 2048, 4096)
CHUNK = 16_384


def bin_cost(length: int) -> float:
    """Work of a training step on a sequence: linear, and a share that grows with its square."""
    return length * (1 + length / 65_536)


class _Stock:
    """How many pieces of each length are still to be placed."""

    def __init__(self, sizes: Iterable[int]):
        self.count: dict[int, int] = {}
        for size in sizes:
            self.count[size] = self.count.get(size, 0) + 1
        self.sizes = sorted(self.count)

    def take(self, size: int) -> None:
        self.count[size] -= 1
        if not self.count[size]:
            del self.count[size]
            self.sizes.pop(bisect_right(self.sizes, size) - 1)

    def greedy_fill(self, room: int) -> int:
        """Tokens that the longest fitting pieces, one after the other, would put into `room`."""
        left, at = room, len(self.sizes)
        while left and at:
            at = bisect_right(self.sizes, left, 0, at)
            if not at:
                break
            size = self.sizes[at - 1]
            left -= size * min(self.count[size], left // size)
            at -= 1
        return room - left


def pack(
    sizes: list[int],
    lengths: tuple[int, ...] = LENGTHS,
    cost: Callable[[int], float] = bin_cost,
) -> tuple[list[int], list[int], list[int]]:
    """For pieces of 1 to max(lengths) tokens: bin and offset of each, and the bins' lengths."""
    lengths = tuple(sorted(lengths))
    stock = _Stock(sizes)
    where, offset = [0] * len(sizes), [0] * len(sizes)
    used: list[int] = []
    opened: list[int] = []
    by_room: dict[int, list[int]] = {}  # room left: bins, the last opened on top
    rooms = 0  # bit r is set if a bin with room r is open
    for piece in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[piece]
        stock.take(size)
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            stack = by_room[room]
            number = stack.pop()
            if not stack:
                rooms &= ~(1 << room)
        else:
            room = min(
                (length for length in lengths if length >= size),
                key=lambda n: (cost(n) / (size + stock.greedy_fill(n - size)), -n),
            )
            number = len(used)
            used.append(0)
            opened.append(room)
        where[piece], offset[piece] = number, used[number]
        used[number] += size
        if room > size:
            by_room.setdefault(room - size, []).append(number)
            rooms |= 1 << (room - size)
    final = [next(n for n in lengths if n >= u) for u in used]
    return where, offset, final


def token_counts(docs: DataFrame) -> DataFrame:
    """doc_id and the number of white-space words of each text."""

    def count(batches):
        for batch in batches:
            n = [words(b).counts for b in blocks(batch.column("text"))]
            n = np.concatenate(n) if n else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64())], ["doc_id", "n_tokens"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        count, f"doc_id {kind}, n_tokens bigint"
    )


def _placed(rows: pa.Table, lengths: tuple[int, ...]) -> pa.Table:
    """The pieces of a group and their bins."""
    rows = rows.sort_by("place")
    top = max(lengths)
    first_bin = rows["group"][0].as_py() << 33
    tokens = rows["n_tokens"].to_numpy()
    pieces = np.maximum(1, -(-tokens // top))
    row = np.repeat(np.arange(len(tokens)), pieces)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    size = np.minimum(top, tokens[row] - piece * top)
    some = np.flatnonzero(size > 0)
    where, offset, final = pack(size[some].tolist(), lengths)
    final = np.array(final, np.int64)
    out = {name: np.zeros(len(row), np.int64) for name in ("bin_id", "offset", "capacity")}
    out["bin_id"][some] = np.array(where, np.int64) + first_bin
    out["offset"][some] = offset
    out["capacity"][some] = final[where] if len(some) else 0
    none = size <= 0
    return pa.table(
        [
            rows["doc_id"].combine_chunks().take(pa.array(row)),
            pa.array(piece),
            pa.array(piece * top),
            pa.array(np.maximum(size, 0)),
            *(pa.array(out[k], mask=none) for k in ("bin_id", "capacity", "offset")),
        ],
        ["doc_id", "piece", "first_token", "n_tokens", "bin_id", "capacity", "offset"],
    )


def best_fit_packing(docs: DataFrame, lengths: tuple[int, ...] = LENGTHS) -> DataFrame:
    """A row per piece: doc_id, piece, first_token, n_tokens, bin_id, capacity, offset."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    place = F.monotonically_increasing_id()
    rows = stored(token_counts(docs).withColumn("place", place), "tokens")
    groups = max(1, -(-rows.count() // CHUNK))
    group = F.pmod(F.xxhash64("place"), F.lit(groups))
    return (
        rows.withColumn("group", group)
        .groupBy("group")
        .applyInArrow(
            lambda rows: _placed(rows, lengths),
            f"doc_id {kind}, piece bigint, first_token bigint, n_tokens bigint, bin_id bigint,"
            " capacity bigint, offset bigint",
        )
    )

"""Words of whole text columns as numpy arrays, many documents at a time.

A text column comes from Arrow as one byte buffer with offsets. `blocks` cuts a column into
pieces of about BLOCK_BYTES (one longer text is a piece of its own), so the memory of a task
depends on that size and on the longest single text, not on the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 18

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(members) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


# [^\x20\x09-\x0D]+ in UTF-8: every byte of a character of several bytes is a word byte.
NOT_SPACE = ~byte_class([0x20, *range(0x09, 0x0E)])


@dataclass
class Block:
    first: int  # row of the column where the block begins
    data: np.ndarray  # uint8, the texts one after the other
    offsets: np.ndarray  # int64, one more than rows

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def text(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The column in blocks; NULL counts as an empty text."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    _, raw, data = column.buffers()
    offsets = np.frombuffer(raw, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), len(column))
        yield Block(row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
        row = end


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values; one to one."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power_table(base: int, n: int) -> np.ndarray:
    table = _powers.get(base)
    if table is None or len(table) < n:
        size = max(n, BLOCK_BYTES + 1)
        table = np.full(size, base, np.uint64)
        table[0] = 1
        table = np.multiply.accumulate(table)
        if size <= 4 * BLOCK_BYTES:
            _powers[base] = table
    return table[:n]


@dataclass
class Words:
    start: np.ndarray  # byte positions in the block
    end: np.ndarray
    row: np.ndarray  # first word of each text: row[i] .. row[i + 1]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.row)

    def text_of(self) -> np.ndarray:
        """Row of the block for each word."""
        return np.repeat(np.arange(len(self.row) - 1), self.counts)


def words(block: Block, is_word: np.ndarray = NOT_SPACE) -> Words:
    """Where the maximal runs of word bytes begin and end; no run crosses two texts."""
    inside = is_word[block.data]
    if not len(inside):
        empty = np.zeros(0, np.int64)
        return Words(empty, empty, np.zeros(len(block.offsets), np.int64))
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    heads = block.offsets[:-1][np.diff(block.offsets) > 0]
    begins[heads] = inside[heads]
    tails = block.offsets[1:][np.diff(block.offsets) > 0] - 1
    ends[tails] = inside[tails]
    start = np.flatnonzero(begins)
    return Words(start, np.flatnonzero(ends) + 1, np.searchsorted(start, block.offsets))


def word_hashes(data: np.ndarray, found: Words) -> np.ndarray:
    """A 64-bit value per word: a polynomial of its bytes, then mixed."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + _U(1)) * _power_table(_BASE, n), out=sums[1:])
    value = sums[found.end] - sums[found.start]
    return mix(value * _power_table(_BASE_INVERSE, n + 1)[found.start])


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A value for each k consecutive hashes, wherever they belong (see `gram_starts`)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, _U(k))
    for j in range(k):
        total = total * _U(_BASE) + hashes[j : j + n]
    return mix(total)


def gram_starts(found: Words, k: int) -> np.ndarray:
    """For each word, whether k words of the same text begin there."""
    last = np.repeat(found.row[1:], found.counts)
    return np.arange(len(found.start)) + k <= last


def segment_sums(values: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Sums of values[row[i]:row[i + 1]], zero where that is empty."""
    sums = np.zeros((len(values) + 1, *values.shape[1:]), np.float64)
    np.cumsum(values, axis=0, out=sums[1:])
    return sums[row[1:]] - sums[row[:-1]]


def is_held_out(doc_ids, modulus: int) -> np.ndarray:
    """crc32 of the id as text leaves remainder 2."""
    import zlib

    return np.array([zlib.crc32(str(i).encode()) % modulus == 2 for i in doc_ids], bool)

"""Character n-grams of words as bucket numbers, worked out once per distinct word of a block."""

from __future__ import annotations

import numpy as np

from tagloom.llm.words import LOWER, NOT_SPACE, Block, Words, mix, word_hashes, words

_U = np.uint64
# N-grams are worked out for some bytes at a time. A longer word is taken in pieces that overlap,
# so it has the n-grams of its whole length, and edges at its two ends only.
PIECE = 1 << 12
AT_ONCE = 1 << 18


def distinct_words(block: Block) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words, the lower-cased bytes, one place per distinct word, and each word's number."""
    found = words(block, NOT_SPACE)
    lower = LOWER[block.data]
    _, place, number = np.unique(
        word_hashes(lower, found), return_index=True, return_inverse=True
    )
    return found, lower, place, number


def subword_buckets(
    lower: np.ndarray, start: np.ndarray, end: np.ndarray, sizes: tuple[int, ...], bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of "<word>", word after word, and where each word's begin."""
    parts = list(_parts(lower, start, end, sizes, bits))
    counts = np.zeros(len(start), np.int64)
    for owner, _ in parts:
        counts += np.bincount(owner, minlength=len(start))
    buckets = np.concatenate([b for _, b in parts] or [np.zeros(0, np.int32)])
    return buckets, np.concatenate(([0], np.cumsum(counts)))


def word_sums(
    weight: np.ndarray,
    lower: np.ndarray,
    start: np.ndarray,
    end: np.ndarray,
    sizes: tuple[int, ...],
    bits: int,
) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the weights of each word's buckets, and how many these are."""
    sums = np.zeros((len(start), *weight.shape[1:]), weight.dtype)
    counts = np.zeros(len(start), np.int64)
    for owner, bucket in _parts(lower, start, end, sizes, bits):
        whose, first, n = np.unique(owner, return_index=True, return_counts=True)
        sums[whose] += np.add.reduceat(weight[bucket], first, axis=0)
        counts[whose] += n
    return sums, counts


def _parts(lower, start, end, sizes, bits):
    """(word, bucket) of all n-grams, in order of words, AT_ONCE bytes or one piece at a time."""
    marked = end - start + 2  # with both edge marks
    pieces = -(-marked // PIECE)
    owner = np.repeat(np.arange(len(start)), pieces)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = step * PIECE
    length = np.minimum(marked[owner] - begin, PIECE + max(sizes) - 1)
    total = np.concatenate(([0], np.cumsum(length)))
    a = 0
    while a < len(owner):
        b = max(a + 1, int(np.searchsorted(total, total[a] + AT_ONCE, "right")) - 1)
        yield _buckets(
            lower, start, marked, owner[a:b], begin[a:b], length[a:b], sizes, bits
        )
        a = b


def _buckets(lower, start, marked, owner, begin, length, sizes, bits):
    """Word and bucket of the n-grams that begin in the first PIECE bytes of some pieces."""
    total = int(length.sum())
    first = np.cumsum(length) - length
    piece = np.repeat(np.arange(len(owner)), length)
    inside = np.arange(total) - first[piece]
    at = begin[piece] + inside  # place in the marked word
    word = owner[piece]
    code = np.full(total, 2, np.uint64)  # the mark of an edge
    body = (at > 0) & (at < marked[word] - 1)
    code[body] = lower[(start[word] + at - 1)[body]].astype(np.uint64)
    left = length[piece] - inside  # bytes from here to the end of the piece
    value = np.zeros(total, np.uint64)
    out, whose = [], []
    for n in range(1, max(sizes) + 1):
        shifted = np.zeros(total, np.uint64)
        shifted[: max(0, total - n + 1)] = code[n - 1 :]
        value = value * _U(0x100000001B3) + shifted + _U(1)
        if n in sizes:
            good = np.flatnonzero((left >= n) & (inside < PIECE))
            out.append((mix(value[good] ^ _U(n << 56)) >> _U(64 - bits)).astype(np.int32))
            whose.append(word[good])
    bucket, whose = np.concatenate(out), np.concatenate(whose)
    order = np.argsort(whose, kind="stable")
    return whose[order], bucket[order]

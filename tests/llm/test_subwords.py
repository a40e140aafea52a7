"""Buckets of character n-grams against n-grams of the whole word, one at a time."""

import numpy as np
import pyarrow as pa
import pytest

from tagloom.llm import subwords
from tagloom.llm.words import blocks, mix

TEXT = "Ab c " + "界面" * 40 + " " + "x" * 100 + " naïve 12"


def plain(word: bytes, sizes, bits):
    marked = [2, *word, 2]
    out = []
    for n in sizes:
        for i in range(len(marked) - n + 1):
            value = 0
            for code in marked[i : i + n]:
                value = (value * 0x100000001B3 + code + 1) % 2**64
            out.append(int(mix(np.array([value ^ (n << 56)], np.uint64))[0]) >> (64 - bits))
    return sorted(out)


@pytest.mark.parametrize("piece, at_once", [(4096, 1 << 18), (7, 20), (5, 1)])
def test_ngrams_are_those_of_whole_words(monkeypatch, piece, at_once):
    monkeypatch.setattr(subwords, "PIECE", piece)
    monkeypatch.setattr(subwords, "AT_ONCE", at_once)
    sizes, bits = (1, 2, 3, 5), 15
    (block,) = blocks(pa.array([TEXT]))
    found, lower, place, _ = subwords.distinct_words(block)
    start, end = found.start[place], found.end[place]
    bucket, at = subwords.subword_buckets(lower, start, end, sizes, bits)
    weight = np.random.default_rng(1).integers(0, 9, (1 << bits, 2)).astype(np.float32)
    sums, counts = subwords.word_sums(weight, lower, start, end, sizes, bits)
    for i in range(len(start)):
        want = plain(lower[start[i] : end[i]].tobytes(), sizes, bits)
        assert sorted(bucket[at[i] : at[i + 1]].tolist()) == want
        assert counts[i] == len(want)
        assert sums[i].tolist() == weight[want].sum(0).tolist()


def test_no_words():
    (block,) = blocks(pa.array([" "]))
    found, lower, place, _ = subwords.distinct_words(block)
    bucket, at = subwords.subword_buckets(lower, found.start[place], found.end[place], (2,), 9)
    assert not len(bucket) and at.tolist() == [0]

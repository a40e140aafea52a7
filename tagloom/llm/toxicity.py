"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word's vector is the mean of the embeddings of its character n-grams (with edge marks, hashed
to buckets); the vectors of WINDOW consecutive words are averaged and put through a linear
softmax. Embeddings and softmax are trained jointly in numpy, so a misspelling that was never
seen shares most of its n-grams with a known word. A text is as toxic as its worst window, so
a remark does not drown in a long text: training therefore takes, of each toxic text, the
windows that look worst to the model so far, and of each other text all windows.

Trained on a bounded sample of labelled rows (SAMPLE_PER_LABEL of each label, texts of at most
LONGEST_SAMPLED characters); every whole text is scored. As the model is linear behind the
embeddings, scoring needs one number per bucket.

Defined results: NULL and empty texts get the score of a bag without words; without any
labelled row of both kinds all scores are 0; repeated rows give repeated rows, and a label
given twice with different values counts as toxic.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.samples import balanced_sample
from tagloom.llm.subwords import distinct_words, subword_buckets, word_sums
from tagloom.llm.words import Block, blocks, is_held_out, segment_sums

SAMPLE_PER_LABEL = 1000
LONGEST_SAMPLED = 50_000
WINDOW = 16
SIZES = (3, 4, 5)
BITS = 19
WIDTH = 8
ROUNDS = 3
EPOCHS = 3
RATE = 0.2
THRESHOLD = 0.3


def _bags(block: Block):
    """Buckets and their bounds per distinct word, each word's number, and the words."""
    found, lower, place, number = distinct_words(block)
    bucket, at = subword_buckets(lower, found.start[place], found.end[place], SIZES, BITS)
    return found, number, bucket, at


class Model:
    """Embeddings (buckets x WIDTH) and a softmax of two classes."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.embed = ((rng.random((1 << BITS, WIDTH), np.float32) - 0.5) / WIDTH)
        self.out = np.zeros((WIDTH, 2))
        self.bias = np.zeros(2)
        self.squares = [np.full_like(x, 1e-6) for x in (self.embed, self.out, self.bias)]

    def step(self, bucket, share, edge, label) -> None:
        """One AdaGrad step on some windows given as weighted buckets."""
        own = np.repeat(np.arange(len(label)), np.diff(edge))
        mean = segment_sums(self.embed[bucket] * share[:, None], edge)
        logit = mean @ self.out + self.bias
        p = np.exp(logit - logit.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(label)), label] -= 1
        seen, where = np.unique(bucket, return_inverse=True)
        back = p @ self.out.T
        grad = np.stack(
            [np.bincount(where, back[own, j] * share, len(seen)) for j in range(WIDTH)], axis=1
        )
        for part, at, g in (
            (0, seen, grad),
            (1, slice(None), mean.T @ p / len(label) * 10),
            (2, slice(None), p.mean(0)),
        ):
            target = (self.embed, self.out, self.bias)[part]
            self.squares[part][at] += g**2
            target[at] -= RATE * g / np.sqrt(self.squares[part][at])

    def table(self) -> tuple[np.ndarray, float]:
        """Log-odds per bucket, and of an empty bag."""
        lean = self.out[:, 1] - self.out[:, 0]
        return (self.embed @ lean).astype(np.float32), float(self.bias[1] - self.bias[0])


def window_edges(row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of each text, half overlapping, as first and last word; a text's last one is full."""
    first, last = [], []
    for a, b in zip(row[:-1], row[1:], strict=True):
        begin = np.arange(a, max(a + 1, b - WINDOW // 2), WINDOW // 2)
        begin = np.maximum(a, np.minimum(begin, b - WINDOW))
        first.append(begin)
        last.append(np.minimum(b, begin + WINDOW))
    return np.concatenate(first), np.concatenate(last)


def _windows_of(row: np.ndarray) -> np.ndarray:
    """How many windows each text has, as `window_edges` makes them."""
    half = WINDOW // 2
    return np.maximum(1, -(-(np.diff(row) - half) // half))


def train(block: Block, label: np.ndarray, seed: int = 5) -> tuple[np.ndarray, float]:
    found, number, bucket, at = _bags(block)
    first, last = window_edges(found.row)
    text = np.repeat(np.arange(block.rows), _windows_of(found.row))
    good = last > first
    first, last, text = first[good], last[good], text[good]
    sizes = np.diff(at)
    model, rng = Model(seed), np.random.default_rng(seed)
    wanted = np.arange(len(first))
    for round_ in range(ROUNDS):
        for _ in range(EPOCHS):
            rng.shuffle(wanted)
            for rows in np.array_split(wanted, max(1, len(wanted) // 512)):
                n = last[rows] - first[rows]
                word = number[np.repeat(first[rows], n) + _ramp(n)]
                grams = sizes[word]
                take = bucket[np.repeat(at[word], grams) + _ramp(grams)]
                share = np.repeat(1.0 / (np.repeat(n, n) * np.maximum(grams, 1)), grams)
                edge = np.concatenate(([0], np.cumsum(np.add.reduceat(grams, np.cumsum(n) - n))))
                model.step(take, share, edge, label[text[rows]])
        table, _ = model.table()
        each = segment_sums(table[bucket], at) / np.maximum(sizes, 1)
        sums = np.concatenate(([0], np.cumsum(each[number])))
        worth = (sums[last] - sums[first]) / (last - first)
        top = np.full(block.rows, -np.inf)
        np.maximum.at(top, text, worth)
        wanted = np.flatnonzero((label[text] == 0) | (worth >= top[text] - 1e-12))
    return model.table()


def _ramp(n: np.ndarray) -> np.ndarray:
    """0 .. n[0]-1, 0 .. n[1]-1, ..."""
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


def fit(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL):
    """Log-odds per bucket, and scale and bias, from labelled rows that are not held out.

    A quarter of the sample is kept from training and sets scale and bias of the odds.
    """
    known = (
        labels.where("toxic is not null and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("_toxic"))
    )
    rows = (
        docs.select("doc_id", F.col("text").cast("string").alias("text"))
        .where(f"text is not null and length(text) <= {LONGEST_SAMPLED}")
        .where("crc32(cast(doc_id as string)) % 4 != 2")
        .join(known, "doc_id")
    )
    draw = balanced_sample(rows, "_toxic", per_label)
    sample = draw.select("_toxic", "text").toArrow() if draw is not None else None
    if sample is None or len(set(sample["_toxic"].to_pylist())) < 2:
        return np.zeros(1 << BITS, np.float32), None
    counts = {r[0] > 0: r[1] for r in rows.groupBy("_toxic").count().collect()}
    label = (sample["_toxic"].to_numpy() > 0).astype(int)
    texts = sample["text"].combine_chunks()
    aside = np.arange(len(label)) % 4 == 3 if len(label) >= 40 else np.zeros(len(label), bool)
    (block,) = blocks(texts.filter(pa.array(~aside)), 1 << 40)
    table, bias = train(block, label[~aside])
    if not aside.any():
        return table, (1.0, bias)
    odds = np.concatenate([text_odds(b, table, bias) for b in blocks(texts.filter(pa.array(aside)))])
    truth = label[aside]
    share = np.array([counts[False], counts[True]]) / np.bincount(label, minlength=2)
    scale, shift = calibrate(odds, truth, share[truth])
    return table * np.float32(scale), (scale, bias * scale + shift)


def calibrate(odds: np.ndarray, truth: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Scale and shift that make odds of texts not trained on fit the labels' true shares."""
    theta = np.array([1.0, 0.0])
    x = np.stack([odds, np.ones_like(odds)], axis=1)
    pull = np.array([1e-2, 1e-3]) * weight.sum()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        grad = x.T @ (weight * (p - truth)) + pull * (theta - [1.0, 0.0]) * 0.01
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(pull * 0.01 + 1e-9)
        step = np.linalg.solve(hess, grad)
        theta = theta - np.clip(step, -1, 1)
    return max(0.05, float(theta[0])), float(theta[1])


def text_odds(block: Block, table: np.ndarray, bias: float) -> np.ndarray:
    """Log-odds of each text's worst window."""
    found, lower, place, number = distinct_words(block)
    each, grams = word_sums(table, lower, found.start[place], found.end[place], SIZES, BITS)
    sums = np.concatenate(([0], np.cumsum((each / grams.astype(float))[number])))
    first, last = window_edges(found.row)
    worth = (sums[last] - sums[first]) / np.maximum(last - first, 1)
    count = _windows_of(found.row)
    return np.maximum.reduceat(worth, np.cumsum(count) - count) + bias


def _score(batches, table, bias):
    for batch in batches:
        score = np.zeros(batch.num_rows)
        if bias is not None:
            for block in blocks(batch.column("text")):
                odds = text_odds(block, table, bias[1])
                score[block.first : block.first + block.rows] = 1 / (1 + np.exp(-odds))
        ids = batch.column("doc_id")
        yield pa.RecordBatch.from_arrays(
            [
                ids,
                pa.array(is_held_out(ids.to_pylist(), 4)),
                pa.array(score),
                pa.array((score >= THRESHOLD).astype(np.int32)),
            ],
            ["doc_id", "held_out", "score", "predicted"],
        )


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every text."""
    table, bias = fit(docs, labels)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        lambda batches: _score(batches, table, bias),
        f"doc_id {kind}, held_out boolean, score double, predicted int",
    )

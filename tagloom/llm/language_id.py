"""Language identification by error-correcting output codes.

Each language gets a codeword; one binary classifier per bit, on character n-grams hashed to
buckets, predicts that bit. A text goes to the codeword with the least weighted loss, and the
text is marked ambiguous if another codeword is nearly as close.

The classifiers are fitted on a bounded sample of labelled rows (SAMPLE_PER_LANG per language,
the first by a hash of the id, so that no order or source is favoured); all texts are predicted.

Defined results: texts that are NULL or hold no letter are `und` with score 0; without any
labelled row all texts are `und`; repeated rows give repeated rows; other columns are not read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.samples import balanced_sample
from tagloom.llm.subwords import distinct_words, subword_buckets, word_sums
from tagloom.llm.words import blocks, is_held_out, segment_sums

SAMPLE_PER_LANG = 300
SIZES = (1, 2, 3)
BITS = 15
EPOCHS = 12
MARGIN = 0.04  # least lead of the winner's loss, per bit, that is not ambiguous
UNKNOWN = "und"


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n rows of -1 and 1: all splits of up to 5 classes, else the best of random codes."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 5:
        halves = itertools.product((1, -1), repeat=n - 1)
        return np.array([(1, *half) for half in halves if -1 in half]).T.astype(float)
    rng = np.random.default_rng(seed)
    width = int(4 * np.ceil(np.log2(n)) + 8)
    tries = [rng.choice((-1.0, 1.0), (n, width)) for _ in range(200)]

    def distance(code: np.ndarray) -> float:
        same = code @ code.T - 2 * width * np.eye(n)
        return width - same.max() - 1e3 * (np.abs(code.sum(0)) == n).sum()

    return max(tries, key=distance)


def _features(batches):
    """Per text the buckets with their share of all n-grams."""
    for batch in batches:
        ids, langs = batch.column(0), batch.column(1).to_pylist()
        for block in blocks(batch.column("text")):
            found, lower, place, number = distinct_words(block)
            bucket, at = subword_buckets(lower, found.start[place], found.end[place], SIZES, BITS)
            rows = []
            for i in range(block.rows):
                own = number[found.row[i] : found.row[i + 1]]
                take = [bucket[at[w] : at[w + 1]] for w in own]
                seen, n = np.unique(np.concatenate(take or [bucket[:0]]), return_counts=True)
                rows.append((seen, (n / max(1, n.sum())).astype(np.float32)))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(block.first, block.rows),
                    pa.array(langs[block.first : block.first + block.rows], pa.string()),
                    pa.array([r[0] for r in rows], pa.list_(pa.int64())),
                    pa.array([r[1] for r in rows], pa.list_(pa.float32())),
                ],
                ["doc_id", "lang", "bucket", "share"],
            )


def fit(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> dict:
    """Labels, codewords, bit weights and the classifiers' weights per bucket."""
    labelled = docs.select(
        F.col("doc_id"), F.col("lang").cast("string"), F.col("text").cast("string")
    ).where("lang is not null and text is not null")
    labelled = labelled.where("crc32(cast(doc_id as string)) % 4 != 2")
    draw = balanced_sample(labelled, "lang", per_lang)
    if draw is None:
        return {
            "langs": [],
            "code": np.zeros((0, 1)),
            "weight": np.zeros((1 << BITS, 1), np.float32),
            "bias": np.zeros(1),
            "trust": np.ones(1),
        }
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = draw.mapInArrow(
        _features, f"doc_id {kind}, lang string, bucket array<bigint>, share array<float>"
    ).toArrow()
    langs, label = np.unique(rows["lang"].to_pylist(), return_inverse=True)
    langs = langs.tolist()
    bucket = rows["bucket"].combine_chunks()
    at = np.concatenate(([0], np.cumsum(bucket.value_lengths().to_numpy())))
    bucket = bucket.flatten().to_numpy()
    share = rows["share"].combine_chunks().flatten().to_numpy().astype(float)
    code = codewords(len(langs))
    weight, bias, trust = _train(bucket, share, at, code[label], BITS)
    return {"langs": langs, "code": code, "weight": weight, "bias": bias, "trust": trust}


def _train(bucket, share, at, target, bits):
    """Binary logistic classifiers, all bits at once, by AdaGrad; the last fifth sets trust."""
    n, width = target.shape
    weight, squares = np.zeros((1 << bits, width)), np.full((1 << bits, width), 1e-8)
    bias = np.zeros(width)
    rng = np.random.default_rng(3)
    cut = max(1, n - n // 5)
    fit_rows = rng.permutation(n)
    test_rows, fit_rows = fit_rows[cut:], fit_rows[:cut]

    def gather(rows):
        take = np.concatenate([np.arange(at[r], at[r + 1]) for r in rows] or [np.zeros(0, int)])
        edge = np.concatenate(([0], np.cumsum(at[rows + 1] - at[rows])))
        return bucket[take], share[take], edge

    def value(b, s, edge):
        return segment_sums(weight[b] * s[:, None], edge) + bias

    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(fit_rows), max(1, len(fit_rows) // 32)):
            b, s, edge = gather(rows)
            gain = -target[rows] / (1 + np.exp(np.clip(target[rows] * value(b, s, edge), -30, 30)))
            seen, where = np.unique(b, return_inverse=True)
            own = np.repeat(np.arange(len(rows)), np.diff(edge))
            step = np.stack(
                [np.bincount(where, gain[own, j] * s, len(seen)) for j in range(width)], axis=1
            )
            squares[seen] += step**2
            weight[seen] -= 1.0 * step / np.sqrt(squares[seen])
            bias -= 0.05 * gain.mean(0)
    trust = np.ones(width)
    if len(test_rows):
        wrong = (value(*gather(test_rows)) * target[test_rows] <= 0).mean(0)
        trust = np.log((1 - wrong + 0.02) / (wrong + 0.02)).clip(0.05)
    return weight.astype(np.float32), bias, trust


def decode(margins: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest codeword by weighted logistic loss, its score, and whether it is ambiguous."""
    code, trust = model["code"], model["trust"] / model["trust"].sum()
    loss = np.logaddexp(0, -margins[:, None, :] * code[None]) @ trust
    best = loss.argmin(1)
    share = np.exp(-(loss - loss.min(1, keepdims=True)) * code.shape[1])
    score = 1 / share.sum(1)
    if code.shape[0] < 2:
        return best, score, np.zeros(len(best), bool)
    two = np.partition(loss, 1, axis=1)
    return best, score, two[:, 1] - two[:, 0] < MARGIN


def _has_letter(block, found) -> np.ndarray:
    data = block.data
    ascii_letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    count = np.concatenate(([0], np.cumsum(ascii_letter)))
    has = count[block.offsets[1:]] > count[block.offsets[:-1]]
    for i in np.flatnonzero(~has):
        has[i] = any(c.isalpha() for c in block.text(i).decode("utf-8", "replace"))
    return has


def _predict(batches, model):
    for batch in batches:
        n = batch.num_rows
        lang, score = np.full(n, UNKNOWN, object), np.zeros(n)
        ambiguous = np.zeros(n, bool)
        for block in blocks(batch.column("text")) if model["langs"] else ():
            found, lower, place, number = distinct_words(block)
            each, grams = word_sums(
                model["weight"], lower, found.start[place], found.end[place], SIZES, BITS
            )
            total = np.maximum(segment_sums(grams[number], found.row), 1)
            margins = segment_sums(each[number], found.row) / total[:, None] + model["bias"]
            best, s, unsure = decode(margins, model)
            has = _has_letter(block, found)
            here = slice(block.first, block.first + block.rows)
            lang[here] = np.where(has, np.array(model["langs"], object)[best], UNKNOWN)
            score[here] = np.where(has, s, 0.0)
            ambiguous[here] = has & unsure
        ids = batch.column("doc_id")
        yield pa.RecordBatch.from_arrays(
            [
                ids,
                pa.array(is_held_out(ids.to_pylist(), 4)),
                pa.array(lang, pa.string()),
                pa.array(score),
                pa.array(ambiguous),
            ],
            ["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
        )


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous for every text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        lambda batches: _predict(batches, model),
        f"doc_id {kind}, held_out boolean, lang_pred string, score double, ambiguous boolean",
    )


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, fit(docs))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows, unchanged, of texts in a learned language that is not ambiguous."""
    model = fit(docs)
    names = docs.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches):
        for batch in batches:
            slim = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text")], ["doc_id", "text"]
            )
            for verdict in _predict([slim], model):
                good = [
                    lang != UNKNOWN and not unsure
                    for lang, unsure in zip(
                        verdict.column("lang_pred").to_pylist(),
                        verdict.column("ambiguous").to_pylist(),
                        strict=True,
                    )
                ]
                yield batch.filter(pa.array(good, pa.bool_())).select(names)

    return docs.mapInArrow(run, fields)

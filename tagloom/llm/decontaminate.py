"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts and benchmark items are lower-cased (A-Z) and cut to their letters, digits and bytes of
longer characters, every other run being one space. A text is contaminated by an item if some
region of it can be turned into the item with at most BUDGET of the item's length in edits.

If k edits suffice, region and item share at least m + 1 - q - k q of the item's q-grams (m: its
length), and these lie on diagonals at most k apart. So shared q-grams are counted in bands of
2 (k + 1) diagonals that overlap by half, bands that reach the bound are kept, and an alignment
inside the band decides. q is 8, and 4 for items of under LONG bytes, for which 8 would leave no
bound; so every item of SHORTEST bytes or more has its whole budget.

The benchmark is the stated query set. It is read in blocks of about ITEM_BYTES, one at a time,
and all texts are streamed once per block. What goes to the tasks is a block's normalised text;
each task works out the index of its q-grams. With several blocks the rows are numbered and
stored, what each block finds is stored, and regions are put together by row.

Defined results: NULL and empty texts and items have no hit; items shorter than SHORTEST are
looked for as whole words without edits; repeated rows give repeated rows, repeated items
count once per item_id; a NULL item_id or doc_id is carried along.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.graph import stored
from tagloom.llm.words import LOWER, Block, blocks, byte_class

Q = 8
SHORT_Q = 4
LONG = 32  # from here on the lemma's bound is positive for q = 8 and the whole budget
BUDGET = 0.10
SHORTEST = 16
ITEM_BYTES = 8 << 20
TABLE_BITS = 22

_U = np.uint64
_WORD = byte_class([*range(48, 58), *range(97, 123), *range(128, 256)])


def normalised(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes kept of a block's texts, where each came from, and the texts' new offsets."""
    lower = LOWER[block.data]
    keep = _WORD[lower]
    after = np.zeros(len(lower), bool)
    after[1:] = keep[:-1]
    heads = block.offsets[:-1]
    after[heads[heads < len(lower)]] = False  # no space at the head of a text
    gap = ~keep & after
    keep |= gap
    lower[gap] = 32
    place = np.flatnonzero(keep)
    return lower[place], place, np.searchsorted(place, block.offsets)


def grams(data: np.ndarray, q: int = Q) -> np.ndarray:
    """The q (up to 8) bytes that begin at each place, as one number."""
    n = len(data) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    padded = np.zeros(n + 7, np.uint8)
    padded[: min(len(data), n + 7)] = data[: n + 7]
    whole = np.ndarray((n,), "<u8", padded, strides=(1,))
    return whole & _U((1 << 8 * q) - 1)


def _slot(gram: np.ndarray) -> np.ndarray:
    return ((gram * _U(0x9E3779B97F4A7C15)) >> _U(64 - TABLE_BITS)).astype(np.int64)


def edit_budget(length: int) -> int:
    """The most edits of an item: BUDGET of its length, none for those under SHORTEST."""
    return int(BUDGET * length) if length >= SHORTEST else 0


def gram_size(length: int) -> int:
    """A q for which the lemma's bound is positive with the whole budget."""
    return SHORT_Q if SHORTEST <= length < LONG else Q


class Index:
    """Where the q-grams of those items of a block occur that are looked for by this q."""

    def __init__(self, texts: list[bytes], q: int):
        members = [i for i, t in enumerate(texts) if gram_size(len(t)) == q]
        parts = [grams(np.frombuffer(texts[i], np.uint8), q) for i in members]
        sizes = [len(p) for p in parts]
        gram = np.concatenate(parts or [np.zeros(0, np.uint64)])
        order = np.argsort(gram, kind="stable").astype(np.int32)
        gram = gram[order]
        self.q = q
        self.gram, first = np.unique(gram, return_index=True)
        self.at = np.append(first, len(gram)).astype(np.int32)  # where their occurrences begin
        self.item = np.repeat(np.array(members, np.int32), sizes)[order]
        place = [np.arange(n, dtype=np.int32) for n in sizes]
        self.place = np.concatenate(place or [np.zeros(0, np.int32)])[order]
        self.present = np.zeros(1 << TABLE_BITS, bool)  # by slot: whether some gram falls there
        self.present[_slot(self.gram)] = True


class Items:
    """A block of the benchmark. Only ids and normalised texts travel to the tasks."""

    def __init__(self, ids: list, texts: list[bytes]):
        self.ids, self.texts = ids, texts
        self._indexes = None

    def __getstate__(self):
        return {"ids": self.ids, "texts": self.texts, "_indexes": None}

    @property
    def indexes(self) -> list[Index]:
        if self._indexes is None:
            found = (Index(self.texts, q) for q in (Q, SHORT_Q))
            self._indexes = [i for i in found if len(i.gram)]
            self.size = np.array([len(t) for t in self.texts], np.int64)
            self.budget = np.array([edit_budget(n) for n in self.size.tolist()], np.int64)
        return self._indexes


def index_items(ids: list, texts: pa.Array) -> Items:
    kept = {}
    for block in blocks(texts, 1 << 40):
        data, _, offsets = normalised(block)
        for i in range(block.rows):
            text = data[offsets[i] : offsets[i + 1]].tobytes().strip()
            if text:
                kept.setdefault((ids[block.first + i], text), None)
    return Items([k for k, _ in kept], [t for _, t in kept])


def banded_alignment(item: np.ndarray, text: np.ndarray, shift: int, width: int, k: int):
    """Least edits that turn a region of `text` into `item`, starting on a diagonal from
    `shift` to `shift` + `width` and staying within k of these; and where that region ends.
    None if more than k.
    """
    low = shift - k
    n = width + 2 * k + 1
    ramp = np.arange(n)
    padded = np.full(len(item) + n, -1, np.int16)  # what lies outside the text matches nothing
    a, b = max(0, low), min(len(text), low + len(padded))
    if b > a:
        padded[a - low : b - low] = text[a:b]
    cost = np.zeros(n, np.int64)
    outside = ramp + low < 0
    cost[outside] = k + 1
    for i, byte in enumerate(item.tolist()):
        step = cost + (padded[i : i + n] != byte)
        step[:-1] = np.minimum(step[:-1], cost[1:] + 1)
        cost = np.minimum.accumulate(step - ramp) + ramp
        if i % 16 == 15 and cost.min() > k:
            return None
    best = int(cost.argmin())
    return (int(cost[best]), low + len(item) + best) if cost[best] <= k else None


def _hits(data, offsets, items: Items, index: Index):
    """(text, item, band) where the lemma's bound is met; bands as a first diagonal."""
    q, gram = index.q, grams(data, index.q)
    near = np.flatnonzero(index.present[_slot(gram)])
    known = np.minimum(np.searchsorted(index.gram, gram[near]), len(index.gram) - 1)
    good = index.gram[known] == gram[near]
    near, known = near[good], known[good]
    text = np.searchsorted(offsets, near, "right") - 1
    inside = near + q <= offsets[text + 1]
    near, known, text = near[inside], known[inside], text[inside]
    first = index.at[known].astype(np.int64)
    many = index.at[known + 1] - first
    which = np.repeat(np.arange(len(near)), many)
    which_at = np.repeat(first - np.cumsum(many) + many, many) + np.arange(len(which))
    item = index.item[which_at].astype(np.int64)
    budget, size = items.budget, items.size
    span = budget + 1
    diagonal = near[which] - offsets[text[which]] - index.place[which_at]
    low = diagonal // span[item]  # half a band
    reach = int(len(data) // 1 + size.max(initial=0)) + 2
    code = (text[which] * len(items.texts) + item) * (2 * reach) + low + reach
    code, n = np.unique(code, return_counts=True)
    follows = np.append(code[1:] == code[:-1] + 1, False)
    both = n + np.where(follows, np.append(n[1:], 0), 0)
    pair, low = code // (2 * reach), code % (2 * reach) - reach
    item = pair % len(items.texts)
    bound = size[item] + 1 - q - budget[item] * q
    # a band also begins half a step before a lone count
    keep = both >= np.maximum(bound, 1)
    return pair[keep] // len(items.texts), item[keep], low[keep] * span[item[keep]]


def find_regions(block: Block, items: Items) -> list[list[tuple[object, int, int, int]]]:
    """For each text of a block the regions found: item, first and last byte, edits."""
    out: list[list] = [[] for _ in range(block.rows)]
    if not items.texts or not len(block.data):
        return out
    data, place, offsets = normalised(block)
    best: dict = {}
    for index in items.indexes:
        hits = _hits(data, offsets, items, index)
        for text, item, shift in zip(*(x.tolist() for x in hits), strict=True):
            body = np.frombuffer(items.texts[item], np.uint8)
            k = edit_budget(len(body))
            whole = data[offsets[text] : offsets[text + 1]]
            found = banded_alignment(body, whole, shift, 2 * k + 1, k)
            if found is None or not _is_region(whole, found, body, k):
                continue
            edits, end = found
            best.setdefault((text, item), []).append((edits, _begin(body, whole, end, k), end))
    for (text, item), regions in sorted(best.items()):
        base, head, taken = offsets[text], int(block.offsets[text]), []
        for edits, begin, end in sorted(set(regions)):  # of overlapping ones the best
            if all(end <= a or begin >= b for a, b in taken):
                taken.append((begin, end))
                first = int(place[base + begin])
                last = int(place[base + min(end, offsets[text + 1] - base) - 1]) + 1
                out[text].append((items.ids[item], first - head, last - head, edits))
    short = [(i, t) for i, t in zip(items.ids, items.texts, strict=True) if len(t) < Q]
    for text in range(block.rows) if short else ():
        whole = b" " + data[offsets[text] : offsets[text + 1]].tobytes().strip() + b" "
        for name, body in short:
            at = whole.find(b" " + body + b" ")
            if at >= 0:
                base = offsets[text]
                first, last = int(place[base + at]), int(place[base + at + len(body) - 1]) + 1
                head = int(block.offsets[text])
                out[text].append((name, first - head, last - head, 0))
    return out


def _is_region(whole, found, body, k) -> bool:
    """Short items count without edits and as whole words only."""
    if len(body) >= SHORTEST:
        return True
    begin, end = found[1] - len(body), found[1]
    return (begin == 0 or whole[begin - 1] == 32) and (end >= len(whole) or whole[end] == 32)


def _begin(body, whole, end, k) -> int:
    """Where a region that ends at `end` begins: the same alignment from the other side."""
    cut = whole[max(0, end - len(body) - k) : end][::-1]
    cost = np.arange(k + 1, 2 * k + 2)
    n = 2 * k + 1
    ramp = np.arange(n)
    cost = np.abs(ramp - k)
    cost[:k] = 2 * k + 1
    cost[k:] = ramp[: k + 1]
    padded = np.full(len(body) + n, -1, np.int16)
    padded[k : k + len(cut)] = cut[: len(body) + n - k]
    for i, byte in enumerate(body[::-1].tolist()):
        step = cost + (padded[i : i + n] != byte)
        step[:-1] = np.minimum(step[:-1], cost[1:] + 1)
        cost = np.minimum.accumulate(step - ramp) + ramp
    return max(0, end - (len(body) + int(cost.argmin()) - k))


def _scan(batches, items, kind):
    for batch in batches:
        hits = [h for b in blocks(batch.column("text")) for h in find_regions(b, items)]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in batch.schema.names if c != "text"),
                pa.array([[h[0] for h in own] for own in hits], pa.list_(kind)),
                pa.array(
                    [[f"{i}:{a}:{b}:{e}" for i, a, b, e in own] for own in hits],
                    pa.list_(pa.string()),
                ),
            ],
            [*(c for c in batch.schema.names if c != "text"), "items", "regions"],
        )


def _block_count(benchmark: DataFrame) -> int:
    total = benchmark.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    return max(1, -(-total // ITEM_BYTES))


def _item_blocks(benchmark: DataFrame, count: int):
    """The benchmark in `count` blocks of about ITEM_BYTES, one after the other."""
    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    for number in range(count):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == number).toArrow()
        yield index_items(part["item_id"].to_pylist(), part["text"].combine_chunks())


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, n_regions, item_ids and `regions` (item:start:end:edits, in bytes)."""
    import pyspark.sql.pandas.types as kinds

    item_type = benchmark.schema["item_id"].dataType
    kind = docs.schema["doc_id"].dataType.simpleString()
    arrow = kinds.to_arrow_type(item_type)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = f"doc_id {kind}, items array<{item_type.simpleString()}>, regions array<string>"
    count = _block_count(benchmark)
    if count == 1:
        (items,) = _item_blocks(benchmark, count)
        found = texts.mapInArrow(lambda batches: _scan(batches, items, arrow), schema)
    else:
        found = _by_row(texts, _item_blocks(benchmark, count), arrow, schema)
    return found.select(
        "doc_id",
        (F.size("items") > 0).alias("contaminated"),
        F.size("items").cast("long").alias("n_regions"),
        F.sort_array(F.array_distinct("items")).alias("item_ids"),
        F.array_join(F.sort_array("regions"), ",").alias("regions"),
    )


def _by_row(texts: DataFrame, item_blocks, arrow, schema: str) -> DataFrame:
    """What every block finds in each row, a block at a time."""
    rows = stored(texts.withColumn("row", F.monotonically_increasing_id()), "numbered")
    parts = []
    for items in item_blocks:
        hits = rows.mapInArrow(
            lambda batches, items=items: _scan(batches, items, arrow),
            schema.replace(", items", ", row bigint, items"),
        )
        parts.append(stored(hits.where(F.size("items") > 0), "hits"))
    every = reduce(DataFrame.unionByName, parts)
    merged = every.groupBy("row").agg(
        F.flatten(F.collect_list("items")).alias("items"),
        F.flatten(F.collect_list("regions")).alias("regions"),
    )
    columns = [
        F.coalesce(c, F.array().cast(merged.schema[c].dataType)).alias(c)
        for c in ("items", "regions")
    ]
    return rows.select("doc_id", "row").join(merged, "row", "left").select("doc_id", *columns)


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows, unchanged, of texts that no benchmark item contaminates."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    count = _block_count(benchmark)
    for items in _item_blocks(benchmark, count):

        def run(batches, items=items):
            for batch in batches:
                text = batch.column("text")
                clean = [not h for b in blocks(text) for h in find_regions(b, items)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, fields)
        if count > 1:
            docs = stored(docs, "clean")
    return docs

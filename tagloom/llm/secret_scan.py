"""Secret scan by assignment-aware lexing.

Three base patterns (assignments with a telling name, access keys, long hex runs) are looked
for in every whole text. Beside them, source and configuration syntax is lexed into pairs of a
target name and its value, from each mark of assignment backwards for the name and forwards for
the value:

* a value is made of quoted literals (also over several lines, with triple quotes or backticks),
  names, and + . & or nothing between them; comments, line continuations and, inside
  parentheses, line ends are passed over; a bare value ends at white space or a delimiter; a
  YAML block scalar is one literal;
* a name below an indented `parent:` belongs to it: it is parent.name;
* an alias takes the last value that its name was given before it, in its own scope or the
  nearest one outside; if there is none before, the first one after it;
* each literal is scored by the most telling name that it reaches.

Work grows in proportion to the text: each mark looks back at most LONGEST_NAME characters, and
a value is read once. Names are at most that long.

Defined results: NULL and empty texts have no spans; repeated rows give repeated rows; a NULL
doc_id is carried along; other columns are not read. Spans are in code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter, deque
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.words import Block, blocks, byte_class

KINDS = ("assign", "access", "hex", "named")  # in the order that breaks ties

_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")

# A mark of assignment: := => = : but no comparison, arrow, double colon or URL.
_MARK = re.compile(r"(?<![=!<>:+*/|&^%~-])(?::=|=>|=(?![=~>])|:(?![:=/]))")
_NAME_BEFORE = re.compile(r"[A-Za-z0-9_.-]++", re.ASCII)  # of reversed text
_GAP = re.compile(r"(?:[ \t]++|\\\r?\n|/\*(?:[^*]|\*(?!/))*+\*/)*+")
_WIDE_GAP = re.compile(r"(?:\s++|\\\r?\n|(?:#|//)[^\n]*+|/\*(?:[^*]|\*(?!/))*+\*/)*+")
_QUOTED = re.compile(
    r"""[rbfuRBFU]{0,2}(?:\"\"\"((?:[^"\\]|\\.|"(?!""))*+)\"\"\"|'''((?:[^'\\]|\\.|'(?!''))*+)'''"""
    r"""|"((?:[^"\\\n]|\\.)*+)"|'((?:[^'\\\n]|\\.)*+)'|`((?:[^`\\]|\\.)*+)`)""",
    re.DOTALL,
)
_BARE = re.compile(r"""[^\s"'`,;(){}\[\]<>]++""")
_JOIN = re.compile(r"\+(?!=)|\.\.?(?=[\s\"'`])|&(?!&)")
_BLOCK = re.compile(r"[|>][+-]?[ \t]*\n")
_PARENT = re.compile(r"[ \t]*(?:#[^\n]*)?(?:\{[ \t]*)?\r?(?:\n|\Z)")
_ELEMENT = re.compile(r"<([A-Za-z_][\w.-]*+)>([^<>\s]++)</(\1)>", re.ASCII)
_NAME = re.compile(r"[$%]?\{?([A-Za-z_][A-Za-z0-9_.-]*+)\}?\Z", re.ASCII)
_NAME_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
LONGEST_NAME = 128

# How telling a part of a target name is.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0,
    "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "bearer": 0.9,
    "auth": 0.7, "private": 0.6, "access": 0.5, "key": 0.5, "salt": 0.5, "signature": 0.4,
}
THRESHOLD = 1.0
SHORTEST = 8
_MARKS = byte_class(b":=<")
_HEX_BYTES = byte_class(b"0123456789abcdef")


def name_score(name: str) -> float:
    """How sensitive a target name is: its most telling part, more with a second one."""
    parts = sorted(
        (SENSITIVE.get(p.lower(), 0.0) for p in _NAME_PART.findall(name)), reverse=True
    )
    return (parts[0] if parts else 0.0) + (0.5 * parts[1] if len(parts) > 1 else 0.0)


def literal_score(value: str) -> float:
    """0 to 1: length and variety of a literal; readable placeholders and plain words score low."""
    if len(value) < SHORTEST or not value.isascii() or " " in value:
        return 0.0
    if re.fullmatch(r"[A-Za-z]+|[0-9.]+|https?:.*", value):
        return 0.0
    counts = Counter(value)
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    return min(1.0, bits / 3.5) * min(1.0, len(value) / 12)


def _name_before(text: str, mark: int) -> tuple[str, int] | None:
    """The target name that ends before a mark, perhaps quoted or in a subscript, and its start."""
    at = mark
    while at and text[at - 1] in " \t":
        at -= 1
    for closing in ("]", "\"'`"):
        if at and text[at - 1] in closing:
            at -= 1
    before = text[max(0, at - LONGEST_NAME - 1) : at][::-1]
    found = _NAME_BEFORE.match(before)
    if not found or found.end() > LONGEST_NAME:
        return None
    name = found.group()[::-1]
    cut = len(name) - len(name.lstrip("0123456789.-"))
    return (name[cut:], at - len(name) + cut) if name[cut:] else None


def _block_scalar(text: str, at: int, indent: int) -> tuple[int, int] | None:
    """Where the lines that are indented more than their key begin and end."""
    begin = end = None
    while at < len(text):
        stop = text.find("\n", at)
        stop = len(text) if stop < 0 else stop
        line = text[at:stop]
        body = line.lstrip(" ")
        if body and len(line) - len(body) <= indent:
            break
        if body:
            begin = at + len(line) - len(body) if begin is None else begin
            end = stop
        at = stop + 1
    return None if begin is None else (begin, end)


def _value(text: str, at: int, indent: int):
    """The value after a mark: its literals as (start, end, value), its names, and its end."""
    literals, names, depth = [], [], 0
    at = _GAP.match(text, at).end()
    block = _BLOCK.match(text, at)
    if block:
        found = _block_scalar(text, block.end(), indent)
        if found is None:
            return [], [], block.end()
        whole = re.sub(r"\n[ \t]*", "", text[found[0] : found[1]])
        return [(*found, whole)], [], found[1]
    while at < len(text):
        quoted = _QUOTED.match(text, at)
        if quoted:
            group = quoted.lastindex
            literals.append((*quoted.span(group), quoted.group(group)))
            at = quoted.end()
        elif text[at] == "(" and not literals and not names:
            depth += 1
            at = _WIDE_GAP.match(text, at + 1).end()
            continue
        else:
            bare = _BARE.match(text, at)
            if not bare:
                break
            name = _NAME.match(bare.group())
            if name:
                names.append(name.group(1))
            if not name or literal_score(bare.group()):
                literals.append((*bare.span(), bare.group()))
            at = bare.end()
            if not depth and not name:
                break
        gap = (_WIDE_GAP if depth else _GAP).match(text, at).end()
        join = _JOIN.match(text, gap)
        if join:
            at = _WIDE_GAP.match(text, join.end()).end()
        elif quoted and _QUOTED.match(text, gap):
            at = gap
        else:
            break
    if len(literals) > 1:  # one literal in several pieces
        joined_ = "".join(v for _, _, v in literals)
        literals = [(literals[0][0], literals[-1][1], joined_)]
    return literals, names, at


def _pairs(text: str):
    """(scope, name, literals, names) of each assignment, in order; a scope is a tuple of names."""
    parents: list[tuple[int, str]] = []  # indent and name of the keys around
    done = 0
    for mark in _MARK.finditer(text):
        if mark.start() < done:  # inside a value that has been read
            continue
        target = _name_before(text, mark.start())
        if target is None:
            continue
        name, start = target
        line = text.rfind("\n", max(0, start - LONGEST_NAME), start) + 1
        head = text[line:start]
        indent = len(head) - len(head.lstrip(" \t"))
        if head.strip(" \t\"'-") == "":  # the first word of its line
            while parents and parents[-1][0] >= indent:
                parents.pop()
        scope = tuple(p for _, p in parents)
        if mark.group() == ":" and _PARENT.match(text, mark.end()):
            if len(parents) < 32:
                parents.append((indent, name))
            continue
        literals, names, done = _value(text, mark.end(), indent)
        yield scope, name, literals, names
    for found in _ELEMENT.finditer(text):
        yield (), found.group(1), [(*found.span(2), found.group(2))], []


def named_literals(text: str) -> list[tuple[int, int, str, float]]:
    """Literals with start, end, the most telling name that they reach, and the score."""
    literals: list[tuple[int, int, str]] = []
    defined: dict[tuple, list[int]] = {}  # (scope, name): its definitions, in order
    names: list[tuple] = []  # by definition: scope and name
    own: list[list[int]] = []  # by definition: literals
    given_to: list[list[int]] = []  # by definition: later ones that use it
    waiting: list[tuple[int, tuple, str]] = []  # aliases of names that are not yet defined

    def lookup(scope: tuple, name: str) -> list[int] | None:
        for n in range(len(scope), -1, -1):
            if (scope[:n], name) in defined:
                return defined[scope[:n], name]
        if "." in name:  # a name with its parents
            *outer, last = name.split(".")
            return defined.get((tuple(outer), last))
        return None

    for scope, name, found, used in _pairs(text):
        number = len(names)
        for alias in used:
            known = lookup(scope, alias)
            if known:
                given_to[known[-1]].append(number)
            else:
                waiting.append((number, scope, alias))
        names.append((scope, name))
        own.append(list(range(len(literals), len(literals) + len(found))))
        given_to.append([])
        literals += found
        defined.setdefault((scope, name), []).append(number)
    for number, scope, alias in waiting:
        known = lookup(scope, alias)
        if known:
            later = [k for k in known[:1] if k != number]
            for k in later:
                given_to[k].append(number)
    # The most telling name that each definition's value reaches, itself included: values flow
    # from the most telling definitions backwards, each definition settled once.
    weight = [name_score(".".join((*scope[-2:], name))) for scope, name in names]
    takes: list[list[int]] = [[] for _ in names]
    for k, users in enumerate(given_to):
        for user in users:
            takes[user].append(k)
    reach: dict[int, int] = {}
    for start in sorted(range(len(names)), key=lambda k: (-weight[k], k)):
        queue = deque([start])
        while queue:
            k = queue.popleft()
            if k not in reach:
                reach[k] = start
                queue.extend(takes[k])
    out = []
    for k, numbers in enumerate(own):
        best = reach[k]
        for number in numbers:
            start, end, value = literals[number]
            variety = literal_score(value)
            score = weight[best] + variety * (weight[best] > 0)
            if variety >= 0.5 and score >= THRESHOLD:
                out.append((start, end, names[best][1], score))
    return sorted(set(out))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    found += [(*m.span(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def all_spans(text: str, base: list[tuple[int, int, str]], named=None) -> list[tuple[int, int, str]]:
    """The base spans, and named literals that none of them covers."""
    starts = [a for a, _, _ in base]
    reach = list(accumulate((b for _, b, _ in base), max))  # of all spans that begin by then
    extra = set()
    for start, end, _, _ in named_literals(text) if named is None else named:
        before = bisect_right(starts, start)
        if not before or reach[before - 1] < end:
            extra.add((start, end, "named"))
    return sorted([*base, *extra], key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _suspects(block: Block) -> np.ndarray:
    """Texts that can hold any span: a mark of assignment, an access key or a long hex run."""
    data, offsets = block.data, block.offsets
    count = np.concatenate(([0], np.cumsum(_MARKS[data])))
    some = count[offsets[1:]] > count[offsets[:-1]]
    edge = np.flatnonzero(np.diff(np.concatenate(([0], _HEX_BYTES[data].view(np.int8), [0]))))
    begin, end = edge[::2], edge[1::2]  # may cross texts, which only adds suspects
    long = end - begin >= 16
    for a, b in zip(begin[long], end[long], strict=True):
        first = np.searchsorted(offsets, a, "right") - 1
        some[first : np.searchsorted(offsets, b, "left")] = True
    whole = data.tobytes()
    at = whole.find(b"AKIA")
    while at >= 0:
        some[np.searchsorted(offsets, at, "right") - 1] = True
        at = whole.find(b"AKIA", at + 4)
    return some


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def _scan(batches, redacted: bool):
    """Counts and spans, or the rows themselves without their secrets."""
    for batch in batches:
        rows = batch.num_rows
        base: list[list] = [[]] * rows
        spans: list[list] = [[]] * rows
        clean: list[str | None] = [None] * rows
        scores: list[str] = [""] * rows
        for block in blocks(batch.column("text")):
            for i in np.flatnonzero(_suspects(block)):
                text = block.text(i).decode("utf-8", "replace")
                base[block.first + i] = base_spans(text)
                named = named_literals(text)
                spans[block.first + i] = all_spans(text, base[block.first + i], named)
                scores[block.first + i] = ",".join(
                    f"{name}:{start}:{end}:{score:.3f}" for start, end, name, score in named
                )
                if redacted and spans[block.first + i]:
                    clean[block.first + i] = redact(text, spans[block.first + i])
        if redacted:
            if any(c is not None for c in clean):
                given = batch.column("text").to_pylist()
                text = [g if c is None else c for g, c in zip(given, clean, strict=True)]
                at = batch.schema.get_field_index("text")
                batch = batch.set_column(at, "text", pa.array(text, pa.string()))
            yield batch
            continue
        kinds = [Counter(kind for _, _, kind in found) for found in spans]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                *(pa.array([k[kind] for k in kinds], pa.int64()) for kind in KINDS),
                pa.array([joined(found) for found in base], pa.string()),
                pa.array([joined(found) for found in spans], pa.string()),
                pa.array(scores, pa.string()),
            ],
            [batch.schema.names[0], *(f"n_{kind}" for kind in KINDS), "base", "spans", "scores"],
        )


def redact(text: str, spans: list[tuple[int, int, str]], mark: str = "[SECRET]") -> str:
    """The text with each run of overlapping spans replaced by a mark."""
    out, at = [], 0
    reach = -1
    for start, end, _ in sorted(spans):
        if start >= reach:
            out += [text[at:start], mark]
        reach = at = max(reach, end)
    return "".join([*out, text[at:]])


_COUNTS = ", ".join(f"n_{kind} bigint" for kind in KINDS)


def secret_spans(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, a count per kind, `base` and `spans` as kind:start:end lists, and `scores`:
    name:start:end:score of every literal that reaches a telling name."""
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col("text").cast("string").alias("text")).mapInArrow(
        lambda batches: _scan(batches, False), f"{key} {kind}, {_COUNTS}, base string, spans string, scores string"
    )


def redact_secrets(docs: DataFrame) -> DataFrame:
    """All columns of the input with each secret in `text` replaced by a mark."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(lambda batches: _scan(batches, True), fields)


def secret_digest(docs: DataFrame) -> DataFrame:
    """The contract's row per document."""
    return secret_spans(docs).select(
        "doc_id",
        *(f"n_{kind}" for kind in KINDS),
        F.sha2("base", 256).alias("base_sha256"),
        "spans",
        "scores",
    )


def sha256_of(spans: list[tuple[int, int, str]]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()

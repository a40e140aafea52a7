"""Random records and commands against plain Python, with a third on one key."""

import collections
import datetime as dt
import random

import pytest

import tagloom as tl
from tagloom.schema import COMMAND_SCHEMA, SECTIONS, TAG_SCHEMA

from conftest import rows

T0 = dt.datetime(2025, 1, 1)


def pick_tag(rng):
    return 1 if rng.random() < 1 / 3 else rng.randrange(2, 40)


def random_commands(seed, n=600):
    rng = random.Random(seed)
    given = []
    for seq in range(n):
        # Few instants, so that seq often decides, and some commands without a time.
        ts = None if rng.random() < 0.05 else T0 + dt.timedelta(seconds=rng.randrange(30))
        name = rng.choice([None, "", " ", "0", "false", "é", "É", f"n{seq}"])
        given.append((pick_tag(rng), ts, seq, name))
    rng.shuffle(given)
    return given


def replay(given, names):
    """What an editor sees that handles one command after the other."""
    seen, current = [], dict(names)
    for tag, ts, seq, name in sorted(given, key=lambda c: (c[1] is not None, c[1] or T0, c[2])):
        if tag not in current:
            continue
        shown = current[tag]
        if name:
            current[tag] = name
        seen.append((tag, seq, shown, bool(name), current[tag]))
    return sorted(seen, key=repr), current


@pytest.mark.parametrize("seed, hot_rows", [(1, 1_000_000), (2, 60), (3, 150)])
def test_renames(spark, seed, hot_rows):
    given = random_commands(seed)
    names = {tag: None if tag == 7 else f"tag {tag}" for tag in range(0, 35)}
    tags = spark.createDataFrame(
        [(tag, 0, 1, 0, name, "d", [], [], [], []) for tag, name in names.items()], TAG_SCHEMA
    )
    commands = spark.createDataFrame(given, COMMAND_SCHEMA).repartition(4)
    seen, current = replay(given, names)
    audit = tl.rename_audit(tags, commands, hot_rows)
    assert rows(audit, "tag_id", "seq", "name_shown", "accepted", "name_after") == seen
    assert dict(rows(tl.current_tags(tags, commands), "tag_id", "tag_name")) == current
    unknown = [(c[0], c[2]) for c in given if c[0] not in names]
    assert rows(tl.unknown_tag_commands(tags, commands), "tag_id", "seq") == sorted(
        unknown, key=repr
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_lists(spark, seed):
    rng = random.Random(seed)

    def items():
        if rng.random() < 0.1:
            return None
        texts = ["a", "A", "", " ", "é", "01", "1", None]
        return [rng.choice(texts) for _ in range(rng.randrange(12))]

    records = [(tag, 0, 1, 0, "n", "d", items(), items(), items(), items()) for tag in range(150)]
    tags = spark.createDataFrame(records, TAG_SCHEMA)
    chips, repeated = [], []
    for tag, _, _, _, _, _, *lists in records:
        for ord_, ((label, _), held) in enumerate(zip(SECTIONS, lists)):
            chips += [(tag, ord_, label, i, item) for i, item in enumerate(held or [])]
            counts = collections.Counter(held or [])
            repeated += [
                (tag, ord_, label, item, n, held.index(item)) for item, n in counts.items() if n > 1
            ]
    columns = ("tag_id", "section_ord", "label")
    assert rows(tl.tag_chips(tags), *columns, "item_pos", "item") == sorted(chips, key=repr)
    for find in (tl.duplicate_chip_keys, tl.duplicate_chip_keys_per_row):
        assert rows(find(tags), *columns, "item", "n", "first_pos") == sorted(repeated, key=repr)
    assert tl.tag_sections(tags).count() == 4 * len(records)

"""The built-in record, edge rows and record parts."""

import json

import pytest
from pyspark.sql import functions as F

import tagloom as tl
from tagloom.schema import TAG_SCHEMA
from tagloom.sources import driver_tables
from tagloom.sources.tags import GOLDEN_TAG

from conftest import rows

LISTS = ("accounts", "units", "drivers", "areas")


@pytest.fixture(scope="module")
def golden(spark):
    return tl.golden_tags(spark)


@pytest.fixture(scope="module")
def edges(spark):
    """Empty and NULL lists, NULL fields, duplicates, blanks, NULL and empty items."""
    return spark.createDataFrame(
        [
            (1, 0, 1, 0, "a", "d1", [], None, ["x", "x", "y", "x", "y"], ["0054", " 0054", "0054"]),
            (2, 0, 1, 0, None, None, None, None, None, None),
            (3, 0, 1, 0, "", " ", [""], ["", ""], [None, "z", None], ["É", "é", "É"]),
        ],
        TAG_SCHEMA,
    )


def test_golden_titles_and_fields(golden):
    assert rows(tl.tag_titles(golden), "tag_id", "tag_name") == [(1, "Ali Tag")]
    assert rows(tl.tag_fields(golden), "field_ord", "label", "value") == [
        (0, "Tag Name", "Ali Tag"),
        (1, "Created Date", "2025-10-15 17:44:32"),
    ]


def test_golden_sections(golden):
    sections = tl.tag_sections(golden).withColumn("n", F.size("items"))
    assert rows(sections, "section_ord", "label", "n") == [
        (0, "Accounts", 1),
        (1, "Units", 11),
        (2, "Drivers", 6),
        (3, "Areas", 5),
    ]


def test_golden_chips(golden):
    chips = rows(tl.tag_chips(golden), "section_ord", "item_pos", "item")
    assert len(chips) == 23
    assert [item for _, _, item in sorted(chips)] == [
        item for column in LISTS for item in GOLDEN_TAG[column]
    ]


def test_golden_duplicate(golden):
    for find in (tl.duplicate_chip_keys, tl.duplicate_chip_keys_per_row):
        assert rows(find(golden), "tag_id", "label", "item", "n", "first_pos") == [
            (1, "Drivers", "Ahmad", 2, 2)
        ]


def test_golden_card(golden):
    card = json.loads(tl.tag_cards(golden).first()["card"])
    assert card == {
        "tag_id": 1,
        "part": 0,
        "parts": 1,
        "first_item": 0,
        "title": "Ali Tag",
        "fields": {"Tag Name": "Ali Tag", "Created Date": "2025-10-15 17:44:32"},
        "sections": {
            "Accounts": GOLDEN_TAG["accounts"],
            "Units": GOLDEN_TAG["units"],
            "Drivers": GOLDEN_TAG["drivers"],
            "Areas": GOLDEN_TAG["areas"],
        },
    }
    assert list(card["sections"]) == ["Accounts", "Units", "Drivers", "Areas"]


def test_empty_and_null_lists_keep_their_section(edges):
    sections = tl.tag_sections(edges).where("tag_id < 3")
    assert rows(sections, "tag_id", "section_ord", "items") == [
        (1, 0, []),
        (1, 1, None),
        (1, 2, ["x", "x", "y", "x", "y"]),
        (1, 3, ["0054", " 0054", "0054"]),
        (2, 0, None),
        (2, 1, None),
        (2, 2, None),
        (2, 3, None),
    ]
    assert rows(tl.tag_chips(edges).where("tag_id = 2"), "item") == []


def test_labels_choose_sections(edges):
    some = tl.tag_sections(edges, ["Areas", "Drivers"])
    everything = tl.tag_sections(edges)
    assert rows(some) == rows(everything.where("label in ('Areas', 'Drivers')"))
    with pytest.raises(ValueError):
        tl.tag_sections(edges, ["Nobody"])


def test_duplicates_keep_text_apart(edges):
    expected = [
        (1, "Areas", "0054", 2, 0),
        (1, "Drivers", "x", 3, 0),
        (1, "Drivers", "y", 2, 2),
        (3, "Areas", "É", 2, 0),
        (3, "Drivers", None, 2, 0),
        (3, "Units", "", 2, 0),
    ]
    for find in (tl.duplicate_chip_keys, tl.duplicate_chip_keys_per_row):
        found = rows(find(edges), "tag_id", "label", "item", "n", "first_pos")
        assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_null_fields_stay_in_the_card(edges):
    card = json.loads(tl.tag_cards(edges).where("tag_id = 2").first()["card"])
    assert card["title"] is None and card["sections"]["Units"] is None


def test_lines_show_every_view(edges):
    outputs = tl.tag_outputs(edges)
    lines = tl.tag_lines(edges)
    shown = rows(lines.where("output = 'title'"), "tag_id", "value")
    assert shown == rows(outputs["titles"], "tag_id", "tag_name")
    shown = rows(lines.where("output = 'field'"), "tag_id", "ord", "label", "value")
    assert shown == rows(outputs["fields"], "tag_id", "field_ord", "label", "value")
    items = lines.where("output = 'section' and pos >= 0")
    shown = rows(items, "tag_id", "ord", "label", "pos", "value")
    assert shown == rows(
        outputs["chips"], "tag_id", "section_ord", "label", "item_pos", "item"
    )
    empty = lines.where("pos = -1")
    assert rows(empty, "tag_id", "label") == rows(
        outputs["sections"].where("coalesce(size(items), 0) = 0"), "tag_id", "label"
    )


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_records_survive_a_file(spark, golden, edges, tmp_path, fmt):
    tags = golden.unionByName(edges)
    path = str(tmp_path / fmt)
    writer = tags.drop("part").write.format(fmt)
    (writer.option("ignoreNullFields", False) if fmt == "json" else writer).save(path)
    assert rows(tl.read_tags(spark, path, fmt)) == rows(tags)


def test_cards_as_json_lines_and_parquet(spark, edges, tmp_path):
    cards = tl.tag_cards(edges).withColumn("day", F.lit("d1"))
    tl.write_cards(cards, str(tmp_path / "json"), "json", partition_by=["day"])
    tl.write_cards(cards, str(tmp_path / "parquet"), "parquet")
    lines = spark.read.text(str(tmp_path / "json"))
    assert rows(lines, "value", "day") == rows(cards, "card", "day")
    assert rows(spark.read.parquet(str(tmp_path / "parquet"))) == rows(cards)
    with pytest.raises(ValueError):
        tl.write_cards(cards, str(tmp_path / "csv"), "csv")


@pytest.mark.parametrize("hot_rows", [1_000_000, 9])
def test_lists_in_parts_give_the_same_items(spark, sf_dir, hot_rows):
    whole = driver_tables.tags(spark, sf_dir)
    parts = driver_tables.tags(spark, sf_dir, part_items=3, hot_rows=hot_rows)
    assert parts.agg(F.max(F.size("units"))).first()[0] == 3
    assert parts.where("part > 0").count() > 0
    assert rows(tl.tag_titles(parts)) == rows(tl.tag_titles(whole))
    assert rows(tl.tag_fields(parts)) == rows(tl.tag_fields(whole))
    assert rows(tl.tag_chips(parts)) == rows(tl.tag_chips(whole))
    assert rows(tl.tag_lines(parts)) == rows(tl.tag_lines(whole))
    assert rows(tl.duplicate_chip_keys(parts)) == rows(
        tl.duplicate_chip_keys(whole)
    )
    sections = tl.tag_sections(parts).groupBy("tag_id", "label").agg(
        F.sort_array(F.collect_list(F.struct("part", "items"))).alias("parts")
    )
    joined = sections.select("tag_id", "label", F.flatten("parts.items").alias("items"))
    assert rows(joined) == rows(tl.tag_sections(whole).select("tag_id", "label", "items"))


def test_chips_per_tag_equal_list_sizes(spark, sf_dir):
    tags = driver_tables.tags(spark, sf_dir).cache()
    sizes = sum((F.size(c) for c in LISTS), F.lit(0))
    expected = tags.select("tag_id", sizes.cast("long").alias("n")).where("n > 0")
    assert rows(tl.tag_chips(tags).groupBy("tag_id").agg(F.count("*").alias("n"))) == rows(
        expected
    )
    assert rows(tl.duplicate_chip_keys(tags)) == rows(tl.duplicate_chip_keys_per_row(tags))
    tags.unpersist()


def test_plain_tables_need_no_part_columns(golden):
    plain = golden.drop("part", "parts", "first_item")
    for operator in (
        tl.tag_titles,
        tl.tag_fields,
        tl.tag_sections,
        tl.tag_chips,
        tl.tag_cards,
        tl.tag_lines,
        tl.duplicate_chip_keys,
    ):
        assert rows(operator(plain)) == rows(operator(golden))
    with pytest.raises(ValueError):
        tl.tag_chips(golden.drop("first_item"))


@pytest.mark.parametrize("part_items", [1, 3, 10_000])
def test_readers_do_not_know_the_part_size(spark, golden, edges, tmp_path, part_items):
    tags = golden.unionByName(edges.withColumn("tag_id", F.col("tag_id") + 10))
    tl.write_tags(tags, str(tmp_path / "tags"), part_items=part_items)
    stored = tl.read_tags(spark, str(tmp_path / "tags"))
    for operator in (tl.tag_titles, tl.tag_fields, tl.tag_chips, tl.duplicate_chip_keys):
        assert rows(operator(stored)) == rows(operator(tags))
    assert rows(tl.tag_lines(stored)) == rows(tl.tag_lines(tags))


def test_each_card_says_whose_it_is(spark, golden, tmp_path):
    tl.write_tags(golden, str(tmp_path / "tags"), part_items=4)
    cards = tl.tag_cards(tl.read_tags(spark, str(tmp_path / "tags")), keep=["created_date"])
    tl.write_cards(cards, str(tmp_path / "cards"))
    lines = [json.loads(row[0]) for row in spark.read.text(str(tmp_path / "cards")).collect()]
    lines.sort(key=lambda card: card["part"])
    assert [(c["tag_id"], c["part"], c["parts"], c["first_item"]) for c in lines] == [
        (1, 0, 3, 0),
        (1, 1, 3, 4),
        (1, 2, 3, 8),
    ]
    assert sum((c["sections"]["Units"] for c in lines), []) == GOLDEN_TAG["units"]


@pytest.mark.parametrize("hot_rows", [1_000_000, 5])
def test_unknown_names_leave_no_gap(spark, sf_dir, tmp_path, hot_rows):
    """Parts, suppliers and customers that are missing: the same answer whatever the heat."""
    missing = {"part": "p_partkey", "supplier": "s_suppkey", "customer": "c_custkey"}
    for name in ("region", "nation", "part", "supplier", "customer", "orders", "lineitem"):
        rows_ = driver_tables.table(spark, sf_dir, name)
        if name in missing:
            rows_ = rows_.where(F.col(missing[name]) % 7 != 3)
        rows_.write.parquet(f"{tmp_path}/{name}.parquet")
    tags = driver_tables.tags(spark, str(tmp_path), 3, hot_rows)
    whole = driver_tables.tags(spark, str(tmp_path))
    assert rows(tl.tag_chips(tags)) == rows(tl.tag_chips(whole))
    orders = driver_tables.table(spark, sf_dir, "orders").count()
    assert tl.tag_titles(tags).count() == orders == whole.count()
    lines = driver_tables.table(spark, sf_dir, "lineitem").count()
    assert tl.tag_chips(tags, ["Units"]).count() == lines


def test_a_list_of_any_length_has_one_entry(spark):
    whole = spark.createDataFrame(
        [(1, "a", "d", ["x"], [str(i) for i in range(25)], [], None), (2, "b", "d", [], None, ["y"], [])],
        "tag_id bigint, tag_name string, created_date string, accounts array<string>,"
        " units array<string>, drivers array<string>, areas array<string>",
    )
    want = [
        (1, 0, "Accounts", 1), (1, 1, "Units", 25), (1, 2, "Drivers", 0), (1, 3, "Areas", None),
        (2, 0, "Accounts", 0), (2, 1, "Units", None), (2, 2, "Drivers", 1), (2, 3, "Areas", 0),
    ]
    columns = ("tag_id", "section_ord", "label", "n_items")
    for parts in (whole, tl.split_records(whole, 10), tl.split_records(whole, 1)):
        assert rows(tl.tag_section_entries(parts), *columns) == want

"""Tags, commands and events in the shape of the library, read from the order tables.

One tag per order: its lines give the units (parts) and drivers (suppliers), its
customer the account and the areas. One rename command per event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ordering import (
    HOT_ROWS,
    MAX_SPLITS,
    divide_by_heat,
    hot_keys,
    split_position,
    window_position,
)
from ..schema import PART_ITEMS

# The columns in use, so that opening a table reads no file.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "supplier": "s_suppkey bigint, s_name string",
    "part": "p_partkey bigint, p_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_extendedprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "documents": "doc_id bigint, text string",
}

LIST_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # A glob, because a stream's plain path has to be a folder and the table may be a file.
    path = f"{sf_dir}/{{{name}}}.parquet"
    return spark.readStream.schema(TABLES[name]).parquet(path)


def tag_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags without their lists: scans the orders only."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").alias("tag_id"),
        F.lit(0).alias("part"),
        F.lit(1).alias("parts"),
        F.lit(0).cast("long").alias("first_item"),
        _tag_name().alias("tag_name"),
        _created_date().alias("created_date"),
    )


def tags(
    spark: SparkSession,
    sf_dir: str,
    part_items: int = PART_ITEMS,
    hot_rows: int = HOT_ROWS,
    max_splits: int = MAX_SPLITS,
) -> DataFrame:
    """Whole tags, one for every order. No row holds more than `part_items` lines of an order,
    and an order with a large share of all lines is put together by many tasks.

    Names are looked up without losing a line, so an order's lines are numbered alike whether
    that comes before or after (keys of parts and suppliers are unique). An unknown part or
    supplier is a NULL item; an unknown customer or nation leaves its lists empty.
    """
    orders = table(spark, sf_dir, "orders")
    places = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("n_nationkey", F.array("n_name", "r_name").alias("areas"))
    )
    customers = (
        table(spark, sf_dir, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select("c_custkey", F.array("c_name").alias("accounts"), "areas")
    )
    heads = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        F.col("o_orderkey").alias("tag_id"),
        _tag_name().alias("tag_name"),
        _created_date().alias("created_date"),
        "accounts",
        "areas",
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("tag_id"), *LIST_ORDER
    )

    def named(lines: DataFrame) -> DataFrame:
        return named_lines(spark, sf_dir, lines)

    hot = hot_keys(lines, ["tag_id"], hot_rows)
    if not hot:
        return _records(heads, _lists(_counted(named(lines)), part_items), part_items)
    cold_heads, hot_heads = divide_by_heat(heads, ["tag_id"], hot)
    cold_lines, hot_lines = divide_by_heat(lines, ["tag_id"], hot)
    # Numbered before they get names: cutting the ranges reads its input twice.
    split = split_position(
        hot_lines, ["tag_id"], LIST_ORDER, hot, hot_rows=hot_rows, max_splits=max_splits
    )
    # As few counts and heads as there are hot orders.
    counts = spark.createDataFrame(
        [(row["tag_id"], row["n"]) for row in hot], "tag_id bigint, n bigint"
    )
    split = named(split.join(F.broadcast(counts), "tag_id"))
    cold = _lists(_counted(named(cold_lines)), part_items)
    return _records(cold_heads, cold, part_items).unionByName(
        _records(F.broadcast(hot_heads), _lists(split, part_items), part_items, "inner")
    )


def commands(events: DataFrame) -> DataFrame:
    """Rename commands from an events table or stream."""
    kind = F.col("event_type")
    new_name = (
        F.when(kind == "error", F.lit(None))
        .when(kind == "view", F.lit(""))
        .when(kind == "signup", F.lit(" "))
        .otherwise(F.concat(kind, F.lit("-"), F.get_json_object("props", "$.k")))
    )
    return events.select(
        F.col("user_id").alias("tag_id"),
        "ts",
        F.col("event_id").alias("seq"),
        new_name.alias("new_name"),
    )


def _tag_name():
    return F.concat(F.lit("Tag#"), F.col("o_orderkey").cast("string"))


def _created_date():
    # A timestamp without zone, cut to whole seconds; date_format would go through the
    # session's zone.
    return F.substring(F.col("o_orderdate").cast("string"), 1, 19)


def named_lines(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """`lines` with the names of their part and supplier."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .drop("p_partkey", "s_suppkey")
    )


def _counted(lines: DataFrame) -> DataFrame:
    """Lines of ordinary orders with their place and the number of lines of the order."""
    return window_position(lines, ["tag_id"], LIST_ORDER).withColumn(
        "n", F.count(F.lit(1)).over(Window.partitionBy("tag_id"))
    )


def _lists(numbered: DataFrame, part_items: int) -> DataFrame:
    """The names in list order, and how many parts the order has."""
    part = F.expr(f"int((position - 1) div {part_items})")
    line = F.struct("position", "p_name", "s_name")
    return (
        numbered.groupBy("tag_id", part.alias("part"))
        .agg(F.sort_array(F.collect_list(line)).alias("lines"), F.first("n").alias("n"))
        .select(
            "tag_id",
            "part",
            F.expr(f"int((n + {part_items} - 1) div {part_items})").alias("parts"),
            F.col("lines.p_name").alias("units"),
            F.col("lines.s_name").alias("drivers"),
        )
    )


def _records(
    heads: DataFrame, lists: DataFrame, part_items: int, how: str = "left"
) -> DataFrame:
    nothing = F.array().cast("array<string>")
    part = F.coalesce("part", F.lit(0))
    first = part == 0
    return heads.join(lists, "tag_id", how).select(
        "tag_id",
        part.alias("part"),
        F.coalesce("parts", F.lit(1)).alias("parts"),
        (part.cast("long") * part_items).alias("first_item"),
        F.when(first, F.col("tag_name")).alias("tag_name"),
        F.when(first, F.col("created_date")).alias("created_date"),
        F.when(first, F.coalesce("accounts", nothing)).otherwise(nothing).alias("accounts"),
        F.coalesce("units", nothing).alias("units"),
        F.coalesce("drivers", nothing).alias("drivers"),
        F.when(first, F.coalesce("areas", nothing)).otherwise(nothing).alias("areas"),
    )

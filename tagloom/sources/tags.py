"""Tag records from files, as a table or as a stream, and the one built-in record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import PART_ITEMS, SECTIONS, TAG_SCHEMA

# The built-in record.
GOLDEN_TAG = {
    "tag_id": 1,
    "part": 0,
    "parts": 1,
    "first_item": 0,
    "tag_name": "Ali Tag",
    "created_date": "2025-10-15 17:44:32",
    "accounts": ["Ali yaseen"],
    "units": [
        "Test Car",
        "1702 كادي",
        "بوكسر - 2512",
        "Sprinter - 1249",
        "518 مرسيدس",
        "كادي Aljaber",
        "ايڤيكو ديلي",
        "اتيكو 1568",
        "متسوبشي هنتر 5160",
        "0054 - سيات",
        "اسوزو",
    ],
    "drivers": ["Firas Shaarawi", "Ashraf Skafi", "Ahmad", "Ahmad", "Driver1", "Tawfiq1"],
    "areas": ["Test###", "وكالة هونداي", "Test Test", "Roa Test", "New Test"],
}


def golden_tags(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([GOLDEN_TAG], TAG_SCHEMA)


def read_tags(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Tag records stored as Parquet, ORC or JSON lines."""
    return _whole_records(spark.read.schema(TAG_SCHEMA).format(fmt).load(path))


def stream_tags(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """The same records as files arrive in `path`."""
    reader = spark.readStream.schema(TAG_SCHEMA).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _whole_records(reader.load(path))


def split_records(tags: DataFrame, part_items: int = PART_ITEMS) -> DataFrame:
    """Records of one row each as rows of at most `part_items` items a list, for writing."""
    lists = [column for _, column in SECTIONS]
    longest = F.greatest(F.lit(1), *(F.coalesce(F.size(c), F.lit(0)) for c in lists))
    parts = F.ceil(longest / part_items).cast("int")
    rows = tags.drop("part", "parts", "first_item").withColumn("parts", parts)
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    first = F.col("part").cast("long") * part_items
    start = (F.col("part") * part_items + 1).cast("int")
    nothing = F.array().cast("array<string>")

    def cut(column: str):
        piece = F.slice(column, start, part_items)
        return F.when(F.col("part") == 0, piece).otherwise(F.coalesce(piece, nothing))

    return rows.withColumns(
        {"first_item": first}
        | {c: cut(c) for c in lists}
        | {c: F.when(F.col("part") == 0, F.col(c)) for c in ("tag_name", "created_date")}
    ).select(*(c for c in TAG_SCHEMA.names if c in rows.columns or c == "first_item"))


def write_tags(
    tags: DataFrame, path: str, fmt: str = "parquet", part_items: int = PART_ITEMS
) -> None:
    """Stores records of one row each so that no stored row outgrows `part_items` a list."""
    split_records(tags, part_items).write.format(fmt).save(path)


def _whole_records(tags: DataFrame) -> DataFrame:
    # Files written without these columns hold each record in one row.
    return tags.withColumns(
        {
            "part": F.coalesce("part", F.lit(0)),
            "parts": F.coalesce("parts", F.lit(1)),
            "first_item": F.coalesce("first_item", F.lit(0).cast("long")),
        }
    )

"""Explicit schemas. Nothing is inferred: digits-only names must stay text."""

from pyspark.sql import types as T

# A record whose lists outgrow one row is stored as several rows. Each row says which one it
# is (`part`, from 0), how many there are (`parts`), and the place in the whole list of the
# first item that its lists hold (`first_item`). Part 0 holds the name and the date. How many
# items a part may hold is the writer's choice, by default PART_ITEMS; readers do not know it.
PART_ITEMS = 10_000
PARTS = ("part", "parts", "first_item")

# Default names of a record's key and of the columns that put commands in order.
KEY = "tag_id"
ORDER = ("ts", "seq")

_TEXT_LIST = T.ArrayType(T.StringType())

TAG_SCHEMA = T.StructType(
    [
        T.StructField("tag_id", T.LongType(), False),
        T.StructField("part", T.IntegerType()),
        T.StructField("parts", T.IntegerType()),
        T.StructField("first_item", T.LongType()),
        T.StructField("tag_name", T.StringType()),
        T.StructField("created_date", T.StringType()),  # shown verbatim, never parsed
        T.StructField("accounts", _TEXT_LIST),
        T.StructField("units", _TEXT_LIST),
        T.StructField("drivers", _TEXT_LIST),
        T.StructField("areas", _TEXT_LIST),
    ]
)

COMMAND_SCHEMA = T.StructType(
    [
        T.StructField("tag_id", T.LongType(), False),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("seq", T.LongType()),
        T.StructField("new_name", T.StringType()),  # NULL: the edit was cancelled
    ]
)

# Display labels in display order, with the column each one shows.
FIELDS = (("Tag Name", "tag_name"), ("Created Date", "created_date"))
SECTIONS = (
    ("Accounts", "accounts"),
    ("Units", "units"),
    ("Drivers", "drivers"),
    ("Areas", "areas"),
)

"""Tables stored by buckets of their key, so that joins on the key move nothing.

Two tables with the same number of buckets are joined bucket by bucket. A reader that needs
few keys opens only their buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import KEY

BUCKETS = 256
# With more keys than that nearly every bucket is read anyway.
FEW_KEYS = 1_000


def write_bucketed(
    rows: DataFrame, table: str, path: str, buckets: int = BUCKETS, key: str = KEY
) -> None:
    """Stores `rows` as the catalog's table `table` under `path`, a file per bucket."""
    (
        rows.repartition(buckets, key)
        .write.bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(table)
    )


def read_bucketed(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def only_keys(rows: DataFrame, wanted: DataFrame, key: str = KEY, few: int = FEW_KEYS) -> DataFrame:
    """`rows`, which are to be joined with `wanted` on `key`, without most that cannot match.

    Up to `few` keys become a literal condition, which prunes buckets and reaches the files;
    with more of them the rows are left as they are. Keys that are NULL match nothing.
    """
    keys = [r[0] for r in wanted.select(key).where(F.col(key).isNotNull()).distinct().take(few + 1)]
    return rows.where(F.col(key).isin(keys)) if len(keys) <= few else rows

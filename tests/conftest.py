import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{TESTDATA}/sf0.001"


def rows(df, *columns):
    """Sorted rows of the named columns (all columns, by name, if none are named)."""
    columns = columns or sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)

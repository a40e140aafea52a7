"""What the operators need from the session: a folder every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
import warnings

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, `spark.checkpoint.dir`.

    Only a local session, where driver and executors are one process on one machine,
    gets a folder of its own when the setting is missing.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        folder = context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tagloom-"))
        folder = context.getCheckpointDir()
    on_disk = folder.startswith("/") or folder.startswith("file:")
    if on_disk and not spark.sparkContext.master.startswith("local"):
        # It may be a mount that all machines have, which cannot be seen from here.
        warnings.warn(f"{folder} must be one folder for all executors, not one each", stacklevel=3)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str, under: str | None = None) -> str:
    """A new, unused path under `under`, or under the shared folder."""
    root = under.rstrip("/") if under else shared_dir(spark)
    return f"{root}/{purpose}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> bool:
    """Deletes a folder of intermediate rows, wherever Spark keeps it."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(conf).delete(folder, True)

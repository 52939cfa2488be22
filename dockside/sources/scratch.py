"""Written intermediate tables.

A result that several reports read is written once and read back.  That cuts its
lineage, keeps it when executors are lost, and leaves nothing cached.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names.

    Only a local session may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = f"{tempfile.gettempdir()}/dockside-scratch"
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for one result."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write a result that several reports share, and return the written table."""
    path = path or scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder in whatever store it lies."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.delete(folder, True)


def session_folder(spark: SparkSession, name: str) -> str:
    """A scratch folder for a result that is read later: it is gone when the process ends."""
    path = scratch_path(spark, f"session-{name}")

    def drop() -> None:
        if spark.sparkContext._jsc is not None:  # else the session ended before
            drop_folder(spark, path)

    atexit.register(drop)
    return path


@contextmanager
def run_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A scratch folder for the length of one run; it is gone when the run ends or fails."""
    path = scratch_path(spark, name)
    try:
        yield path
    finally:
        drop_folder(spark, path)

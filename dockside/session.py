"""Session settings the reports are tuned for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(
    app: str = "dockside",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    initial_partitions: int = 8000,
    **conf: str,
) -> SparkSession:
    """A session with adaptive execution on.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the submit
    command names the first, and adaptive execution coalesces the second from the
    high initial count to partitions near the advisory size.  ``initial_partitions`` should let
    the largest shuffle's partitions fit in memory: about one for each 128 MB of it.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        .config("spark.sql.session.timeZone", "UTC")
        # Building a report makes many small expressions; do not record a Python call
        # site for each of them.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.driver.host", "127.0.0.1")
            .config("spark.driver.bindAddress", "127.0.0.1")
            .config("spark.driver.memory", os.environ.get("DOCKSIDE_MEMORY", "8g"))
        )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    else:
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(initial_partitions)
        )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

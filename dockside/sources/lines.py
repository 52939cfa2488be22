"""Facts collapsed by line id and saved in buckets of it.

The cross-table of two facts meets lines by their id.  A saved copy that holds one row for each
id and combination of the columns that cleaning and the table read is much smaller than the
fact where ids repeat, and its buckets let both sides be grouped and joined where they lie:
the shuffle is paid once, at the save.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.measures import plain_sum
from .versions import VersionedFolder

LINE_ID = "NUMBER_SEQ"
# What cleaning and the cross-table read of each fact.
SOT_LINE_KEYS = (
    LINE_ID, "FISCAL_YEAR", "ShipCancelWeek", "ReportingBrand", "Parent_Vendor", "MetricShipDate", "Lateness",
)
OTS_LINE_KEYS = (
    LINE_ID, "FISCAL_YEAR", "Week", "Month_Number", "ReportingBrand", "Parent_Vendor", "DC_NAME", "Lateness",
)


def collapse_lines(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each combination of the keys, with wide ``Units`` and the count of ``lines``.

    An id that repeats very often shrinks in the tasks that read it.  Keys that an extract
    lacks are left out.
    """
    return df.groupBy(*(k for k in keys if k in df.columns)).agg(
        plain_sum("Units", wide=True).alias("Units"), F.count("*").alias("lines")
    )


def write_lines(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Save a fact's collapsed lines in ``buckets`` of the line id, one file each; return the table.

    Like a snapshot, the save is a new version under ``path``.  Let a bucket hold about 256 MB.
    Tables that meet in a join need the same number of buckets.
    """
    spark = df.sparkSession
    versions = VersionedFolder(spark, path)
    folder = versions.new_folder()
    lines = collapse_lines(df, keys).repartition(buckets, LINE_ID)
    writer = lines.write.bucketBy(buckets, LINE_ID).sortBy(LINE_ID).option("path", folder)
    try:
        writer.saveAsTable(_table_name(folder))
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {_table_name(folder)}")
        versions.drop(folder)
        raise
    versions.publish(folder, {"buckets": str(buckets), "schema": lines.schema.json()})
    versions.clean()
    return spark.table(_table_name(folder))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The collapsed lines last saved under ``path``, with their buckets known to Spark."""
    version = VersionedFolder(spark, path).current()
    if version is None:
        raise ValueError(f"no lines are saved under {path}")
    name = _table_name(version.folder)
    if not spark.catalog.tableExists(name):
        schema = T.StructType.fromJson(json.loads(version.notes["schema"]))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({LINE_ID}) "
            f"SORTED BY ({LINE_ID}) INTO {int(version.notes['buckets'])} BUCKETS "
            f"LOCATION '{version.folder}'"
        )
    return spark.table(name)


def _table_name(folder: str) -> str:
    """A name in the session's catalog; the folder alone says where the rows lie."""
    return f"lines_{folder.rsplit('/', 1)[-1].removeprefix('v-')}"

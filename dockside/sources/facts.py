"""Fact tables: database extract, snapshot load and snapshot save."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import conform
from .versions import VersionedFolder, resolve


@dataclass(frozen=True)
class JdbcSource:
    """A fact view in a database, read in parallel over ranges of one column.

    ``cuts`` are ascending boundaries of ``column``; each range is one partition.
    Ranges over a text line id work as well as over a number.  A read through one task
    has to be asked for with ``single_task``.
    """

    url: str
    table: str
    column: str = "NUMBER_SEQ"
    cuts: Sequence[str | int] = ()
    properties: Mapping[str, str] = field(default_factory=dict)
    single_task: bool = False

    def __post_init__(self):
        if bool(self.cuts) == self.single_task:
            raise ValueError("give either cuts, for a parallel read, or single_task=True")


def jdbc_ranges(column: str, cuts: Sequence[str | int]) -> list[str]:
    """Conditions that split a column at the boundaries; together they cover every row."""
    if not cuts:
        return ["1 = 1"]

    def literal(v: str | int) -> str:
        return str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"

    marks = [literal(c) for c in cuts]
    inner = [
        f"{column} >= {a} AND {column} < {b}" for a, b in zip(marks, marks[1:], strict=False)
    ]
    return [f"{column} < {marks[0]} OR {column} IS NULL", *inner, f"{column} >= {marks[-1]}"]


def read_fact(
    spark: SparkSession,
    source: str | JdbcSource,
    schema: T.StructType,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """A fact from a database view or from a saved snapshot, checked against its schema.

    Column pruning and filters reach either source, so a caller need not restrict the
    scan; ``columns`` is for extracts that lack some schema columns.
    """
    if columns:
        schema = T.StructType([schema[c] for c in columns])
    typed = isinstance(source, JdbcSource)
    if isinstance(source, JdbcSource):
        raw = spark.read.jdbc(
            source.url,
            source.table,
            predicates=jdbc_ranges(source.column, source.cuts),
            properties={"fetchsize": "10000", **source.properties},
        )
    else:
        raw = spark.read.parquet(resolve(spark, source))
    return conform(warehouse_types(raw, schema) if typed else raw, schema)


def warehouse_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Database columns cast to the schema; names match in any case.

    Warehouses give decimals, wider integers, timestamps and padded text where the schema
    wants doubles, integers, dates and text.  A value that has no such form fails the read.
    Text loses trailing blanks.
    """
    found = {c.lower(): c for c in df.columns}

    def typed(f: T.StructField) -> Column:
        value = F.col(f"`{found[f.name.lower()]}`")
        if isinstance(df.schema[found[f.name.lower()]].dataType, T.StringType):
            value = F.rtrim(value)
        return value.cast(f.dataType).alias(f.name)

    return df.select(*(typed(f) for f in schema.fields if f.name.lower() in found))


def write_snapshot(df: DataFrame, path: str, by: Sequence[str] = ("FISCAL_YEAR",)) -> DataFrame:
    """Save a fact, split by fiscal year, and return the saved table.

    The save is a new version under ``path`` that readers see once it is whole: one that fails
    leaves the snapshot before it as it was, and a save may read the snapshot it replaces.
    Rows stay in the tasks that hold them: sending each year to one task would put a
    whole year on it.
    """
    versions = VersionedFolder(df.sparkSession, path)
    folder = versions.new_folder()
    try:
        df.write.partitionBy(*by).parquet(folder)
    except Exception:
        versions.drop(folder)
        raise
    versions.publish(folder)
    versions.clean()
    # Partition values come back typed from the schema, not inferred from folder names.
    return df.sparkSession.read.schema(df.schema).parquet(folder).select(*df.columns)

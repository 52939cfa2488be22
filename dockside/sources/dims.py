"""Small dimension files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import COUNTRY_FILE, PREFERRED_VENDOR_FILE

RECORD = "__record"


def _reader(spark: SparkSession, sep: str) -> DataFrameReader:
    return (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", False)
        # Every field is read, so that what counts as malformed does not depend on the report.
        .option("columnPruning", False)
    )


def read_dim(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", bad_rows: int = 0
) -> DataFrame:
    """A delimited file with a header, read by explicit schema.

    Quoted fields may hold the separator and doubled quotes.  Text is kept as it is:
    leading zeros stay, and the code ``NA`` is not taken for a missing value.

    A row with a field that does not fit its type, or with too many or too few fields, is
    malformed and never turns into a row with nulls.  Without ``bad_rows`` it ends the read.
    With it, up to so many are left out, and more end the run before any report reads the rest;
    :func:`split_dim` gives them to look at.
    """
    if not bad_rows:
        return _reader(spark, sep).option("mode", "FAILFAST").schema(schema).csv(path)
    split = split_dim(spark, path, schema, sep)
    found = split.bad.limit(bad_rows + 1).collect()
    if len(found) > bad_rows:
        some = "; ".join(r["record"] for r in found[:5])
        raise ValueError(f"{path}: more than {bad_rows} malformed rows, such as {some}")
    return split.good


@dataclass(frozen=True)
class Split:
    """The rows of a file that fit its schema, and the records that do not, as they stand."""

    good: DataFrame
    bad: DataFrame


def split_dim(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> Split:
    """A delimited file's good rows, and its bad ones as ``record`` and ``file``."""
    wide = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
    rows = (
        _reader(spark, sep)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RECORD)
        .schema(wide)
        .csv(path)
    )
    names = [F.col(f"`{c}`") for c in schema.fieldNames()]
    # The second condition always holds: Spark does not read the record without other fields.
    read = F.hash(*names) >= -(2**31)
    return Split(
        rows.where(F.col(RECORD).isNull() & read).select(*names),
        rows.where(F.col(RECORD).isNotNull() & read).select(
            F.col(RECORD).alias("record"), F.input_file_name().alias("file")
        ),
    )


def read_preferred_vendors(
    spark: SparkSession, path: str, sep: str = ",", bad_rows: int = 0
) -> DataFrame:
    """The published vendor list; an older edition uses another separator."""
    return read_dim(spark, path, PREFERRED_VENDOR_FILE, sep, bad_rows).select(
        F.col("New Category").alias("new_category"),
        F.col("Vendor Name").alias("vendor_name"),
        F.col("Vendor ID").cast("bigint").alias("vendor_id"),
        F.col("Category Status?").alias("category_status"),
    )


def read_countries(spark: SparkSession, path: str, bad_rows: int = 0) -> DataFrame:
    """The published country list; its audit columns are not used."""
    return read_dim(spark, path, COUNTRY_FILE, "^", bad_rows).select("CTRY_CD", "CTRY_DESC")

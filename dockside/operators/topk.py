"""Rankings, and first values made deterministic."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def top_n(df: DataFrame, n: int, by: str, partition: Sequence[str]) -> DataFrame:
    """The ``n`` best rows of each group with ties kept; a null measure never ranks.

    The rank limit is planned below the shuffle as well, so each task sends on at
    most its own best rows of a group, however large the group is.
    """
    ranked = Window.partitionBy(*partition).orderBy(F.col(by).desc())
    return (
        df.where(F.col(by).isNotNull())
        .withColumn("__rank", F.rank().over(ranked))
        .where(F.col("__rank") <= n)
        .drop("__rank")
    )


def top_k(df: DataFrame, k: int, by: str, tie: Sequence[str]) -> DataFrame:
    """The ``k`` best rows overall; equal measures are ordered by the tie columns."""
    return df.orderBy(
        F.col(by).desc_nulls_last(), *(F.col(t).asc_nulls_last() for t in tie)
    ).limit(k)


def first_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)


def snapshot_date(df: DataFrame) -> Column:
    """The extract date of a fact as a scalar subquery."""
    return df.agg(F.max("Data_Pulled")).scalar()


def read_snapshot_date(df: DataFrame) -> date:
    """The extract date as one driver-side value, for runs with many reports."""
    return df.agg(F.max("Data_Pulled")).first()[0]

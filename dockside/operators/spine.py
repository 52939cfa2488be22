"""Domain spines: reports that show every listed row, measured or not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from .joins import combine


def sql_text(value: str) -> str:
    """A string as an SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def domain_frame(spark: SparkSession, values: Sequence[str], name: str) -> DataFrame:
    """A literal list as rows of (ordinal, name)."""
    rows = ", ".join(f"({i}, {sql_text(v)})" for i, v in enumerate(values))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(ordinal, {name})")


def on_spine(agg: DataFrame, domain: DataFrame, key: str) -> DataFrame:
    """Keep every domain row, with null measures where the aggregate has none."""
    return combine(domain, agg, {key: key})


def month_vs_ytd(month: DataFrame, ytd: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Year-to-date rows with the month's measures beside them; null keys match."""
    joined = combine(ytd, month, {k: k for k in keys})
    own = [c for c in month.columns if c not in keys]
    rest = [c for c in ytd.columns if c not in keys]
    return joined.select(*keys, *own, *rest)

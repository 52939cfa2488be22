"""Row and column shaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import pct_text_of, percent_digits


def relabel(col: str, groups: Mapping[str, tuple[str, ...]]) -> Column:
    """Many-to-one relabelling ``{new: (old, ...)}``; an unlisted value becomes null."""
    (first, old), *rest = groups.items()
    out = F.when(F.col(col).isin(*old), first)
    for new, old in rest:
        out = out.when(F.col(col).isin(*old), new)
    return out


def nulls_to_text(df: DataFrame, token: str = "-", decimals: int = 6) -> DataFrame:
    """Every column as text, with nulls (and NaN) replaced by ``token``.

    Fractional numbers get a fixed count of decimals, so the text does not depend
    on the magnitude of the value.
    """

    def text(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            value = F.when(~F.isnan(value), value).cast(T.DecimalType(28, decimals))
        return F.coalesce(value.cast("string"), F.lit(token)).alias(field.name)

    return df.select(*(text(f) for f in df.schema.fields))


def percent_texts(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add shares as text ``{share: text}``, each column with the digits it asks for.

    The digits are a scalar subquery over the table; where that is an aggregate of a fact, the
    subquery reads the aggregate's exchange again, not the fact.
    """
    return df.withColumns(
        {
            text: pct_text_of(F.col(share), df.agg(percent_digits(share)).scalar())
            for share, text in columns.items()
        }
    )


def stack(*blocks: DataFrame) -> DataFrame:
    """Union by column name, duplicates kept."""
    return reduce(DataFrame.unionByName, blocks)


def beside(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two one-row results as one row with the columns of both."""
    both = left.unionByName(right, allowMissingColumns=True)
    return both.agg(*(F.first(c, ignorenulls=True).alias(c) for c in both.columns))


def domain_of(df: DataFrame, col: str) -> DataFrame:
    """The distinct values of a column, in order, without null."""
    return df.where(F.col(col).isNotNull()).select(col).distinct().orderBy(col)


def nth_level(df: DataFrame, col: str, n: int) -> DataFrame:
    """The n-th (from one) distinct value of a column."""
    return domain_of(df, col).offset(n - 1).limit(1)


def peek(df: DataFrame, keys: Sequence[str], n: int = 10, seed: int = 0) -> DataFrame:
    """A sample of ``n`` rows for inspection, in the order of seeded digests of the keys.

    The same seed gives the same rows however the table is partitioned.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys)))
    return df.orderBy(digest, *(F.col(k).asc_nulls_last() for k in keys)).limit(n)

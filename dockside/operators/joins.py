"""Equi-joins with null keys matching null keys.

No side carries a broadcast hint.  Dimensions read from files, and top-k lists,
have known sizes, so the planner broadcasts them below
``spark.sql.autoBroadcastJoinThreshold`` and sorts and merges above it; adaptive
execution makes the same choice from measured sizes and splits skewed keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keyed(right: DataFrame, on: Mapping[str, str]) -> tuple[DataFrame, Column, list[str]]:
    """Rename the right keys out of the way and build the null-safe condition."""
    names = {r: f"__key_{i}" for i, r in enumerate(on.values())}
    right = right.withColumnsRenamed(names)
    cond = reduce(
        Column.__and__, (F.col(left).eqNullSafe(F.col(names[r])) for left, r in on.items())
    )
    return right, cond, list(names.values())


def _join(left: DataFrame, right: DataFrame, on: Mapping[str, str], how: str) -> DataFrame:
    right, cond, keys = _keyed(right, on)
    return left.join(right, cond, how).drop(*keys)


def enrich(df: DataFrame, dim: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Left join of a dimension; ``on`` maps fact keys to dimension keys."""
    return _join(df, dim, on, "left")


def restrict(
    df: DataFrame, dim: DataFrame, on: Mapping[str, str], dedupe: bool = False
) -> DataFrame:
    """Keep the rows whose keys are listed.

    A key listed twice repeats its rows, as an inner join does; ``dedupe`` keeps
    each row once.
    """
    if dedupe:
        return _join(df, dim.select(*on.values()), on, "left_semi")
    return _join(df, dim, on, "inner")


def combine(
    shipped: DataFrame, stocked: DataFrame, on: Mapping[str, str], how: str = "left"
) -> DataFrame:
    """Put stocked-side measures next to shipped-side measures of the same keys."""
    return _join(shipped, stocked, on, how)


def on_rules(df: DataFrame, rules: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Rows under a small rule table, plus the rules that no row falls under.

    An outer join that keeps the small side would shuffle the large side by rule, and
    a third of it may fall under one rule.  Here the rules are matched in place, and
    unused ones are found from one count per rule.  The count names ``measure``, so
    that it reads the same aggregate as the match and the fact is read once.
    """
    on = {k: k for k in keys}
    matched = restrict(df, rules, on)
    # The filter always holds; it keeps the count from being pruned away.
    used = df.groupBy(*keys).agg(F.count(measure).alias("__n")).where("__n >= 0").drop("__n")
    names = {k: f"__key_{i}" for i, k in enumerate(keys)}
    used = used.withColumnsRenamed(names)
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()))
    unused = rules.join(used, same, "left_anti")
    return matched.unionByName(unused, allowMissingColumns=True)

"""Exact five-number summaries and box plots without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .joins import combine

POINTS = {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "high": 1.0}


def value_counts(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """How often each value occurs in each group, as ``n``; missing values are left out."""
    return df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count("*").alias("n"))


def five_numbers(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Minimum, quartiles and maximum per group, interpolating between neighbours."""
    return five_of_counts(value_counts(df, keys, col), keys, col)


def five_of_counts(counts: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """The same from :func:`value_counts`.

    1. Rows have collapsed to (keys, value, copies) before any shuffle.
    2. Values are cut into slices of about one percent of their size, in value order.
       Slice totals give the rank at which every slice starts; that window sees one
       row per slice, which the range of the numbers bounds, not the count of rows.
    3. Running counts are needed only inside the few slices that hold a wanted rank.
       The others are dropped unsorted, so a group with a third of all rows does not
       end up in one task.
    """
    on = {k: k for k in (*keys, "slice")}
    size = F.expr(f"CAST(floor(signum({col}) * log1p(abs({col})) * 128) AS INT)")
    counts = counts.withColumn("slice", size)
    group = Window.partitionBy(*keys)
    starts = (
        counts.groupBy(*keys, "slice")
        .agg(F.sum("n").alias("size"))
        .select(
            *keys,
            "slice",
            "size",
            (F.sum("size").over(group.orderBy("slice")) - F.col("size")).alias("start"),
            F.sum("size").over(group).alias("rows"),
        )
        .where(_holds_rank("start", "size"))
        .drop("size")
    )
    # Position of each distinct value: it covers ranks [first, first + n).
    inside = Window.partitionBy(*keys, "slice").orderBy(col)
    running = F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    placed = (
        combine(counts, starts, on, "inner")
        .withColumn("first", F.col("start") + running - F.col("n"))
        .where(_holds_rank("first", "n"))
    )
    picks = []
    for name, p in POINTS.items():
        for side, rank in zip(("below", "above"), _ranks(p), strict=True):
            held = f"first <= {rank} AND {rank} < first + n"
            picks.append(F.expr(f"max({col}) FILTER (WHERE {held})").alias(f"{name}_{side}"))
    out = placed.groupBy(*keys, "rows").agg(*picks)

    def point(name: str, p: float) -> Column:
        part = f"((rows - 1) * {p}D - floor((rows - 1) * {p}D))"
        return F.expr(f"{name}_below + {part} * ({name}_above - {name}_below)").alias(name)

    return out.select(*keys, "rows", *(point(n, p) for n, p in POINTS.items()))


def box_plots(
    counts: DataFrame, keys: Sequence[str], col: str, reach: float = 1.5
) -> tuple[DataFrame, DataFrame]:
    """Box-plot statistics per group, and the outliers, from :func:`value_counts`.

    The fences lie ``reach`` box lengths outside the quartiles.  Whiskers end at the outermost
    values within the fences, but never inside the box; what lies outside is an outlier.  Both
    tables come from the same value counts, so a group of any size is counted once, and the
    one row of a group meets its counts, not its rows.

    The first table holds the keys, ``rows, low_whisker, q1, median, q3, high_whisker,
    low_fence, high_fence, outliers`` (their number of rows); the second holds the keys, each
    outlying value and its ``n``.  A group without a value is in neither.
    """
    five = five_of_counts(counts, keys, col)
    fences = five.withColumns(
        {
            "low_fence": F.expr(f"q1 - {reach}D * (q3 - q1)"),
            "high_fence": F.expr(f"q3 + {reach}D * (q3 - q1)"),
        }
    ).drop("low", "high")
    within = f"{col} >= low_fence AND {col} <= high_fence"
    box = ("rows", "q1", "median", "q3", "low_fence", "high_fence")
    placed = combine(counts, fences, {k: k for k in keys}, "inner")
    boxes = placed.groupBy(*keys, *box).agg(
        F.expr(f"min({col}) FILTER (WHERE {within})").alias("__low"),
        F.expr(f"max({col}) FILTER (WHERE {within})").alias("__high"),
        F.expr(f"coalesce(sum(n) FILTER (WHERE NOT ({within})), 0)").alias("outliers"),
    )
    boxes = boxes.select(
        *keys,
        "rows",
        F.least("__low", "q1").alias("low_whisker"),
        "q1",
        "median",
        "q3",
        F.greatest("__high", "q3").alias("high_whisker"),
        "low_fence",
        "high_fence",
        "outliers",
    )
    return boxes, placed.where(f"NOT ({within})").select(*keys, col, "n")


def _ranks(p: float) -> tuple[str, str]:
    """The two neighbouring zero-based ranks around quantile ``p``."""
    return f"floor((rows - 1) * {p}D)", f"ceil((rows - 1) * {p}D)"


def _holds_rank(start: str, size: str) -> Column:
    """Whether ranks [start, start + size) include one that a quantile needs."""
    wanted = (rank for p in POINTS.values() for rank in _ranks(p))
    return F.expr(" OR ".join(f"({start} <= {r} AND {r} < {start} + {size})" for r in wanted))

"""Cuts of a column into ranges of equal size, for reads that run range by range.

A range read needs boundaries that nobody knows by heart, least of all for text ids.  They
come from a table that holds the column already, such as the last snapshot of the same view.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .facts import JdbcSource

#: Slices counted for each range; a cut is off by half a slice at most.
SLICES = 32


def equal_cuts(df: DataFrame, column: str, parts: int) -> list:
    """Ascending boundaries that cut ``column`` into at most ``parts`` ranges of about equal size.

    Values are dealt into many slices in value order, and only each slice's size and first value
    come back: ``parts * SLICES`` rows, whatever the table holds.  A value of which there is
    more than a range holds cannot be cut: it is dealt over several slices, which share their
    first value, and gets one boundary.  Missing values belong to the first range.  Text is
    compared byte by byte; the database has to compare the column the same way.
    """
    if parts < 2:
        return []
    spread = F.xxhash64(F.monotonically_increasing_id())
    slices = (
        df.select(F.col(column).alias("value"), spread.alias("spread"))
        .repartitionByRange(parts * SLICES, "value", "spread")
        .groupBy(F.spark_partition_id().alias("slice"))
        .agg(F.count("*").alias("n"), F.min("value").alias("first"))
        .orderBy("slice")
        .collect()
    )
    total = sum(s["n"] for s in slices)
    cuts, before, wanted = [], 0, 1
    for s, following in zip(slices, slices[1:], strict=False):
        before += s["n"]
        # The slice boundary that lies nearest to each wanted rank.
        nearest = before + following["n"] / 2
        if wanted < parts and nearest > wanted * total / parts:
            while wanted < parts and nearest > wanted * total / parts:
                wanted += 1
            first = following["first"]
            if first is not None and first != slices[0]["first"] and first not in cuts[-1:]:
                cuts.append(first)
    return cuts


def with_cuts(source: JdbcSource, snapshot: DataFrame, parts: int) -> JdbcSource:
    """The same database view, read over ranges that an earlier snapshot shows to be equal.

    Lines that have come since fall into the same ranges, and the outer two are open.  A
    snapshot with too few values for two ranges leaves one task.
    """
    cuts = tuple(equal_cuts(snapshot, source.column, parts))
    return replace(source, cuts=cuts, single_task=not cuts)

"""Exact deduplication: a tree merge of digest runs.

Every row gives one entry (digest of the normalised text, its check values, identifier).
The entries are dealt into runs.  In each round groups of ``fan_in`` runs exchange their
entries and are merged into one: of equal digests only the smallest identifier and the
count go up.  An entry counts as equal only when length and a second checksum agree too,
so an identifier that wins is verified at every level.  The last round leaves one run, in
as many digest ranges as there are tasks.  The way down is the same tree: the root tells
the first level, and the first level tells the rows, so that a text which holds a third
of all rows is looked up as one entry a run, never as one hot key.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import Workspace, take_rows

CONTENT = ("digest", "size", "check")


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _content(text: Column) -> dict[str, Column]:
    return {
        "digest": F.unhex(F.sha2(text, 256)),
        "size": F.octet_length(text).cast("long"),
        "check": F.xxhash64(text),
    }


def entries(docs: DataFrame, workspace: Workspace, runs: int) -> DataFrame:
    """One staged entry a row: ``doc_id, row, run`` and the content columns."""
    content = _content(F.col("_text"))
    return workspace.stage(
        docs.select("doc_id", normalised(F.col("text")).alias("_text"))
        .select("doc_id", F.monotonically_increasing_id().alias("row"), *(c.alias(n) for n, c in content.items()))
        .withColumn("run", F.pmod(F.xxhash64("row"), F.lit(runs))),
        "entries",
    )


def _first() -> Column:
    """The smallest identifier: doc_id with nulls last, then the place of the row."""
    return F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "row"))


def exact_groups(
    docs: DataFrame, workspace: Workspace | None = None, fan_in: int = 16, rounds: int = 3
) -> DataFrame:
    """Groups of equal texts, one row a document.

    Takes ``doc_id`` and ``text``; other columns are ignored.  Null texts count as empty.
    Of equal texts the smallest doc_id stays; a null doc_id stays only if its group has no
    other, and of repeated rows exactly one is kept.  No rows give no rows.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``.
    """
    workspace = workspace or Workspace(docs.sparkSession, "exact")
    rows = entries(docs, workspace, fan_in**rounds)
    level = rows.groupBy("run", *CONTENT).agg(_first().alias("first"), F.count("*").alias("n"))
    ground = level
    for _ in range(rounds):
        level = (
            level.withColumn("run", F.floor(F.col("run") / fan_in))
            .groupBy("run", *CONTENT)
            .agg(F.min("first").alias("first"), F.sum("n").alias("n"))
        )
    root = level.drop("run")
    told = ground.select("run", *CONTENT).join(root, list(CONTENT))
    return rows.join(told, ["run", *CONTENT]).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, workspace: Workspace | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    workspace = workspace or Workspace(docs.sparkSession, "exact")
    groups = workspace.stage(exact_groups(docs, workspace), "groups")
    keep = groups.select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_digest"), "kept")
    return take_rows(docs, keep, F.sha2(normalised(F.col("text")), 256))

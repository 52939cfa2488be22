"""The corpus pipeline: stages that each take the documents their predecessor kept.

Documents without a recognised language go, then copies, near-copies and documents with
passages of the benchmark; the rest is packed into token sequences.  All columns of
``documents`` are carried until the last stage, which returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dockside.llm import decontam, exact, langid, near, packing
from dockside.llm.base import Workspace, fold, passing_workspaces
from dockside.llm.queries import tokenizer_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a recognised language stay; the network's cuts come from all labelled rows.

    Null texts and texts without a letter have no language and go; so does every row if no row
    has a label.  Repeated rows are judged alike, no rows give none, and all columns are carried.
    """
    net = langid.fit(docs.where(fold(5) != 0).select("doc_id", "text", "lang"))
    return langid.keep_identified(docs, net, net.least if net else 0.0)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays: that of the smallest doc_id.

    Null counts as empty, and empty texts are equal.  Of repeated rows one stays.  A null doc_id
    comes last.  No rows give none; all columns are carried.
    """
    return exact.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates stays: that of the smallest doc_id.

    Texts without any word, null ones too, are alone in their class.  Of repeated rows one stays.
    No rows give none; all columns are carried.
    """
    return near.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a window of the benchmark stay, repeated ones each.

    A text without words has no window; an empty benchmark removes nothing.  No rows give none; all
    columns are carried.
    """
    return decontam.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 2048 tokens.

    A null or empty text is one piece with its end mark alone; repeated rows are packed each.  No
    rows give no pieces.  Other columns are left behind.
    """
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language", identify_language),
    ("exact", drop_exact_copies),
    ("near", drop_near_copies),
    ("decontamination", decontaminate),
    ("packing", pack_sequences),
]

#: Two stages are models or iterative; ``tests/llm/test_pipeline.py`` compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between two stages the rows are written and read back.

    What a stage wrote for itself goes when its rows are written, and those rows go when the
    next stage has written its own.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    last = None
    for name, stage in STAGES[:-1]:
        workspace = Workspace(spark, f"pipeline-{name}")
        with passing_workspaces():
            docs = workspace.stage(stage(spark, docs, sf_dir), "rows")
        if last:
            last.close()
        last = workspace
    return STAGES[-1][1](spark, docs, sf_dir)

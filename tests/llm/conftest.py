import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def awkward(spark):
    """Null ids and texts, empty and very long texts, repeated rows, clashing extra columns."""
    long = "lorem ipsum dolor sit amet " * 8000
    rows = [
        (1, "a b  c"), (2, "a b c"), (2, "a b c"), (2, "a b c"), (3, "a\tb\nc"), (None, "a b c"),
        (None, None), (4, None), (5, ""), (6, "   "), (7, "　x"), (8, long), (9, long), (10, "1.2.3.4"),
        (11, "Ünïcode 'tis 'ś"), (12, "\U0001f600 \U0001f600"), (13, "word"), (13, "other word"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    names = ("row", "run", "digest", "size", "shard", "slot", "length", "kind", "_text", "n")
    return docs.select("*", *(F.lit(f"x{i}").alias(c) for i, c in enumerate(names)))


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.where("false")

"""One query for each operator: it applies the operator to its whole table and derives
the result columns of the check runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, exact, langid, licenses, near, negatives, packing, pii, quality, sharding, suffix, toxicity, trie
from .base import fold

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    """The vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, d: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet").select(*columns)


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "documents", "doc_id", "text")


@query
def op1_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Groups of texts that are equal up to white space."""
    return exact.exact_groups(_texts(spark, d))


@query
def op2_quality(spark: SparkSession, d: str) -> DataFrame:
    """Quality of every text, learned from the rows outside the held-out fold."""
    docs, learn = _texts(spark, d), fold(4) != 2
    model = quality.fit(docs.where(learn), _table(spark, d, "labels", "doc_id", "quality").where(learn))
    return quality.score(docs, model).select(
        "doc_id", (fold(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query
def op3_decontamination(spark: SparkSession, d: str) -> DataFrame:
    """Words of each document that lie in a ten-word window of the benchmark."""
    found = decontam.contamination(_texts(spark, d), _table(spark, d, "benchmark", "item_id", "text"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "longest_match",
        F.array_join(
            F.transform("spans", lambda m: F.concat_ws(":", m["start"], m["length"], m["item"], m["item_start"])), ","
        ).alias("spans"),
    )


@query
def op4_packing(spark: SparkSession, d: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(_texts(spark, d), tokenizer_path())


@query
def op5_suffix_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Bytes in 100-byte strings that also start earlier, removed from every text."""
    found = suffix.remove_repeats(_texts(spark, d))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op6_toxicity(spark: SparkSession, d: str) -> DataFrame:
    """Expected severity of every text, learned from the rows outside the held-out fold."""
    docs, learn = _texts(spark, d), fold(4) != 2
    model = toxicity.fit(docs.where(learn), _table(spark, d, "labels", "doc_id", "toxic").where(learn))
    return toxicity.severity(docs, model).withColumn("held_out", fold(4) == 2)


@query
def op7_pii(spark: SparkSession, d: str) -> DataFrame:
    """Personal data in every text: the rules' finds, and all with those from contexts."""
    found = pii.detect(_texts(spark, d))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    counts = (count(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS))
    return found.select("doc_id", *counts, F.sha2("base_text", 256).alias("base_sha256"), "spans")


@query
def op8_sharding(spark: SparkSession, d: str) -> DataFrame:
    """Whole records in 16 shuffled shards, and where each would be with 17."""
    shards = sharding.shuffle_shards(_texts(spark, d))
    text = F.coalesce("doc.text", F.lit(""))
    return shards.select(
        "doc.doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )


@query
def op9_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Class of near-duplicates of every document."""
    return near.near_classes(_texts(spark, d)).drop("text_hash")


@query
def op10_language_id(spark: SparkSession, d: str) -> DataFrame:
    """Language of every text, learned from the rows outside the held-out fold."""
    docs = _table(spark, d, "documents", "doc_id", "text", "lang")
    net = langid.fit(docs.where(fold(5) != 0).select("doc_id", "text", "lang"), cuts=False)
    found = langid.identify(docs, net)
    return found.select("doc_id", (fold(5) == 0).alias("held_out"), "lang_pred", "score")


@query
def op12_hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    """Hard negatives of every fiftieth vector; the label of every seventh is moved on by one."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = _table(spark, d, "embeddings", "vec_id", "label", "embedding").withColumn("label", moved)
    return negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


@query
def op13_prefix_trie(spark: SparkSession, d: str) -> DataFrame:
    """Prefix trie of all conversations, rebuilt so that each family of five shares its heads."""
    turns = trie.sequences(_table(spark, d, "conversations", "conv_id", "turn", "role", "text"))
    conv = F.col("conv_id")
    head = F.crc32(conv.cast("string").cast("binary")) % 9
    return trie.prefix_trie(trie.with_shared_heads(turns, conv - conv % 5, head, 8))


@query
def op11_license_scan(spark: SparkSession, d: str) -> DataFrame:
    """License labels of every text, and the places of the base phrases."""
    return licenses.scan(_texts(spark, d)).select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base").alias("first_word"),
        F.array_max("base").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )

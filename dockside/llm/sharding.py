"""Sharding: a two-pass external shuffle.

Pass one scatters whole records into buckets by seeded hashes.  A record's shard is fixed
by its doc_id and the number of shards (a jump hash: one more shard takes records only
into itself); within the shard, a second hash deals records evenly over buckets of about
``bucket_bytes``.  Pass two puts each bucket through a Fisher-Yates shuffle and writes it
to the shared folder.  A record's slot is its bucket's offset, from the counts of the
buckets before it, plus its place in the bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import Workspace, mix

SHARDS = 16
BUCKET_BYTES = 8 << 20
#: Up to so many buckets (about 30 bytes each) their offsets go out whole.
BROADCAST_BUCKETS = 200_000


def jump_shard(key: Column, shards: int) -> Column:
    """Shard of a key as nested choices: at each count ``n`` the key moves to the new shard
    ``n - 1`` when its hash for that count falls in the first n-th part, else it stays."""
    shard = F.lit(0)
    for n in range(2, shards + 1):
        draw = F.shiftrightunsigned(F.xxhash64(key, F.lit(n)), 33)
        shard = F.when(draw < F.lit((1 << 31) // n), F.lit(n - 1)).otherwise(shard)
    return shard.cast("int")


def _fisher_yates(seed: int):
    def shuffle(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        # The places in the input split make the outcome independent of arrival order.
        order = np.argsort(table.column("_row").to_numpy(), kind="stable")
        state = mix(np.array([seed, key[0].as_py(), key[1].as_py()], np.uint64))
        np.random.default_rng(state).shuffle(order)
        table = table.take(pa.array(order)).append_column("_place", pa.array(np.arange(len(order))))
        yield from table.to_batches()

    return shuffle


def shuffle_shards(
    docs: DataFrame,
    workspace: Workspace | None = None,
    shards: int = SHARDS,
    bucket_bytes: int = BUCKET_BYTES,
    seed: int = 7,
) -> DataFrame:
    """All records of ``docs``, a table at rest, in shuffled shards.

    Returns the written table: the columns of ``docs`` in a struct ``doc``, so that no name
    clashes, with ``shard``, ``slot`` (gapless from 0 in each shard) and ``grown_shard`` (with
    one more shard).  A null doc_id is a key like any other; repeated rows are all kept, in
    different buckets; no rows give no rows.
    """
    workspace = workspace or Workspace(docs.sparkSession, "shards")
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    buckets = max(1, -(-size // (bucket_bytes * shards)))
    spread = F.xxhash64(F.lit(seed), F.monotonically_increasing_id())
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"),
        F.monotonically_increasing_id().alias("_row"),
        jump_shard(F.col("doc_id"), shards).alias("shard"),
        jump_shard(F.col("doc_id"), shards + 1).alias("grown_shard"),
        F.pmod(spread, F.lit(buckets)).cast("int").alias("_bucket"),
    )
    schema = T.StructType([*rows.schema.fields, T.StructField("_place", T.LongType())])
    shuffled = workspace.stage(
        rows.groupBy("shard", "_bucket").applyInArrow(_fisher_yates(seed), schema), "buckets"
    )
    counts = shuffled.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
    before = W.partitionBy("shard").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        "shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    if shards * buckets <= BROADCAST_BUCKETS:
        offsets = F.broadcast(offsets)
    return shuffled.join(offsets, ["shard", "_bucket"]).select(
        "doc", "shard", (F.col("_before") + F.col("_place")).alias("slot"), "grown_shard"
    )

from collections import Counter, defaultdict

from pyspark.sql import functions as F

from dockside.llm import sharding
from dockside.llm.queries import op8_sharding


def test_every_row_once_and_slots_gapless(awkward):
    rows = sharding.shuffle_shards(awkward, bucket_bytes=1024).collect()
    assert Counter(tuple(r.doc) for r in rows) == Counter(map(tuple, awkward.collect()))
    slots, shards = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r.shard].append(r.slot)
        shards[r.doc.doc_id].add((r.shard, r.grown_shard))
        assert r.grown_shard in (r.shard, 16)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shards.values())


def test_empty_table(empty):
    assert sharding.shuffle_shards(empty).collect() == []


def test_query(spark, sf_dir, documents):
    rows = op8_sharding(spark, sf_dir)
    assert rows.count() == documents.count()
    moved = rows.where("shard <> grown_shard")
    assert moved.where("grown_shard <> 16").isEmpty()
    assert 0.03 < moved.count() / rows.count() < 0.09
    # The order within a shard is a shuffle: positions don't follow the ids.
    assert abs(rows.where("shard = 3").agg(F.corr("doc_id", "slot")).first()[0]) < 0.4


def test_same_seed_same_order(documents):
    rows = [
        sorted(sharding.shuffle_shards(documents, bucket_bytes=1 << 15).select("doc.doc_id", "shard", "slot").collect())
        for _ in range(2)
    ]
    assert rows[0] == rows[1]

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from dockside.llm import near
from dockside.llm.base import byte_column


def brute_classes(docs):
    """Components of all pairs at the threshold, by comparing all pairs that share a shingle."""
    sets, seen = [], Counter()
    for r in docs:
        _, _, hashes, count = near._sets(*byte_column(pa.array([r.text])))
        sets.append((hashes, count))
        seen.update(hashes.tolist())
    floor = max(1, sum(seen.values()) / near.FREQUENT)

    def weight(shingle, count):
        rare = math.log(len(docs) / min(max(seen[shingle], floor), len(docs))) / math.log(len(docs) / floor)
        return (1 + math.log(count)) * (1 + near.IDF_SHARE * rare)

    sets = [{x: weight(x, n) for x, n in zip(h.tolist(), c.tolist(), strict=True)} for h, c in sets]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for h in s:
            holders[h].append(i)
    part = list(range(len(docs)))

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    for i, s in enumerate(sets):
        shared = defaultdict(float)
        for h, w in s.items():
            for j in holders[h]:
                if j < i:
                    shared[j] += min(w, sets[j][h])
        for j, both in shared.items():
            if both >= (near.THRESHOLD - 1e-6) * (sum(s.values()) + sum(sets[j].values()) - both):
                part[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(docs)):
        groups[root(i)].append(docs[i].doc_id)
    return sorted(sorted(g) for g in groups.values())


def classes_of(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r.class_id].append(r.doc_id)
    return sorted(sorted(g) for g in groups.values())


def check_kept(rows):
    for r in rows:
        assert r.kept == (r.doc_id == r.class_id)


def test_given_documents_against_all_pairs(documents):
    rows = near.near_classes(documents).collect()
    assert classes_of(rows) == brute_classes(documents.collect())
    check_kept(rows)
    sizes = Counter(r.class_id for r in rows)
    assert all(r.class_size == sizes[r.class_id] for r in rows)


def test_weights_follow_shares_not_sizes(spark):
    """Ten times the same corpus, told apart by one word a document: the same weights."""
    rng = random.Random(1)
    boiler = " ".join(f"b{i}" for i in range(30))
    texts = [" ".join(f"w{rng.randrange(50)}" for _ in range(40)) + (f" {boiler}" if i % 3 == 0 else "") for i in range(300)]
    _, _, probe, count = near._sets(*byte_column(pa.array([texts[0]])))
    found = []
    for times in (1, 10):
        rows = [(i * times + k, t) for i, t in enumerate(texts) for k in range(times)]
        frequencies = near.document_frequencies(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
        # A floor of the same share, as in corpora of more than 65,536 pairs.
        frequencies.floor = frequencies.documents / 300
        found.append(frequencies.weights(probe, count))
    assert np.allclose(*found) and found[0].min() < 1.1 * count.min() and found[0].max() > 1.2


def test_frequent_shingles_are_counted_exactly(spark, documents, monkeypatch):
    seen = Counter()
    for r in documents.collect():
        seen.update(near._sets(*byte_column(pa.array([r.text])))[2].tolist())
    monkeypatch.setattr(near, "FREQUENT", 1 << 15)
    monkeypatch.setattr(near, "HELD", 1 << 10)
    got = near.document_frequencies(documents.repartition(5))
    assert got.floor == sum(seen.values()) / (1 << 15) > 1
    want = {h: n for h, n in seen.items() if n >= got.floor}
    assert dict(zip(got.hashes.tolist(), got.counts.tolist(), strict=True)) == want and len(want) > 10


def test_one_id_for_very_many_rows(spark):
    """Each row of a hot doc_id, and of a hot row, meets itself alone."""
    near_text = " ".join(f"w{i}" for i in range(100))
    rows = [(7, f"{near_text} z{i}") for i in range(150)] + [(7, near_text)] * 400 + [(8, f"{near_text} y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    signed = near.signatures(docs, frequencies := near.document_frequencies(docs))
    nodes = signed.groupBy("key").agg(F.min("at").alias("at"), F.min("text_hash").alias("text_hash"))
    assert near.weighted_sets(docs, nodes, frequencies).count() == nodes.count() == 152
    found = near.near_classes(docs).collect()
    assert len(found) == 551 and {(r.class_id, r.class_size) for r in found} == {(7, 551)} and sum(r.kept for r in found) == 1


def test_one_large_group_of_varied_copies(spark):
    """Copies with few and many edits: pivots alone don't link them all."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(400)}" for _ in range(160)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(rng.choice((0, 1, 2, 3, 4, 6, 9))):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(base[:12] + [f"y{i}_{k}" for k in range(60)])) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = near.near_classes(docs).collect()
    assert classes_of(found) == brute_classes(docs.collect())


def test_a_block_gives_fewer_links_than_members(spark):
    """Two groups of like members, some in one part already: a forest with the components of all links."""
    weights = np.ones(20, np.float32).tobytes()
    blobs = [np.arange(k, k + 20, dtype=np.uint64).tobytes() for k in (0, 100)]
    keys = [bytes([i]) for i in range(90)]
    sets = spark.createDataFrame(
        [(k, blobs[i % 2], weights) for i, k in enumerate(keys)], "key binary, hashes binary, weights binary"
    )
    part = {k: keys[i % 2] if i < 20 else k for i, k in enumerate(keys)}
    rows = [(0, side, k, part[k]) for i, k in enumerate(keys) for side in (True, False) if not side or i % 3]
    blocks = spark.createDataFrame(rows, "block long, is_left boolean, key binary, part binary")
    links = [(bytes(r.a), bytes(r.b)) for r in near.verified_links(blocks, sets).collect()]
    assert all(keys.index(a) % 2 == keys.index(b) % 2 for a, b in links)
    root = dict(part)
    for a, b in links:
        old, new = root[a], root[b]
        assert old != new  # no link that earlier ones make needless
        root = {k: new if r == old else r for k, r in root.items()}
    assert len(set(root.values())) == 2 and len(links) == len(set(part.values())) - 2


def test_awkward_rows(awkward, empty):
    rows = near.near_classes(awkward).collect()
    given = awkward.collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in given)
    same = [r for r in rows if r.class_id == 1]
    assert len(same) == 6 and {r.class_size for r in same} == {6} and sum(r.kept for r in same) == 1
    assert all(r.kept and r.class_size == 1 for r in rows if r.doc_id in (4, 5, 6))
    kept = near.keep_one(awkward)
    assert kept.columns == awkward.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(
        {1: 1, None: 1, 4: 1, 5: 1, 6: 1, 7: 1, 8: 1, 10: 1, 11: 1, 12: 1, 13: 2}
    )
    assert near.near_classes(empty).collect() == []


def test_samples_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(0)
    hashes = rng.integers(0, 1 << 52, 300, dtype=np.uint64)
    a, b = np.arange(0, 220), np.arange(40, 260)
    weights = rng.uniform(1, 3, 300).astype(np.float32)
    sampler = near.Sampler(samples=2000)
    draws = sampler.draw(np.concatenate([hashes[a], hashes[b]]), np.concatenate([weights[a], weights[b]]), np.array([0, 220]))
    true = weights[40:220].sum() / weights[:260].sum()
    assert abs((draws[:, 0] == draws[:, 1]).mean() - true) < 0.04

"""Prefix trie against brute force over tuples of turns."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockside.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def ordered(turns):
    out = defaultdict(list)
    for c, turn, role, text in turns:
        role, text = role or "", text or ""
        key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
        if c is not None:
            out[c].append(((turn is not None, turn or 0), role, key, text))
    return {c: [(r, t) for _, r, _, t in sorted(x)] for c, x in out.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        rest = int(np.fmod(c, 5))
        out[c] = convs.get(c - rest, [])[:h] + own[h:]
    return out


def brute(convs):
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in sorted(convs):
        seq = tuple(convs[c])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
            if d:
                children[seq[: d - 1]].add(seq[:d])
        ends[seq].append(c)
    rows, below = [], {}
    for p in sorted(members, key=len, reverse=True):
        kids = [below[k] for k in children[p]]
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        below[p] = (sum(k[0] for k in kids) or 1, own + sum(k[1] for k in kids))
        digest = hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()
        parent = members[p[:-1]][0] if p else None
        rows.append((members[p][0], len(p), parent, len(members[p]), len(kids), *below[p], digest))
    return sorted(rows, key=str)


def built(spark, turns, heads=False, **options):
    df = spark.createDataFrame(turns, SCHEMA).withColumns({c: F.lit("x") for c in ("digest", "key", "pid", "depth")})
    seqs = trie.sequences(df.repartition(5))
    if heads:
        conv = F.col("conv_id")
        seqs = trie.with_shared_heads(seqs, conv - conv % 5, F.crc32(conv.cast("string").cast("binary")) % 9, 8)
    return sorted(map(tuple, trie.prefix_trie(seqs, **options).collect()), key=str)


def random_turns(seed, n, width=2, longest=6):
    rng = random.Random(seed)
    texts = ["", "a", "bé", "ccc"][: width + 1]
    return [
        (c, t, rng.choice(["user", None]), rng.choice(texts)) for c in range(n) for t in range(rng.randint(1, longest))
    ]


SMALL = [{}, {"partitions": 7}, {"partitions": 9, "piece_rows": 2}, {"partitions": 2, "piece_rows": 5}]


@pytest.mark.parametrize("options", SMALL)
def test_against_brute_force(spark, options):
    turns = random_turns(1, 80)
    assert built(spark, turns, **options) == brute(ordered(turns))


@pytest.mark.parametrize("options", [{}, {"partitions": 6, "piece_rows": 3}])
def test_rebuilt_conversations(spark, options):
    turns = [t for t in random_turns(2, 90, longest=12) if t[0] % 7] + random_turns(3, 1)
    turns += [(-3, 0, "user", "a"), (-5, 1, None, None), (2**62, None, "user", "a")]
    convs = rebuilt(ordered(turns))
    assert any(not s for s in convs.values())  # one without turns
    assert built(spark, turns, heads=True, **options) == brute(convs)


@pytest.mark.parametrize("options", [{}, {"partitions": 8, "piece_rows": 11}])
def test_large_groups_of_copies_and_a_common_first_turn(spark, options):
    turns = [(c, t, "user", f"x{t}") for c in range(200) for t in range(3)]
    turns += [(1000 + c, t, "user", f"x{t}" if t < 2 else f"{c}") for c in range(100) for t in range(4)]
    assert built(spark, turns, **options) == brute(ordered(turns))


def test_nulls_ties_and_repeated_rows(spark):
    turns = [(1, None, "user", "a"), (1, 0, "user", "b"), (1, 0, "user", "b"), (1, 0, None, "c"), (None, 1, "user", "a")]
    turns += [(2, 5, "user", "a"), (2, 7, None, None), (3, 1, "user", "a"), (3, 1, "user", "z"), (3, 1, "bot", "z")]
    assert built(spark, turns) == brute(ordered(turns))


def test_one_very_long_conversation(spark):
    turns = [(c, t, "user", str(t)) for c, n in ((1, 3000), (2, 2000), (3, 2999)) for t in range(n)]
    assert built(spark, turns, piece_rows=2) == brute(ordered(turns))


def test_no_conversations(spark):
    assert built(spark, []) == [] == built(spark, [(None, 1, "user", "a")], heads=True)


def test_only_turnless(spark):
    seqs = spark.createDataFrame([(5, []), (3, [])], "conv_id long, turns array<struct<digest:string,size:long>>")
    ends = hashlib.sha256(b"3,5").hexdigest()
    assert list(map(tuple, trie.prefix_trie(seqs).collect())) == [(3, 0, None, 2, 0, 1, 0, ends)]


def test_range_minima():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 5, 70)
    table = trie.RangeMin(x)
    for i in range(70):
        for d in range(1, 5):
            left = i
            while left > 0 and x[left] >= d:
                left -= 1
            right = i
            while right < 69 and x[right + 1] >= d:
                right += 1
            assert table.extend_left(np.array([i]), np.array([d]))[0] == left
            assert table.extend_right(np.array([i]), np.array([d]))[0] == right

import random
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dockside.llm import suffix


def brute(docs, length=suffix.LENGTH):
    """Kept bytes of each text, in the order of ids with nulls last."""
    seen, out = set(), []
    for doc_id, text in sorted(docs, key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if raw[p : p + length] in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(raw[p : p + length])
        out.append((doc_id, len(raw), bytes(b for b, g in zip(raw, gone, strict=True) if not g)))
    return Counter(out)


def found(docs, **options):
    rows = suffix.remove_repeats(docs, **options).collect()
    for r in rows:
        assert sum(s.end - s.start for s in r.spans) == r.n_bytes - len(r.kept)
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:], strict=False))
    return Counter((r.doc_id, r.n_bytes, bytes(r.kept)) for r in rows)


@pytest.mark.parametrize("sizes", [(1 << 20, 1 << 20), (3000, 2000)])
def test_overlapping_passages_across_blocks(spark, sizes):
    rng = random.Random(4)
    pool = ["".join(rng.choice("abcdeé ") for _ in range(700)) for _ in range(6)]
    rows = []
    for i in range(60):
        text = ""
        for _ in range(rng.randrange(4)):
            source, at = rng.choice(pool), rng.randrange(600)
            text += source[at : at + rng.randrange(30, 350)] + rng.choice(["", "x", "a" * rng.choice((40, 130, 260))])
        rows.append((i, text))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(docs, block_bytes=sizes[0], bucket_bytes=sizes[1]) == brute(rows)


def test_periodic_text_and_one_common_line(spark):
    line = "All of this is a line of boilerplate that many documents share, word by word, until its very end, more than once. "
    rows = [(i, f"{i} unlike start {i * 7919}. " + line + f"and {i * i}") for i in range(300)]
    rows += [(1000, "ab" * 400), (1001, "z" * 99), (1002, "z" * 100), (1003, "z" * 101), (1004, line * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(docs, block_bytes=4000) == brute(rows)


@pytest.mark.parametrize("hot", [0, 3, 40])
def test_hot_anchors_are_dealt_by_window(spark, hot):
    """Common lines shorter and longer than a window, in different and in like surroundings."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(9))
    short, long = "A line of sixty bytes or so that very many different texts hold", " ".join(word() for _ in range(25))
    near = [" ".join(word() for _ in range(6)) for _ in range(4)]
    rows = []
    for i in range(150):
        ends = [rng.choice(near) if rng.random() < 0.3 else " ".join(word() for _ in range(6)) for _ in range(4)]
        rows.append((i, f"{ends[0]} {short} {ends[1]}" + (f" {ends[2]} {long} {ends[3]}" if i % 3 == 0 else "")))
    rows += [(500, None), (None, rows[3][1]), (501, rows[4][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for options in ({}, {"block_bytes": 3000, "bucket_bytes": 2000}):
        assert found(docs, hot=hot, **options) == brute(rows)


def test_a_common_line_in_very_many_texts_stays_small(spark, monkeypatch, tmp_path):
    """20,000 different texts around one line: no task compares more than a share of them."""
    line = "The same fifty byte line of boilerplate in each text"
    text = F.concat(F.sha2(F.col("id").cast("string"), 256), F.lit(line), F.sha2((F.col("id") + 10**6).cast("string"), 256))
    docs = spark.range(0, 20_000, 1, 8).select(F.col("id").alias("doc_id"), text.alias("text"))
    sizes = str(tmp_path / "sizes")
    construct = suffix._construct

    def measured(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        n = sum(len(suffix.unpack(v.as_py())[0]) for b in batches for v in b.column(2))
        with open(sizes, "a") as f:
            f.write(f"{n}\n")
        yield from construct(key, iter(batches))

    monkeypatch.setattr(suffix, "_construct", measured)
    # Several buckets, as one holds the fragments of many anchors.
    rows = suffix.remove_repeats(docs, hot=1000, bucket_bytes=1 << 18).agg(F.sum("n_bytes"), F.sum(F.size("spans"))).first()
    assert rows[0] == 20_000 * (128 + len(line)) and rows[1] == 0
    with open(sizes, "a+") as f:
        f.seek(0)
        assert max([0, *map(int, f)]) < 1000


def test_awkward_rows(awkward, empty):
    given = [(r.doc_id, r.text) for r in awkward.collect()]
    assert found(awkward) == brute(given)
    assert found(empty) == Counter()


def test_column_construction_against_plain_comparison():
    rng = np.random.default_rng(3)
    for _ in range(20):
        m, length = 40, 8
        n, left = rng.integers(1, 6, m), rng.integers(0, 5, m)
        left = np.minimum(left, n + length - 2)
        texts = [rng.integers(97, 99, k + length - 1).astype(np.uint8) for k in n]
        order = rng.permutation(m)
        marks = suffix.repeated_windows(np.concatenate(texts), n, left, order, length)
        windows = {}
        for i in range(m):
            for o in range(n[i]):
                windows.setdefault((o - left[i], texts[i][o : o + length].tobytes()), []).append((order[i], i, o))
        for group in windows.values():
            for rank, i, o in group:
                assert marks[i, o] == (rank > min(group)[0])


def test_pack_round_trip():
    arrays = [np.arange(5, dtype=np.uint64) << np.uint64(40), np.zeros(0, np.int64), np.array([True, False])]
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(arrays, suffix.unpack(suffix.pack(*arrays)), strict=True))

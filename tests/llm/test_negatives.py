"""Hard-negative mining against brute force over plain integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockside.llm import negatives as ng

SCHEMA = "vec_id long, label int, embedding array<double>"


def brute(rows, every, positives=5, negatives=3, window=(50, 95)):
    rows = [
        (i, lab, [math.floor(256 * x) for x in v])
        for i, lab, v in rows
        if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    first = lambda found, k: sorted(found, key=lambda f: (-f[0], f[1]))[:k]
    out = []
    for a, lab, v in rows:
        if a % every:
            continue
        for p, pid in first([(dot(v, w), i) for i, m, w in rows if m == lab and i != a], positives):
            close = [(dot(v, w), i) for i, m, w in rows if m != lab]
            close = [c for c in close if window[0] * p <= 100 * c[0] <= window[1] * p]
            out += [(a, pid, k + 1, n, p, s) for k, (s, n) in enumerate(first(close, negatives))]
    return sorted(out)


def mined(spark, rows, every, **options):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("row", "cell", "score", "id")})
    return sorted(map(tuple, ng.hard_negatives(df, F.col("vec_id") % every == 0, **options).collect()))


@pytest.mark.parametrize("shape", [(1, 1, 1), (33, 64, 70), (130, 257, 65), (100, 3, 40), (0, 5, 8), (5, 4, 0)])
def test_strassen_equals_plain_product(shape):
    rng = np.random.default_rng(3)
    m, k, n = shape
    a, b = rng.integers(-(2**27), 2**27, (m, k)), rng.integers(-(2**27), 2**27, (n, k))
    assert (ng.strassen(a, b, leaf=4) == a @ b.T).all()


def test_strassen_is_exact_where_sums_in_between_wrap():
    a = np.full((64, 64), 2**30)
    b = np.full((64, 64), 2**26 + 1)
    a[:, 1::2] *= -1
    b[0] = 0
    assert (ng.strassen(a * 4, b * 8, leaf=2) == (a * 4) @ (b * 8).T).all()


def test_against_brute_force_with_ties_and_small_tiles(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [
        (int(i), int(rng.integers(0, 3)), [float(x) for x in rng.integers(-2, 4, 5) / 4]) for i in rng.permutation(240)
    ]
    rows += [(7, 1, [0.5, float("nan")]), (8, None, [0.5]), (9, 1, None), (10, 2, [0.25, None]), (None, 1, [0.5])]
    rows += [(500, 0, [float("inf")] * 5), (501, 0, []), (502, 1, [0.5, 0.25]), (503, 1, [0.5] * 5)]
    assert mined(spark, rows, 10, stripes=3, band_rows=7) == brute(rows, 10) != []


def test_repeated_rows_count_each(spark):
    rows = [(0, 1, [1.0]), (2, 1, [1.0]), (2, 1, [1.0]), (3, 2, [0.7]), (3, 2, [0.7]), (4, 2, [0.6])]
    found = mined(spark, rows, 50, stripes=2)
    assert found == brute(rows, 50)
    assert [f[:4] for f in found] == [(0, 2, 1, 3)] * 2 + [(0, 2, 2, 3)] * 2 + [(0, 2, 3, 4)] * 2


def test_one_label_for_most_rows(spark):
    rows = [(i, 1 if i % 3 else i % 5 + 2, [math.cos(i), math.sin(i)]) for i in range(900)]
    assert mined(spark, rows, 50, stripes=4) == brute(rows, 50)


def test_no_rows_no_anchors_no_positives(spark):
    assert mined(spark, [], 50) == []
    assert mined(spark, [(1, 1, [1.0]), (2, 1, [1.0])], 50) == []
    assert mined(spark, [(50, 1, [1.0]), (2, 2, [1.0])], 50) == []


def test_scores_beyond_63_bits_end_the_run(spark):
    with pytest.raises(Exception, match="63 bits"):
        mined(spark, [(50, 1, [1e7] * 3), (2, 1, [1e7] * 3)], 50)
    with pytest.raises(Exception, match="64 bits"):
        mined(spark, [(50, 1, [1e300]), (2, 1, [1.0])], 50)

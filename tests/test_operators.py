"""Operators on small literal frames: nulls, ties, empty groups."""

import random
from datetime import date
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockside import catalog
from dockside import operators as ops
from dockside.functions import first_true, if_else_null, matching, not_matching, ratio


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def lines(spark):
    return spark.createDataFrame(
        [("OnTime", 10.0), ("Late", 5.0), (None, 7.0), ("Late", None)],
        "Lateness string, Units double",
    )


@pytest.mark.parametrize(
    ("nulls", "on_time", "late"),
    [("lenient", 10.0, 5.0), ("strict", None, None), ("subset", 10.0, None)],
)
def test_null_modes(lines, nulls, on_time, late):
    got = lines.agg(
        ops.cond_sum("Units", "Lateness = 'OnTime'", nulls),
        ops.cond_sum("Units", "Lateness = 'Late'", nulls),
    ).first()
    assert tuple(got) == (on_time, late)


def test_null_mode_is_checked():
    with pytest.raises(ValueError, match="null mode"):
        ops.cond_sum("Units", "true", "other")


def test_no_matching_row_sums_to_zero(lines):
    for nulls in ("lenient", "subset"):
        assert lines.agg(ops.cond_sum("Units", "Lateness = 'Lost'", nulls)).first()[0] == 0
    assert lines.where("false").agg(ops.plain_sum("Units")).first()[0] == 0


def test_plain_sum_is_null_with_a_null(lines):
    assert lines.agg(ops.plain_sum("Units")).first()[0] is None
    assert lines.where("Units > 0").agg(ops.plain_sum("Units")).first()[0] == 22.0


@pytest.mark.parametrize("parts", [1, 2, 8, 64])
def test_totals_do_not_depend_on_partitions(spark, parts):
    # 200,000 lines of fractional units whose exact total is a whole number.
    lines = spark.range(0, 200_000, 1, parts).select(
        F.expr("CASE WHEN id % 2 = 0 THEN 0.37 ELSE 0.63 END").alias("Units"), F.lit("Late").alias("Lateness")
    )
    base = lines.groupBy(F.spark_partition_id().alias("k")).agg(ops.plain_sum("Units", wide=True).alias("u"))
    for total in (
        lines.agg(ops.plain_sum("Units")), lines.agg(ops.cond_sum("Units", ops.LATE)),
        base.agg(ops.plain_sum("u", of="sums")),
    ):
        assert total.first()[0] == 100_000.0


@pytest.mark.parametrize("parts", [1, 8, 64])
def test_totals_beyond_64_bits_are_exact(spark, parts):
    # 100,000 lines: 10**16 unit-days and a quarter each; a double could not hold the last digits.
    lines = spark.range(0, 100_000, 1, parts).select(
        F.expr("25000000000 + 0.25D").alias("Units"), F.lit(4).alias("DAYS_LATE"), F.lit("Late").alias("Lateness"),
        F.lit("Ocean").alias("SHP_MODE_CATG_NM"),
    )
    once = lines.agg(*(c.alias(n) for n, c in ops.sot_sums().items()))
    base = ops.measures_by(lines.withColumn("k", F.spark_partition_id()), ("k",), ops.sot_sums())
    for sums in (once, ops.roll_up(base, (), ops.SOT_NAMES)):
        row = ops.finish(sums, ops.SOT_NAMES).first()
        assert row["WTSOTLateUnits"] == 10**16 + 100_000 and row["SOTUnits"] == 25 * 10**14 + 25_000
        assert row["PPAUnits"] == 0


def test_far_totals_and_their_end(spark):
    # One line of 10**20 units, and as much taken away again.
    lines = spark.sql("SELECT * FROM VALUES (1e20D), (-1e20D), (0.5D), (1e18D) AS t(Units)")
    assert lines.agg(ops.plain_sum("Units", wide=True)).first()[0] == Decimal(10**18) + Decimal('0.5')
    with pytest.raises(Exception, match="OVERFLOW"):
        spark.sql("SELECT CAST('Infinity' AS DOUBLE) AS Units").agg(ops.plain_sum("Units")).collect()


def test_nan_counts_as_missing(spark):
    lines = spark.sql("SELECT * FROM VALUES (1.5D, 'Late'), (CAST('NaN' AS DOUBLE), 'Late'), (2D, 'OnTime') AS t(Units, Lateness)")
    totals = lines.agg(
        ops.plain_sum("Units"), *(ops.cond_sum("Units", ops.LATE, m) for m in ("lenient", "strict", "subset")),
        ops.cond_sum("Units", ops.ON_TIME, "strict"),
    )
    assert tuple(totals.first()) == (None, 1.5, None, None, 2.0)


def test_kind_of_values_is_checked():
    with pytest.raises(ValueError, match="kind of values"):
        ops.plain_sum("Units", of="other")


def test_roll_up_keeps_the_null_of_a_part(spark):
    base = spark.createDataFrame([(1, 2.0), (1, None), (2, 3.0)], "k int, s double")
    assert rows(ops.roll_up(base, ("k",), ("s",))) == [(1, None), (2, 3.0)]


def test_weighted_units_count_rows_with_days(spark):
    df = spark.createDataFrame(
        [("Late", 2.0, 3, "Ocean"), ("Late", 4.0, 0, "Ocean"), ("OnTime", 9.0, 5, "Ocean")],
        "Lateness string, Units double, DAYS_LATE int, SHP_MODE_CATG_NM string",
    )
    assert df.agg(ops.sot_sums()["WTSOTLateUnits"]).first()[0] == 6.0


def test_floor_works_on_exact_units(spark):
    df = spark.sql("SELECT CAST(v AS DECIMAL(18, 4)) AS Units FROM VALUES (1.25), (1.5) AS t(v)")
    got = ops.finish(df.agg(ops.plain_sum("Units").alias("n")), ("n",))
    assert got.dtypes == [("n", "bigint")]
    assert got.first()[0] == 2


def test_zero_denominator_is_null(spark):
    df = spark.createDataFrame([("Unmeasured", 4.0)], "Lateness string, Units double")
    assert df.agg(ops.on_time_ratio()).first()[0] is None
    assert spark.range(1).select(ratio(F.lit(1.0), F.lit(0.0))).first()[0] is None


def test_patterns_ignore_case_and_keep_nulls(spark):
    df = spark.createDataFrame([("LIBERTY Distribution",), ("Dummy",), ("Ok",), (None,)], "v string")
    kept = df.where(not_matching("v", "liberty distribution", "dummy"))
    assert {r[0] for r in kept.collect()} == {"Ok", None}
    assert {r[0] for r in df.where(matching("v", "DUM")).collect()} == {"Dummy"}


def test_null_condition_gives_null(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "c boolean")
    assert rows(df.select(if_else_null(F.col("c"), "a", "b"))) == [("a",), ("b",), (None,)]


def test_first_true_skips_null_tests(spark):
    df = spark.createDataFrame([(None, True), (True, True), (None, None)], "a boolean, b boolean")
    label = first_true((F.col("a"), "A"), (F.col("b"), "B"), default="none")
    assert [r[0] for r in df.select(label).collect()] == ["B", "A", "none"]


def test_top_n_keeps_ties_and_drops_null(spark):
    values = [(v,) for v in (9, 9, 8, 8, 7, None)]
    df = spark.createDataFrame(values, "v int").withColumn("g", F.lit(1))
    assert [r[0] for r in rows(ops.top_n(df, 3, "v", ("g",)).select("v"))] == [8, 8, 9, 9]


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2), (None, 1)], "k string, v int")
    assert [r[0] for r in ops.top_k(df, 3, "v", ("k",)).collect()] == ["c", "a", "b"]


def test_null_keys_match_null_keys(spark):
    left = spark.createDataFrame([("A", None, 1), ("B", 2, 2)], "e string, m int, x int")
    right = spark.createDataFrame([("A", None, 10), ("B", 3, 20)], "e string, m int, y int")
    assert rows(ops.month_vs_ytd(right, left, ("e", "m"))) == [
        ("A", None, 10, 1),
        ("B", 2, None, 2),
    ]


def test_listing_a_key_twice_repeats_rows(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    dim = spark.createDataFrame([("a",), ("a",)], "name string")
    assert rows(ops.restrict(df, dim, {"k": "name"})) == [("a", 1), ("a", 1)]
    assert rows(ops.restrict(df, dim, {"k": "name"}, dedupe=True)) == [("a", 1)]


def test_rules_without_rows_stay(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("z", 3.0)], "k string, u double")
    rules = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, status int")
    assert rows(ops.on_rules(df, rules, ("k",), "u")) == [
        ("a", 1.0, 1),
        ("a", 2.0, 1),
        ("b", None, 2),
        (None, None, 3),
    ]


def test_spine_keeps_absent_entries(spark):
    domain = ops.domain_frame(spark, ("x", "it's", "back\\slash"), "k")
    agg = spark.createDataFrame([("it's", 5), ("other", 6)], "k string, v int")
    assert [tuple(r) for r in ops.on_spine(agg, domain, "k").orderBy("ordinal").collect()] == [
        (0, "x", None),
        (1, "it's", 5),
        (2, "back\\slash", None),
    ]


def test_relabel_drops_unlisted_values(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "v string")
    got = df.select(ops.relabel("v", {"AB": ("a", "b"), "D": ("d",)}))
    assert [r[0] for r in got.collect()] == ["AB", "AB", None, None]


def test_nulls_to_text(spark):
    df = spark.createDataFrame(
        [("a", 0.5, 1), (None, float("nan"), None)], "s string, d double, i int"
    )
    assert rows(ops.nulls_to_text(df)) == [("-", "-", "-"), ("a", "0.500000", "1")]


def test_beside_puts_two_rows_together(spark):
    left = spark.sql("SELECT 'x' AS a, CAST(NULL AS INT) AS b")
    right = spark.sql("SELECT 3 AS c")
    assert rows(ops.beside(left, right)) == [("x", None, 3)]


def test_nth_level(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "v string")
    assert ops.nth_level(df, "v", 2).first()[0] == "b"


def test_snapshot_date_is_the_latest(spark):
    df = spark.createDataFrame(
        [(date(2001, 1, 1), 1), (date(2001, 1, 2), 2)], "Data_Pulled date, v int"
    )
    assert rows(df.where(F.col("Data_Pulled") == ops.snapshot_date(df)).select("v")) == [(2,)]


@pytest.mark.parametrize("shape", ["one", "ties", "wide", "fractions", "negative"])
def test_five_numbers_are_exact(spark, shape):
    """Against brute force, with one group holding most rows."""
    rng = random.Random(shape)
    draw = {
        "one": lambda: 7.0,
        "ties": lambda: float(rng.randint(1, 5)),
        "wide": lambda: float(rng.randint(1, 10**9)),
        "fractions": lambda: rng.random(),
        "negative": lambda: rng.uniform(-50, 50),
    }[shape]
    data = [("hot", draw()) for _ in range(997)] + [("cold", draw()) for _ in range(3)]
    data += [("single", draw()), ("cold", None), (None, draw())]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r["k"]: tuple(r)[1:] for r in ops.five_numbers(df, ("k",), "v").collect()}
    for key in ("hot", "cold", "single", None):
        values = [v for k, v in data if k == key and v is not None]
        want = np.quantile(values, [0, 0.25, 0.5, 0.75, 1])
        assert got[key][0] == len(values)
        np.testing.assert_allclose(got[key][1:], want, rtol=1e-12)


def box(values, reach=1.5):
    """Box-plot statistics by numpy, and the outliers."""
    q1, median, q3 = np.quantile(values, (0.25, 0.5, 0.75))
    low, high = q1 - reach * (q3 - q1), q3 + reach * (q3 - q1)
    inside = [v for v in values if low <= v <= high]
    outside = sorted(v for v in values if not low <= v <= high)
    return (len(values), min([*inside, q1]), q1, median, q3, max([*inside, q3]), low, high, len(outside)), outside


def test_box_plots_against_numpy(spark):
    rng = random.Random(2)
    groups = {
        "even": [float(i) for i in range(50)],
        "tail": [rng.lognormvariate(0, 2) for _ in range(400)],
        "flat": [3.0] * 20 + [9.0, -1.0, -1.0],
        "one": [7.5],
        "two": [1.0, 100.0],
        # Both hinges are interpolated and no value lies between hinge and fence.
        "gap": [0.0, 10.0, 10.0, 10.0, 11.0, 11.0, 11.0, 40.0],
        None: [1.0, 2.0, 50.0, 2.0],
    }
    rows = [(k, v) for k, values in groups.items() for v in values] + [("even", None), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    boxes, outliers = ops.box_plots(ops.value_counts(df, ("k",), "v"), ("k",), "v")
    got = {r[0]: tuple(r)[1:] for r in boxes.collect()}
    assert set(got) == set(groups)
    for k, values in groups.items():
        want, outside = box(values)
        assert got[k] == pytest.approx(want)
        found = sorted(v for r in outliers.collect() if r.k == k for v in [r.v] * r.n)
        assert found == pytest.approx(outside)


def test_boxes_read_their_input_once(spark, sf_dir):
    from dockside.catalog import QUERIES

    df = QUERIES["r65_reason_box"](spark, sf_dir)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert plan.count("FileScan parquet") - plan.count("ReusedExchange") <= 4


@pytest.mark.parametrize(
    ("shares", "texts"),
    [
        ([0.85, 0.9149, 0.98], ["85.0%", "91.5%", "98.0%"]),
        ([0.85, 0.9, None], ["85%", "90%", None]),
        ([0.0, 0.5049, 1.0], ["0%", "50%", "100%"]),
        ([0.931, 0.9344], ["93.10%", "93.44%"]),
        ([0.93125, 0.93135], ["93.125%", "93.135%"]),
        ([0.935], ["93.5%"]),
        ([0.0], ["0%"]),
        ([0.0, 0.0], ["0%", "0%"]),
        ([0.0625], ["6.25%"]),
        ([12.34, 0.5], ["1,230%", "50%"]),
        ([float("nan"), 0.25], [None, "25%"]),
        ([None], [None]),
    ],
)
def test_percent_digits_of_a_column(spark, shares, texts):
    df = spark.createDataFrame(list(enumerate(shares)), "i int, share double")
    if any(s is not None and s != s for s in shares):
        df = df.withColumn("share", F.expr("nanvl(share, CAST(NULL AS DOUBLE))"))
    assert [r.text for r in ops.percent_texts(df, {"share": "text"}).orderBy("i").collect()] == texts


def test_large_totals_beyond_64_bits(spark, monkeypatch):
    """A measure whose total passes 64 bits becomes a wide decimal; the others stay bigint."""
    held = [(y, b, 10**18, "Late", 1, "Ocean") for y in (2000, 2001) for b in ("a", "b", "c") for _ in range(2)]
    given = spark.createDataFrame(
        [(y, b, float(u), *more) for y, b, u, *more in [*held, (2001, "a", 7, "OnTime", None, "PrepaidAir")]],
        "FISCAL_YEAR int, ReportingBrand string, Units double, Lateness string, DAYS_LATE int, SHP_MODE_CATG_NM string",
    )
    monkeypatch.setattr(catalog.fx, "sot_large", lambda *_: given)
    found = catalog.a05_large_totals(spark, "")
    kinds = dict(found.dtypes)
    assert {n for n, k in kinds.items() if k == "decimal(38,0)"} == {"SOTUnits", "SOTLateUnits", "WTSOTLateUnits"}
    assert set(kinds.values()) == {"int", "bigint", "decimal(38,0)"}
    got = {r.FISCAL_YEAR: (int(r.SOTUnits), int(r.WTSOTLateUnits), r.SOTOnTimeUnits) for r in found.collect()}
    six = 6 * 10**18
    assert got == {2000: (six, six, 0), 2001: (six + 7, six, 7), None: (2 * six + 7, 2 * six, 7)}
    small = ops.finish_wide(given.limit(0).selectExpr("CAST(Units AS DECIMAL(38,4)) AS Units"), ["Units"])
    assert small.dtypes == [("Units", "bigint")]

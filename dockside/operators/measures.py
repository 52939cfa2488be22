"""Conditional unit sums, and the measure sets built from them.

Every report reduces to sums of units under a condition.  The sums are kept raw, as exact
wide decimals, until :func:`finish`, so that they can be added up again: an aggregate at the
finest keys feeds all coarser levels without reading the fact twice.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ratio, whole

Sums = dict[str, Column]

SOT_NAMES = (
    "SOTUnits",
    "SOTOnTimeUnits",
    "SOTLateUnits",
    "SOTLate5daysUnits",
    "WTSOTLateUnits",
    "PPAUnits",
    "PPASOTLateUnits",
    "PPASOT5daysLateUnits",
    "WTPPASOTLateUnits",
)
OTS_NAMES = (
    "OTSUnits",
    "OTSOnTimeUnits",
    "OTSLateUnits",
    "OTSLate5daysUnits",
    "WTOTSLateUnits",
    "PPAOTSLateUnits",
    "PPAOTSUnits",
)
OTS_ORDER = ("on_time", "late", "late5", "weighted", "air_late", "air")


#: Type of a sum that is carried on: ten-thousandths with 34 digits before the point.
WIDE = "DECIMAL(38,4)"
_LIMB = 1 << 24


def _known(value: str) -> str:
    """A line's number as a double; NaN counts as missing."""
    return f"nanvl(CAST({value} AS DOUBLE), CAST(NULL AS DOUBLE))"


def wide_sum(value: str, cond: str | None = None) -> str:
    """SQL text of an exact sum over lines, as a wide decimal; zero on no rows.

    A line counts as whole ten-thousandths, cut into an upper and a lower limb that are added
    up apart as integers.  So the result does not depend on the order or the number of
    partitions, and totals go far beyond 64 bits: to 10**22 over 5 * 10**11 lines.  A total
    beyond that, or an infinite value, ends the run.
    """
    within = f" FILTER (WHERE {cond})" if cond else ""
    scaled = f"rint({_known(value)} * 10000)"
    upper = f"floor({scaled} / {_LIMB}D)"
    lower = f"CAST({scaled} - {upper} * {_LIMB}D AS BIGINT)"
    total = (
        f"CAST(coalesce(sum({upper}){within}, 0) AS DECIMAL(20,0)) * CAST({_LIMB} AS DECIMAL(8,0))"
        f" + CAST(coalesce(sum({lower}){within}, 0) AS DECIMAL(20,0))"
    )
    return f"CAST(({total}) * CAST(0.0001 AS DECIMAL(4,4)) AS {WIDE})"


def _sum_of_sums(value: str, cond: str | None = None) -> str:
    """SQL text of a sum over wide sums."""
    within = f" FILTER (WHERE {cond})" if cond else ""
    return f"CAST(coalesce(sum({value}){within}, 0) AS {WIDE})"


def _spoils(value: str, cond: str | None, nulls: str, of: str) -> str | None:
    """SQL text of what makes a sum null when it holds for one of its rows."""
    if of not in ("lines", "sums"):
        raise ValueError(f"unknown kind of values {of!r}")
    missing = f"{_known(value)} IS NULL" if of == "lines" else f"({value}) IS NULL"
    spoiled = {
        "lenient": None,
        "strict": f"({cond}) IS NULL OR (({cond}) AND {missing})" if cond else missing,
        "subset": f"coalesce({cond}, false) AND {missing}" if cond else missing,
    }
    if nulls not in spoiled:
        raise ValueError(f"unknown null mode {nulls!r}")
    return spoiled[nulls]


def _total(value: str, cond: str | None, of: str, wide: bool) -> str:
    total = wide_sum(value, cond) if of == "lines" else _sum_of_sums(value, cond)
    return total if wide else f"CAST({total} AS DOUBLE)"


def plain_sum(value: str, of: str = "lines", wide: bool = False) -> Column:
    """Sum that is null when any value is null, and zero on no rows.

    ``value`` is SQL text.  ``of`` says whether it is a number of each line or a wide sum of
    an earlier aggregate.  The result is a double to show, or ``wide`` to be added up further.
    """
    return guarded_sums({"sum": (value, None, "strict")}, of, wide)["sum"]


def cond_sum(
    value: str, cond: str, nulls: str = "lenient", of: str = "lines", wide: bool = False
) -> Column:
    """Sum of ``value`` over the rows where ``cond`` holds; zero when there is none.

    Both are SQL text.  ``lenient`` skips null conditions and null values.  ``strict``
    gives null if a condition, or a selected value, is null.  ``subset`` skips null
    conditions but gives null if a selected value is null.  NaN counts as null.
    """
    return guarded_sums({"sum": (value, cond, nulls)}, of, wide)["sum"]


def guarded_sums(
    sums: Mapping[str, tuple[str, str | None, str]], of: str = "lines", wide: bool = False
) -> Sums:
    """Several sums ``{name: (value, condition, null mode)}`` of one aggregate.

    Which of them a row makes null is one number, a bit for each; the aggregate keeps a single
    disjunction of it beside the sums, not a count for each sum.
    """
    bad = {n: _spoils(value, cond, nulls, of) for n, (value, cond, nulls) in sums.items()}
    bits = {n: 1 << k for k, n in enumerate(n for n, b in bad.items() if b)}
    mask = " + ".join(f"CASE WHEN {bad[n]} THEN {bit}L ELSE 0L END" for n, bit in bits.items())

    def one(name: str) -> Column:
        value, cond, _ = sums[name]
        total = _total(value, cond, of, wide)
        if name not in bits:
            return F.expr(total)
        return F.expr(f"CASE WHEN coalesce(bit_or({mask}), 0L) & {bits[name]}L = 0 THEN {total} END")

    return {name: one(name) for name in sums}


ON_TIME = "Lateness = 'OnTime'"
LATE = "Lateness = 'Late'"
MEASURED = f"({ON_TIME} OR {LATE})"
AIR = "SHP_MODE_CATG_NM = 'PrepaidAir'"


Spec = tuple[str, str | None, str]


def _late_measures(days: str, nulls: str, late5_nulls: str) -> dict[str, Spec]:
    # Unit-days are counted on late rows with at least one day, row by row.
    unit_days, delayed, deep = f"Units * {days}", f"{LATE} AND {days} >= 1", f"{LATE} AND {days} > 5"
    return {
        "on_time": ("Units", ON_TIME, nulls),
        "late": ("Units", LATE, nulls),
        "late5": ("Units", deep, late5_nulls),
        "weighted": (unit_days, delayed, nulls),
        "air": ("Units", AIR, nulls),
        "air_late": ("Units", f"{AIR} AND {LATE}", nulls),
        "air_late5": ("Units", f"{AIR} AND {deep}", nulls),
        "air_weighted": (unit_days, f"{AIR} AND {delayed}", nulls),
    }


_ALL_UNITS: Spec = ("Units", None, "strict")


def sot_sums(nulls: str = "strict", late5_nulls: str | None = None) -> Sums:
    """The nine shipped-side measures, raw."""
    m = _late_measures("DAYS_LATE", nulls, late5_nulls or nulls)
    return guarded_sums(dict(zip(SOT_NAMES, (_ALL_UNITS, *m.values()), strict=True)), wide=True)


def ots_sums(nulls: str = "strict", air_total: bool = True) -> Sums:
    """The seven stocked-side measures, raw; six without the prepaid-air total."""
    m = _late_measures("Days_Late", nulls, nulls)
    sums = dict(zip(OTS_NAMES, (_ALL_UNITS, *(m[k] for k in OTS_ORDER)), strict=True))
    if not air_total:
        del sums["PPAOTSUnits"]
    return guarded_sums(sums, wide=True)


def measures_by(df: DataFrame, keys: Sequence[str], sums: Sums) -> DataFrame:
    """One partial-then-final aggregate of the raw sums by explicit keys."""
    return df.groupBy(*keys).agg(*(c.alias(n) for n, c in sums.items()))


def sums_of_sums(names: Iterable[str]) -> list[Column]:
    """Raw sums added up, each under its name; a null part makes the total null."""
    sums = guarded_sums({n: (n, None, "strict") for n in names}, of="sums", wide=True)
    return [c.alias(n) for n, c in sums.items()]


def roll_up(base: DataFrame, keys: Sequence[str], names: Iterable[str]) -> DataFrame:
    """Add raw sums up to coarser keys; a null part makes the total null."""
    return base.groupBy(*keys).agg(*sums_of_sums(names))


def finish(df: DataFrame, names: Iterable[str], keep: Iterable[str] = ()) -> DataFrame:
    """Floor the raw sums to whole numbers; those in ``keep`` are shown as they are, as doubles."""
    kept = set(keep)
    return df.withColumns({n: F.col(n).cast("double") if n in kept else whole(n) for n in names})


def finish_wide(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Floor the raw sums to whole numbers, as bigint, or as DECIMAL(38,0) where a total passes 64 bits.

    Reads ``df`` to choose each column's type, so give it a written table.
    """
    names = list(names)
    fits = "coalesce(bool_and(floor({0}) BETWEEN -9223372036854775808 AND 9223372036854775807), true) AS {0}"
    narrow = df.selectExpr(*(fits.format(n) for n in names)).first()
    return df.withColumns({n: whole(n) if narrow[n] else F.floor(n).cast("decimal(38,0)") for n in names})


def on_time_ratio(nulls: str = "lenient", within: str = "true") -> Column:
    """On-time share of the measured (on-time plus late) units, as an aggregate."""
    return ratio(
        cond_sum("Units", f"{within} AND {ON_TIME}", nulls),
        cond_sum("Units", f"{within} AND {MEASURED}", nulls),
    )


def impact_sums(within: str = "true") -> Sums:
    """Raw numerators and the shared denominator of the impact shares."""
    vendor = "probable_failure = 'Vendor'"
    conditions = {
        "on_time": (ON_TIME, "lenient"),
        "transport": ("probable_failure = 'Transportation'", "subset"),
        "vendor_air": (f"{vendor} AND SHIP_MODE_CD = 'A'", "subset"),
        "vendor_other": (f"{vendor} AND SHIP_MODE_CD <> 'A'", "subset"),
        "measured": ("Lateness <> 'Unmeasured'", "subset"),
    }
    return guarded_sums({n: ("Units", f"{within} AND {c}", nulls) for n, (c, nulls) in conditions.items()})


IMPACT_COLUMNS = (
    "sot_pct",
    "sot_variance",
    "transport_impact",
    "air_vendor_impact",
    "vendor_non_air_impact",
    "unmeasured_impact",
    "total_impact",
)


def impact_measures(
    df: DataFrame, keys: Sequence[str] = (), extra: Sums | None = None, within: str = "true"
) -> DataFrame:
    """Impact shares by ``keys`` over the rows ``within``; the five add up to one by construction."""
    target = 0.95  # fixed value: the on-time goal
    sums = impact_sums(within) | (extra or {})
    agg = measures_by(df, keys, sums)
    shares = {
        "sot_pct": "on_time",
        "transport_impact": "transport",
        "air_vendor_impact": "vendor_air",
        "vendor_non_air_impact": "vendor_other",
    }
    known = " + ".join(shares)
    agg = agg.withColumns(
        {share: F.expr(f"CAST(try_divide({part}, measured) AS DOUBLE)") for share, part in shares.items()}
    ).withColumns(
        {
            "unmeasured_impact": F.expr(f"1 - ({known})"),
            "total_impact": F.expr(f"{known} + (1 - ({known}))"),
            "sot_variance": F.col("sot_pct") - F.lit(target),
        }
    )
    return agg.select(*keys, *(extra or {}), *IMPACT_COLUMNS)

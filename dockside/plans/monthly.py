"""Monthly shipped and stocked measures, their combined tables, lists and rankings.

Inputs named ``sot`` and ``ots`` are cleaned facts.  Brand-by-category sums are the
finest level: the brand, category and company levels are added up from them, so four
levels cost one pass over a fact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ots_percent, ratio, whole
from ..operators import (
    LATE,
    ON_TIME,
    OTS_NAMES,
    SOT_NAMES,
    combine,
    cond_sum,
    enrich,
    finish,
    measures_by,
    on_time_ratio,
    ots_sums,
    plain_sum,
    restrict,
    roll_up,
    sot_sums,
    sums_of_sums,
    top_k,
    top_n,
)
from ..schemas import SHIPPED_UNKNOWN, STOCKED_UNKNOWN
from ..sources.scratch import session_folder, stage

LEVELS = {
    "brand_category": ("ReportingBrand", "Category"),
    "brand": ("ReportingBrand",),
    "category": ("Category",),
    "company": (),
}

# Measure order of the combined tables.
COMBINED_ORDER = (
    "SOTUnits",
    "SOTOnTimeUnits",
    "SOTLateUnits",
    "SOTLate5daysUnits",
    "WTSOTLateUnits",
    "OTSUnits",
    "OTSOnTimeUnits",
    "OTSLateUnits",
    "OTSLate5daysUnits",
    "WTOTSLateUnits",
    "PPAUnits",
    "PPASOTLateUnits",
    "PPAOTSLateUnits",
    "PPASOT5daysLateUnits",
    "WTPPASOTLateUnits",
    "PPAOTSUnits",
)


def _in_order(*columns: str) -> list[Column]:
    """Ascending with missing values last."""
    return [F.col(c).asc_nulls_last() for c in columns]


# ---- levels ----


def sot_by(sot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Shipped measures by month and ``keys``."""
    return finish(measures_by(sot, ("ShipCancelMonth", *keys), sot_sums()), SOT_NAMES)


def ots_by(
    ots: DataFrame, keys: Sequence[str], keep: Sequence[str] = (), profile: str = "script"
) -> DataFrame:
    """Stocked measures by month and ``keys``; totals named in ``keep`` stay unfloored."""
    sums = ots_sums(air_total=profile == "script")
    return finish(measures_by(ots, ("Month_Number", *keys), sums), sums, keep)


def _levels(base: DataFrame, month: str, names: Sequence[str]) -> DataFrame:
    """All four levels of a finest-level aggregate, labelled, in one small rollup."""
    keys = (month, "ReportingBrand", "Category")
    sets = [[F.col(month), *(F.col(k) for k in level)] for level in LEVELS.values()]
    rolled = base.groupingSets(sets, *(F.col(k) for k in keys)).agg(
        F.grouping_id().alias("__gid"), *sums_of_sums(names)
    )
    # grouping_id has one bit per key, set where the key is summed over.
    label = F.element_at(
        F.create_map(*(F.lit(v) for v in (0, "brand_category", 1, "brand", 2, "category", 3, "company"))),
        F.col("__gid").cast("int"),
    )
    return rolled.select(label.alias("level"), *keys, *names)


def sot_levels(sot: DataFrame) -> DataFrame:
    """Brand-by-category, brand, category and company levels from one pass."""
    base = measures_by(sot, ("ShipCancelMonth", "ReportingBrand", "Category"), sot_sums())
    return finish(_levels(base, "ShipCancelMonth", SOT_NAMES), SOT_NAMES)


def ots_levels(ots: DataFrame) -> DataFrame:
    """Stocked counterpart; the company total is the one left unfloored."""
    base = measures_by(ots, ("Month_Number", "ReportingBrand", "Category"), ots_sums())
    levels = finish(_levels(base, "Month_Number", OTS_NAMES), OTS_NAMES, keep=("OTSUnits",))
    units = F.col("OTSUnits")
    return levels.withColumn(
        "OTSUnits",
        F.when(F.col("level") == "company", units).otherwise(F.floor(units).cast("double")),
    )


def company_ots(ots: DataFrame, profile: str = "script") -> DataFrame:
    return ots_by(ots, (), keep=("OTSUnits",), profile=profile)


# ---- combined tables ----


def combined(
    shipped: DataFrame, stocked: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Stocked measures beside shipped measures, in published column order."""
    on = {"ShipCancelMonth": "Month_Number"} | {k: k for k in keys if k != "ShipCancelMonth"}
    both = combine(shipped, stocked, on, how)
    lead = keys if "ShipCancelMonth" in keys else ("ShipCancelMonth", *keys)
    return both.select(*lead, *(c for c in COMBINED_ORDER if c in both.columns))


def level_combined(
    sot: DataFrame, ots: DataFrame, level: str, profile: str = "script"
) -> DataFrame:
    """Combined table of one level."""
    keys = LEVELS[level]
    keep = ("OTSUnits",) if level == "company" else ()
    return combined(sot_by(sot, keys), ots_by(ots, keys, keep, profile), keys)


# ---- preferred vendors ----


def listed_copies(
    base: DataFrame, vendors: DataFrame, names: Sequence[str], dedupe: bool = False
) -> DataFrame:
    """Restrict vendor sums to the list; a key listed twice counts twice.

    The fact is summed before the join, so a vendor with very many lines reaches the
    join as a few rows.
    """
    on = {"Category": "new_category", "Parent_Vendor": "vendor_name"}
    if dedupe:
        return restrict(base, vendors, on, dedupe=True)
    copies = vendors.groupBy(*on.values()).agg(F.count("*").alias("copies"))
    return (
        restrict(base, copies, on)
        .withColumns({n: F.col(n) * F.col("copies") for n in names})
        .drop("copies")
    )


def preferred_sot(sot: DataFrame, vendors: DataFrame, dedupe: bool = False) -> DataFrame:
    base = measures_by(sot, ("Category", "Parent_Vendor", "ShipCancelMonth"), sot_sums())
    return finish(listed_copies(base, vendors, SOT_NAMES, dedupe), SOT_NAMES).orderBy(
        *_in_order("ShipCancelMonth", "Category", "Parent_Vendor")
    )


def preferred_ots(
    ots: DataFrame, vendors: DataFrame, dedupe: bool = False, profile: str = "script"
) -> DataFrame:
    sums = ots_sums(air_total=profile == "script")
    base = measures_by(ots, ("Category", "Parent_Vendor", "Month_Number"), sums)
    return finish(listed_copies(base, vendors, tuple(sums), dedupe), sums).orderBy(
        *_in_order("Month_Number", "Category", "Parent_Vendor")
    )


def preferred_combined(
    sot: DataFrame, ots: DataFrame, vendors: DataFrame, profile: str = "script"
) -> DataFrame:
    return combined(
        preferred_sot(sot, vendors),
        preferred_ots(ots, vendors, profile=profile),
        ("Category", "Parent_Vendor", "ShipCancelMonth"),
    )


# ---- lists ----


def _totals(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(plain_sum("Units", wide=True).alias("units"))


def leading_countries(totals: DataFrame, country: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` countries with most units, from wide sums ``units`` by code or finer.

    Units are summed per code before the names are joined.  A code with two names may rank
    twice, once under each.
    """
    by_code = totals.groupBy("CountryOfOrigin").agg(plain_sum("units", of="sums", wide=True).alias("units"))
    named = enrich(by_code, country.select("CTRY_CD", "CTRY_DESC"), {"CountryOfOrigin": "CTRY_CD"})
    named = named.groupBy("CountryOfOrigin", "CTRY_DESC").agg(
        whole(plain_sum("units", of="sums", wide=True)).alias("units_by_country")
    )
    return top_k(named, k, "units_by_country", ("CountryOfOrigin", "CTRY_DESC"))


def leading_vendors(totals: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` vendors with most units; lines without a vendor count as one vendor."""
    by_vendor = totals.groupBy("Parent_Vendor").agg(
        whole(plain_sum("units", of="sums", wide=True)).alias("units_by_vendor")
    )
    return top_k(by_vendor, k, "units_by_vendor", ("Parent_Vendor",))


def top_countries(sot: DataFrame, country: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` countries with most units."""
    return leading_countries(_totals(sot, "CountryOfOrigin"), country, k)


def top_vendors(sot: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` vendors with most units."""
    return leading_vendors(_totals(sot, "Parent_Vendor"), k)


def sums_of_listed(sums: DataFrame, chosen: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Monthly shipped measures of the listed countries or vendors, from finer sums."""
    return finish(roll_up(restrict(sums, chosen, on, dedupe=True), ("ShipCancelMonth",), SOT_NAMES), SOT_NAMES)


def stock_of_listed(sums: DataFrame, chosen: DataFrame, on: Mapping[str, str], names: Sequence[str]) -> DataFrame:
    """The stocked counterpart; the total stays unfloored."""
    listed = roll_up(restrict(sums, chosen, on, dedupe=True), ("Month_Number",), names)
    return finish(listed, names, keep=("OTSUnits",))


def listed_combined(
    shipped: DataFrame, stocked: DataFrame, chosen: DataFrame, key: str, ots_key: str, how: str,
    names: Sequence[str] = OTS_NAMES,
) -> DataFrame:
    """Both sides of the listed countries or vendors, from sums by key and month or finer."""
    return combined(
        sums_of_listed(shipped, chosen, {key: key}),
        stock_of_listed(stocked, chosen, {ots_key: key}, names),
        (),
        how,
    )


def _key_sums(sot: DataFrame, key: str, folder: str | None) -> tuple[DataFrame, DataFrame]:
    """Shipped sums by key and month, written once, and their units: a list and its measures
    come from one pass over the fact."""
    sums = measures_by(sot, (key, "ShipCancelMonth"), sot_sums())
    sums = stage(sums, "key_sums", folder or session_folder(sot.sparkSession, "key_sums"))
    return sums, sums.select(key, F.col("SOTUnits").alias("units"))


def country_sot(sot: DataFrame, country: DataFrame, folder: str | None = None) -> DataFrame:
    """Monthly shipped measures of the leading countries; the fact is read once."""
    sums, totals = _key_sums(sot, "CountryOfOrigin", folder)
    return sums_of_listed(sums, leading_countries(totals, country), {"CountryOfOrigin": "CountryOfOrigin"})


def vendor_sot(sot: DataFrame, folder: str | None = None) -> DataFrame:
    """Monthly shipped measures of the leading vendors; the fact is read once."""
    sums, totals = _key_sums(sot, "Parent_Vendor", folder)
    return sums_of_listed(sums, leading_vendors(totals), {"Parent_Vendor": "Parent_Vendor"})


def listed_ots(
    ots: DataFrame, chosen: DataFrame, on: Mapping[str, str], profile: str = "script"
) -> DataFrame:
    """Monthly stocked measures of the listed countries or vendors; total unfloored."""
    return company_ots(restrict(ots, chosen, on, dedupe=True), profile)


def country_combined(
    sot: DataFrame, ots: DataFrame, country: DataFrame, profile: str = "script",
    listed_from: DataFrame | None = None, folder: str | None = None,
) -> DataFrame:
    """Leading countries, only months that both sides have; each fact is read once.

    The notebook draws its list from lines before cleaning, ``listed_from``.
    """
    key, stock = "CountryOfOrigin", ots_sums(air_total=profile == "script")
    sums, totals = _key_sums(sot, key, folder)
    chosen = leading_countries(totals if listed_from is None else _totals(listed_from, key), country)
    stocked = measures_by(ots, ("ORIGIN_COUNTRY_CODE", "Month_Number"), stock)
    return listed_combined(sums, stocked, chosen, key, "ORIGIN_COUNTRY_CODE", "inner", tuple(stock))


def vendor_combined(
    sot: DataFrame, ots: DataFrame, profile: str = "script",
    listed_from: DataFrame | None = None, folder: str | None = None,
) -> DataFrame:
    """Leading vendors; each fact is read once."""
    key, stock = "Parent_Vendor", ots_sums(air_total=profile == "script")
    sums, totals = _key_sums(sot, key, folder)
    chosen = leading_vendors(totals if listed_from is None else _totals(listed_from, key))
    stocked = measures_by(ots, (key, "Month_Number"), stock)
    return listed_combined(sums, stocked, chosen, key, key, "left", tuple(stock))


# ---- stocked-side tables ----


def ots_by_centre(ots: DataFrame, profile: str = "script") -> DataFrame:
    """Distribution centres by month; the notebook divides by all units."""
    total = partial(cond_sum, nulls="strict", wide=True)
    on_time, units = total("Units", ON_TIME), plain_sum("Units", wide=True)
    share = (
        on_time_ratio("strict") if profile == "script" else ratio(on_time, units)
    )
    unit_days = total("Units * Days_Late", f"{LATE} AND Days_Late >= 1")
    return ots.groupBy("Fiscal_Month", "Month_Number", "DCCampus", "DC_NAME", "DestCtryCD").agg(
        whole(on_time).alias("OnTimeUnits"),
        whole(units).alias("total_units"),
        share.alias("ots_pct"),
        whole(total("Units", f"{LATE} AND Days_Late > 5")).alias("OTSLate5daysUnits"),
        whole(unit_days).alias("WTOTSLateUnits"),
        whole(total("Units", LATE)).alias("LateUnits"),
    ).select(
        "Fiscal_Month",
        "Month_Number",
        "OnTimeUnits",
        "total_units",
        "DCCampus",
        "DC_NAME",
        "DestCtryCD",
        "ots_pct",
        "OTSLate5daysUnits",
        "WTOTSLateUnits",
        "LateUnits",
    )


def stocked_vs_shipped(ots: DataFrame, sot: DataFrame, collapsed: bool = False) -> DataFrame:
    """Stocked units by month, stocked status and shipped status of the same line.

    Both sides collapse by line id before they meet: shipped lines to one row per id and
    status with a count, stocked lines to one row per id, month and status.  An id that
    repeats very often shrinks in the tasks that read it, and its pairs are added up
    without being listed.  Every status is carried, known or not.

    From facts, stocked lines cross the network twice for that: by id, month and status, then
    by id.  With ``collapsed`` both inputs are cleaned tables of
    :func:`dockside.sources.write_lines`, whose buckets need no shuffle for either.
    """
    status = F.col("Lateness")
    count = F.sum("lines") if collapsed else F.count("*")
    units = plain_sum("Units", of="sums" if collapsed else "lines", wide=True)
    shipped = (
        sot.where(status != SHIPPED_UNKNOWN)
        .groupBy("NUMBER_SEQ", status.alias("ShippedOnTime"))
        .agg(count.alias("lines"))
    )
    stocked = (
        ots.where(status != STOCKED_UNKNOWN)
        .groupBy("NUMBER_SEQ", "Month_Number", status.alias("StockedOnTime"))
        .agg(units.alias("Units"))
    )
    return (
        stocked.join(shipped, "NUMBER_SEQ")
        .groupBy("Month_Number", "StockedOnTime", "ShippedOnTime")
        .agg(whole(plain_sum("Units * lines", of="sums", wide=True)).alias("SumOfUnits"))
    )


def vendor_week_stock(ots: DataFrame, with_percent: bool = False) -> DataFrame:
    """Vendor, month and week stock units, optionally with late units and percent."""
    # Fixed value: the published spelling, which no status uses, so every line counts.
    measurable = cond_sum("Units", "Lateness <> 'Unmeasurable'", "strict")
    on_time = cond_sum("Units", ON_TIME, "strict")
    columns = {
        "OnTime_Units_sum": on_time,
        "Total_Units_sum": plain_sum("Units"),
        "Measurable_Units_sum": measurable,
    }
    if with_percent:
        columns = {
            "OnTime_Units_sum": on_time,
            "Late_Units_sum": cond_sum("Units", LATE, "strict"),
            "Total_Units_sum": columns["Total_Units_sum"],
            "Measurable_Units_sum": measurable,
        }
    out = measures_by(ots, ("Parent_Vendor", "Month_Number", "Week"), columns)
    if with_percent:
        out = out.withColumn(
            "OTS_Percent_value",
            ots_percent(F.col("OnTime_Units_sum"), F.col("Measurable_Units_sum")),
        )
    return out


# ---- rankings ----

_LENIENT = "lenient_"


def lenient_sums() -> dict[str, Column]:
    """The shipped measures that rankings show, skipping nulls, under names of their own."""
    sums = sot_sums("lenient")
    return {f"{_LENIENT}{n}": sums[n] for n in SOT_NAMES[1:5]}


def _ranked(table: DataFrame, key: str, n: int) -> DataFrame:
    """The vendors with most late units of each month and brand (or category), ties kept."""
    shown = ("SOTUnits", "AdjustedSOTUnits", *SOT_NAMES[1:5])
    table = finish(table, shown).select(key, "ShipCancelMonth", "Parent_Vendor", *shown)
    return top_n(table, n, "SOTLateUnits", (key, "ShipCancelMonth")).orderBy(
        *_in_order(key, "ShipCancelMonth"),
        F.col("SOTLateUnits").desc_nulls_last(),
        *_in_order("Parent_Vendor"),
    )


def delays_of_sums(base: DataFrame, key: str, n: int = 10, profile: str = "script") -> DataFrame:
    """The ranking from finer sums that also hold :func:`lenient_sums`."""
    source = {m: m if profile == "notebook" else f"{_LENIENT}{m}" for m in SOT_NAMES[1:5]}
    if key == "ReportingBrand":
        source["SOTLate5daysUnits"] = "SOTLate5daysUnits"
    add = partial(plain_sum, of="sums", wide=True)
    sums = {"SOTUnits": add("SOTUnits"), **{m: add(c) for m, c in source.items()}}
    table = measures_by(base, (key, "ShipCancelMonth", "Parent_Vendor"), sums)
    measured = F.col("SOTOnTimeUnits") + F.col("SOTLateUnits")
    return _ranked(table.withColumn("AdjustedSOTUnits", measured), key, n)


def top_delays(sot: DataFrame, key: str, n: int = 10, profile: str = "script") -> DataFrame:
    """The ranking straight from the fact."""
    sums = sot_sums() | ({} if profile == "notebook" else lenient_sums())
    base = measures_by(sot, (key, "ShipCancelMonth", "Parent_Vendor"), sums)
    return delays_of_sums(base, key, n, profile)

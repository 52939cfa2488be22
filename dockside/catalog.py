"""Every report and operator as a query over the derived facts.

Names start with the inventory number of the report or operator.  A trailing ``n``
in the number marks the notebook variant.  Each query lists the fact columns it
reads, so that only the tables behind those columns are joined.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as fx
from . import operators as ops
from .fixtures import PARAMS
from .functions import pct_text, thousands
from .plans import (
    choice,
    cleaning,
    dashboard,
    delays,
    detail,
    domains,
    failure,
    impact,
    monthly,
)
from .plans.checks import RunChecks
from .schemas import PREFERRED_VENDOR, SHIP_CHOICE, TRANSIT_PLAN
from .sources import (
    OTS_LINE_KEYS,
    SOT_LINE_KEYS,
    equal_cuts,
    jdbc_ranges,
    read_dim,
    read_fact,
    read_lines,
    scratch_path,
    session_folder,
    split_dim,
    stage,
    tee,
    write_book,
    write_lines,
    write_report,
    write_snapshot,
)
from .schemas import SOT as SOT_SCHEMA

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SOT_CLEAN = ("FISCAL_YEAR", "ShipCancelWeek", "ReportingBrand", "Parent_Vendor", "MetricShipDate")
OTS_CLEAN = ("FISCAL_YEAR", "Week", "ReportingBrand", "Parent_Vendor", "DC_NAME")
SOT_MEASURED = ("ShipCancelMonth", "Units", "Lateness", "DAYS_LATE", "SHP_MODE_CATG_NM")
OTS_MEASURED = ("Month_Number", "Units", "Lateness", "Days_Late", "SHP_MODE_CATG_NM")
SHARE = ("Month_Number", "Units", "Lateness")
YEAR = PARAMS.fis_yr
LINE_BUCKETS = 8
RANGES = 8


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _columns(*groups: tuple[str, ...]) -> list[str]:
    return list(dict.fromkeys(c for g in groups for c in g))


def _sot(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Cleaned shipped lines; with no columns named, all of them."""
    wanted = _columns(SOT_CLEAN, columns) if columns else None
    return cleaning.clean_sot(fx.sot(spark, d, wanted, YEAR), PARAMS)


def _ots(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Cleaned stocked lines of every year."""
    return cleaning.clean_ots(fx.ots(spark, d, _columns(OTS_CLEAN, columns)), PARAMS)


def _ots_year(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Cleaned stocked lines of the year of the shipped side, for the combined tables."""
    ots = fx.ots(spark, d, _columns(OTS_CLEAN, columns), YEAR)
    return cleaning.clean_ots(ots, PARAMS, YEAR)


def _sot_extract(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Shipped lines, not cleaned: what the notebook starts from."""
    return fx.sot(spark, d, _columns(SOT_CLEAN, columns))


def _sot_n(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return cleaning.clean_sot(_sot_extract(spark, d, *columns), PARAMS, "notebook")


def _ots_n(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    ots = fx.ots(spark, d, _columns(OTS_CLEAN, columns))
    return cleaning.clean_ots(ots, PARAMS, profile="notebook")


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Six digits, so that engines agree on ratios."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


# ---- sources and sinks ----


@query
def s01_shipped_lines(spark, d):
    return fx.sot(spark, d)


@query
def s01_stocked_lines(spark, d):
    return fx.ots(spark, d)


@query
def s03_snapshot(spark, d):
    """Save a snapshot, load it back and sum it."""
    path = scratch_path(spark, "sot_snapshot")
    columns = ("NUMBER_SEQ", "FISCAL_YEAR", "ShipCancelMonth", "Units", "Lateness")
    write_snapshot(fx.sot(spark, d, columns), path)
    saved = read_fact(spark, path, SOT_SCHEMA, columns)
    return saved.groupBy("FISCAL_YEAR", "ShipCancelMonth", "Lateness").agg(
        F.count("*").alias("n"), F.sum("Units").alias("units")
    )


@query
def s03_failed_save(spark, d):
    """A save that fails half-way, then one that reads what it replaces: lines of late years."""
    path = session_folder(spark, "sot_versions")
    columns = ("NUMBER_SEQ", "FISCAL_YEAR", "ShipCancelMonth", "Units", "Lateness")
    lines = fx.sot(spark, d, columns)
    write_snapshot(lines, path)
    broken = F.when(F.col("FISCAL_YEAR") == YEAR, F.raise_error(F.lit("broken"))).otherwise(F.col("Units"))
    with suppress(Exception):
        write_snapshot(lines.withColumn("Units", broken), path)
    write_snapshot(read_fact(spark, path, SOT_SCHEMA, columns).where(F.col("FISCAL_YEAR") >= YEAR - 2), path)
    saved = read_fact(spark, path, SOT_SCHEMA, columns)
    return saved.groupBy("FISCAL_YEAR", "ShipCancelMonth", "Lateness").agg(
        F.count("*").alias("n"), F.sum("Units").alias("units")
    )


def _delimited(df: DataFrame, name: str, sep: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.option("header", True).option("sep", sep).option("escape", '"').csv(path)
    return path


@query
def s04_quoted_csv(spark, d):
    """Vendor list through a comma-separated file; names hold commas."""
    name = F.concat("vendor_name", F.lit(', "Ltd"'))
    vendors = fx.preferred_vendor(spark, d).withColumn("vendor_name", name)
    return read_dim(spark, _delimited(vendors, "vendors", ","), PREFERRED_VENDOR)


@query
def s05_caret_file(spark, d):
    """Country names through a caret-separated file; one code is the text NA."""
    code = F.when(F.col("CTRY_CD") == "NATION_3", "NA").otherwise(F.col("CTRY_CD"))
    names = fx.country(spark, d).select(code.alias("CTRY_CD"), "CTRY_DESC")
    return read_dim(spark, _delimited(names, "country", "^"), names.schema, sep="^")


@query
def s08_sheet_as_csv(spark, d):
    """The transit plan sheet, exported as CSV, and the lines it covers."""
    plan = read_dim(spark, _delimited(fx.transit_plan(spark, d), "plan", ","), TRANSIT_PLAN)
    lines = fx.sot(spark, d, ("XFR_Point_Place", "DC_GEO_LOC", "Units"))
    places = lines.groupBy("XFR_Point_Place", "DC_GEO_LOC").agg(F.sum("Units").alias("units"))
    return ops.enrich(
        places, plan, {"XFR_Point_Place": "tp_place", "DC_GEO_LOC": "geo_description"}
    )


def _report_back(df: DataFrame, name: str, null_token: str | None = None) -> DataFrame:
    """Write a report file and read it with the schema of the report."""
    spark = df.sparkSession
    params = replace(PARAMS, out_dir=scratch_path(spark, "reports"))
    path = write_report(df, name, params, null_token, single_file=True, headings=False)
    return spark.read.option("header", True).schema(df.schema).csv(path)


@query
def s09_report_file(spark, d):
    return _report_back(r16_brand_combined(spark, d), "Monthly_Brand_Combine")


@query
def s10_null_token(spark, d):
    """Missing stocked measures are written as 0."""
    table = r19_preferred_combined(spark, d)
    return _report_back(table, "Preferred_Vendor_New_Combine", "0")


@query
def s11_tee(spark, d):
    return tee(r44_market_check(spark, d), scratch_path(spark, "check.csv"))


@query
def s12_book(spark, d):
    """Two tables under one folder, both read back."""
    tables = {
        "Late lines": r70_late_brand_lines(spark, d),
        "By route": r71_late_brand_routes(spark, d),
    }
    paths = write_book(tables, scratch_path(spark, "brand_book"))
    back = [
        spark.read.option("header", True).schema(table.schema).csv(paths[name]).select(
            F.lit(name).alias("table"), *choice.ROUTE, F.col(units).alias("units")
        )
        for (name, table), units in zip(tables.items(), ("Units", "vendor_units"), strict=True)
    ]
    return ops.stack(*back)


@query
def s06_rule_table(spark, d):
    """The shipping-choice rules through a file, and the units they cover."""
    rules = read_dim(spark, _delimited(fx.ship_choice(spark, d), "rules", ","), SHIP_CHOICE)
    units = _sot(spark, d, *ROUTES).groupBy(*choice.ROUTE).agg(F.sum("Units").alias("units"))
    return ops.enrich(rules, units, {k: k for k in choice.ROUTE})


@query
def s06_bad_rows(spark, d):
    """A vendor file in which some identifiers are no numbers: its good rows and its bad records."""
    ident = F.expr("CASE WHEN vendor_id % 10 = 3 THEN concat('x', vendor_id) ELSE CAST(vendor_id AS STRING) END")
    vendors = fx.preferred_vendor(spark, d).withColumn("vendor_id", ident)
    split = split_dim(spark, _delimited(vendors, "vendors", ","), PREFERRED_VENDOR)
    line = F.concat_ws(",", *PREFERRED_VENDOR.names)
    good = split.good.select(F.lit("good").alias("kind"), line.alias("line"))
    return good.unionByName(split.bad.select(F.lit("bad").alias("kind"), F.col("record").alias("line")))


@query
def s01_equal_cuts(spark, d):
    """Ranges of the line id for a parallel read: how many, whether even, and their lines."""
    lines = fx.sot(spark, d, ("NUMBER_SEQ",))
    ranges = jdbc_ranges("NUMBER_SEQ", equal_cuts(lines, "NUMBER_SEQ", RANGES))
    sizes = lines.agg(*(F.count_if(F.expr(r)).alias(f"n{i}") for i, r in enumerate(ranges)))
    each = F.array(*(F.col(f"n{i}") for i in range(len(ranges))))
    total = F.aggregate(each, F.lit(0).cast("long"), lambda a, n: a + n)
    return sizes.select(
        F.lit(len(ranges)).alias("ranges"),
        F.forall(each, lambda n: F.abs(n * len(ranges) - total) <= total / 10).alias("even"),
        total.alias("lines"),
    )


@query
def w04_run_checks(spark, d):
    """Snapshot dates of both facts as a weekly run sees them, from the pass that sums the lines."""
    checks = RunChecks()
    for name, fact, month in (
        ("sot", _sot(spark, d, "Data_Pulled", *SOT_MEASURED), "ShipCancelMonth"),
        ("ots", _ots(spark, d, "Data_Pulled", *OTS_MEASURED), "Month_Number"),
    ):
        sums = checks.one_snapshot_date(fact, name).groupBy(month).agg(ops.plain_sum("Units").alias("units"))
        sums.write.format("noop").mode("overwrite").save()
    rows = [(name, m["first"], m["last"], m["lines"]) for name, m in checks.verify().items()]
    return spark.createDataFrame(rows, "fact string, first date, last date, lines long")


# ---- single operators that no report shows alone ----


@query
def p09_country_relabel(spark, d):
    lines = fx.ots(spark, d, ("DestCtryCD", "Units"))
    name = ops.relabel("DestCtryCD", domains.COUNTRY_GROUPS)
    return lines.groupBy(name.alias("country")).agg(
        F.count("*").alias("n"), F.sum("Units").alias("units")
    )


@query
def p14_vendor_levels(spark, d):
    return ops.domain_of(fx.sot(spark, d, ("Parent_Vendor",)), "Parent_Vendor")


@query
def p14_sixth_vendor(spark, d):
    return ops.nth_level(fx.sot(spark, d, ("Parent_Vendor",)), "Parent_Vendor", 6)


@query
def p15_random_rows(spark, d):
    keys = ("ShipCancelMonth", "ReportingBrand", "Category")
    return ops.peek(r05_sot_brand_category(spark, d), keys, 10, seed=7)


# Measures over lines with fractional and missing values, by vendor, year and month.
ROUGH_KEYS = ("Parent_Vendor", "FISCAL_YEAR", "ShipCancelMonth")
ROUGH = (*ROUGH_KEYS, "Units", "Lateness", "DAYS_LATE", "SHP_MODE_CATG_NM")


def _modes(nulls: str) -> Query:
    def run(spark, d):
        sums = {
            "on_time": ops.cond_sum("Units", ops.ON_TIME, nulls),
            "late": ops.cond_sum("Units", ops.LATE, nulls),
            "all_units": ops.plain_sum("Units") if nulls == "strict" else ops.cond_sum("Units", "true", nulls),
        }
        return ops.measures_by(fx.sot_rough(spark, d, ROUGH), ROUGH_KEYS, sums)

    return run


QUERIES["a01_strict_sums"] = _modes("strict")
QUERIES["a02_lenient_sums"] = _modes("lenient")
QUERIES["a03_subset_sums"] = _modes("subset")


@query
def a04_mixed_impact(spark, d):
    """On-time units skip every null; measured units do not skip missing units."""
    sums = {
        "on_time": ops.cond_sum("Units", ops.ON_TIME, "lenient"),
        "measured": ops.cond_sum("Units", "Lateness <> 'Unmeasured'", "subset"),
    }
    return ops.measures_by(fx.sot_rough(spark, d, ROUGH), ROUGH_KEYS, sums)


@query
def a05_large_totals(spark, d):
    """Totals beyond 64 bits: sums by year and brand, added up by year and over all years.

    A measure is a bigint as long as its totals are, else a wide decimal.
    """
    lines = fx.sot_large(spark, d, ("FISCAL_YEAR", "ReportingBrand", *SOT_MEASURED))
    base = ops.measures_by(lines, ("FISCAL_YEAR", "ReportingBrand"), ops.sot_sums("lenient"))
    years = ops.roll_up(base, ("FISCAL_YEAR",), ops.SOT_NAMES)
    total = ops.roll_up(base, (), ops.SOT_NAMES).withColumn("FISCAL_YEAR", F.lit(None).cast("int"))
    totals = stage(years.unionByName(total), "totals", session_folder(spark, "totals"))
    return ops.finish_wide(totals, ops.SOT_NAMES)


@query
def x01_floor(spark, d):
    """Floored totals of fractional units."""
    lines = fx.sot_rough(spark, d, ROUGH).where("Units IS NOT NULL AND Lateness IS NOT NULL")
    return ops.finish(ops.measures_by(lines, ("ShipCancelMonth",), ops.sot_sums()), ops.SOT_NAMES)


@query
def m05_weighted(spark, d):
    """All shipped measures, lenient: unit-days only count late rows with at least one day."""
    lines = fx.sot_rough(spark, d, ROUGH)
    sums = {n: c for n, c in ops.sot_sums("lenient").items() if n != "SOTUnits"}
    return ops.finish(ops.measures_by(lines, ROUGH_KEYS, sums), sums)


@query
def j06_any_status(spark, d):
    """The cross-table over lines with a status outside the usual ones."""
    shipped = fx.sot_rough(spark, d, ("NUMBER_SEQ", "Lateness"))
    return monthly.stocked_vs_shipped(
        _ots(spark, d, "NUMBER_SEQ", "Month_Number", "Lateness", "Units"), shipped
    )


@query
def j06_bucketed_lines(spark, d):
    """The cross-table from lines saved in buckets of their id."""
    root = session_folder(spark, "lines")
    ots = fx.ots(spark, d, _columns(OTS_LINE_KEYS, ("Units",)))
    sot = fx.sot(spark, d, _columns(SOT_LINE_KEYS, ("Units",)), YEAR)
    write_lines(ots, f"{root}/ots", OTS_LINE_KEYS, LINE_BUCKETS)
    write_lines(sot, f"{root}/sot", SOT_LINE_KEYS, LINE_BUCKETS)
    return monthly.stocked_vs_shipped(
        cleaning.clean_ots(read_lines(spark, f"{root}/ots"), PARAMS, YEAR),
        cleaning.clean_sot(read_lines(spark, f"{root}/sot"), PARAMS),
        collapsed=True,
    )


@query
def w03_first_lines(spark, d):
    return ops.first_rows(fx.sot(spark, d), 6, ("NUMBER_SEQ",))


@query
def w04_snapshot_dates(spark, d):
    """Snapshot date of both facts, and how many dates each holds."""
    dates = (F.max("Data_Pulled").alias("pulled"), F.count_distinct("Data_Pulled").alias("dates"))
    shipped = fx.sot(spark, d, ("Data_Pulled",)).agg(*dates)
    stocked = fx.ots(spark, d, ("Data_Pulled",)).agg(*dates)
    return ops.stack(
        shipped.select(F.lit("SOT").alias("fact"), "*"),
        stocked.select(F.lit("OTS").alias("fact"), "*"),
    )


@query
def x04_percent_text(spark, d):
    share = dashboard.centre_month(_ots(spark, d, *SHARE), PARAMS)
    return share.select("entity", "Month_Number", pct_text(F.col("ots_pct")).alias("ots_text"))


@query
def x04_percent_digits(spark, d):
    """Shares of centres and months as text, with the digits that the whole column asks for."""
    shares = _ots(spark, d, "DC_NAME", *SHARE).groupBy("DC_NAME", "Month_Number").agg(
        ops.on_time_ratio().alias("share")
    )
    return ops.percent_texts(shares, {"share": "share_text"}).drop("share")


@query
def x05_thousands(spark, d):
    table = _brand_totals(spark, d)
    return table.select(
        "ReportingBrand", thousands(F.col("SOT_Units")).alias("units_text")
    )


def _brand_totals(spark, d):
    """Brand totals of the cleaned year."""
    return (
        _sot(spark, d, "Units").groupBy("ReportingBrand").agg(F.sum("Units").alias("SOT_Units"))
    )


# ---- cleaning ----


@query
def r01_clean_ots(spark, d):
    return cleaning.clean_ots(fx.ots(spark, d), PARAMS)


@query
def r02_clean_sot(spark, d):
    """The snapshot date is looked up in the fact."""
    return _clean_looked_up(spark, d, "script", YEAR)


def _clean_looked_up(
    spark: SparkSession, d: str, profile: str, year: int | None = None
) -> DataFrame:
    pulled = ops.snapshot_date(fx.sot(spark, d, ("Data_Pulled",)))
    params = replace(PARAMS, snapshot=None)
    return cleaning.clean_sot(fx.sot(spark, d, year=year), params, profile, pulled)


@query
def r01n_clean_ots(spark, d):
    return cleaning.clean_ots(fx.ots(spark, d), PARAMS, profile="notebook")


@query
def r02n_clean_sot(spark, d):
    return _clean_looked_up(spark, d, "notebook")


# ---- lists ----


@query
def r03_top_countries(spark, d):
    return monthly.top_countries(_sot(spark, d, "CountryOfOrigin", "Units"), fx.country(spark, d))


@query
def r04_top_vendors(spark, d):
    return monthly.top_vendors(_sot(spark, d, "Units"))


@query
def r03n_top_countries(spark, d):
    """The notebook draws its lists before cleaning."""
    extract = _sot_extract(spark, d, "CountryOfOrigin", "Units")
    return monthly.top_countries(extract, fx.country(spark, d))


@query
def r04n_top_vendors(spark, d):
    return monthly.top_vendors(_sot_extract(spark, d, "Units"))


# ---- levels ----


@query
def r05_sot_brand_category(spark, d):
    return monthly.sot_by(_sot(spark, d, *SOT_MEASURED, "Category"), ("ReportingBrand", "Category"))


@query
def r06_sot_brand(spark, d):
    return monthly.sot_by(_sot(spark, d, *SOT_MEASURED), ("ReportingBrand",))


@query
def r07_sot_category(spark, d):
    return monthly.sot_by(_sot(spark, d, *SOT_MEASURED, "Category"), ("Category",))


@query
def r08_sot_company(spark, d):
    return monthly.sot_by(_sot(spark, d, *SOT_MEASURED), ())


@query
def r05_r08_sot_levels(spark, d):
    return monthly.sot_levels(_sot(spark, d, *SOT_MEASURED, "Category"))


@query
def r09_ots_brand_category(spark, d):
    return monthly.ots_by(_ots(spark, d, *OTS_MEASURED, "Category"), ("ReportingBrand", "Category"))


@query
def r10_ots_brand(spark, d):
    return monthly.ots_by(_ots(spark, d, *OTS_MEASURED), ("ReportingBrand",))


@query
def r11_ots_category(spark, d):
    return monthly.ots_by(_ots(spark, d, *OTS_MEASURED, "Category"), ("Category",))


@query
def r12_ots_company(spark, d):
    return monthly.company_ots(_ots(spark, d, *OTS_MEASURED))


@query
def r09_r12_ots_levels(spark, d):
    return monthly.ots_levels(_ots(spark, d, *OTS_MEASURED, "Category"))


# ---- preferred vendors ----


@query
def r13_sot_preferred(spark, d):
    sot = _sot(spark, d, *SOT_MEASURED, "Category")
    return monthly.preferred_sot(sot, fx.preferred_vendor(spark, d))


@query
def j02_sot_preferred_once(spark, d):
    """A vendor listed twice counts once."""
    sot = _sot(spark, d, *SOT_MEASURED, "Category")
    return monthly.preferred_sot(sot, fx.preferred_vendor(spark, d), dedupe=True)


@query
def r14_ots_preferred(spark, d):
    ots = _ots(spark, d, *OTS_MEASURED, "Category")
    return monthly.preferred_ots(ots, fx.preferred_vendor(spark, d))


# ---- combined tables ----


def _level_combined(level: str, *extra: str) -> Query:
    def run(spark, d):
        return monthly.level_combined(
            _sot(spark, d, *SOT_MEASURED, *extra), _ots_year(spark, d, *OTS_MEASURED, *extra), level
        )

    return run


def _level_combined_n(level: str, *extra: str) -> Query:
    def run(spark, d):
        return monthly.level_combined(
            _sot_n(spark, d, *SOT_MEASURED, *extra),
            _ots_n(spark, d, *OTS_MEASURED, *extra),
            level,
            "notebook",
        )

    return run


QUERIES["r15_brand_category_combined"] = _level_combined("brand_category", "Category")


@query
def r16_brand_combined(spark, d):
    return _level_combined("brand")(spark, d)


QUERIES["r17_category_combined"] = _level_combined("category", "Category")
QUERIES["r18_company_combined"] = _level_combined("company")
QUERIES["r15n_brand_category_combined"] = _level_combined_n("brand_category", "Category")
QUERIES["r16n_brand_combined"] = _level_combined_n("brand")
QUERIES["r17n_category_combined"] = _level_combined_n("category", "Category")
QUERIES["r18n_company_combined"] = _level_combined_n("company")


@query
def r19_preferred_combined(spark, d):
    return monthly.preferred_combined(
        _sot(spark, d, *SOT_MEASURED, "Category"),
        _ots_year(spark, d, *OTS_MEASURED, "Category"),
        fx.preferred_vendor(spark, d),
    )


@query
def r19n_preferred_combined(spark, d):
    return monthly.preferred_combined(
        _sot_n(spark, d, *SOT_MEASURED, "Category"),
        _ots_n(spark, d, *OTS_MEASURED, "Category"),
        fx.preferred_vendor(spark, d),
        "notebook",
    )


CENTRE = ("Fiscal_Month", "DCCampus", "DestCtryCD")


@query
def r20_ots_by_centre(spark, d):
    return _rounded(monthly.ots_by_centre(_ots(spark, d, *OTS_MEASURED, *CENTRE)), "ots_pct")


@query
def r20n_ots_by_centre(spark, d):
    ots = _ots_n(spark, d, *OTS_MEASURED, *CENTRE)
    return _rounded(monthly.ots_by_centre(ots, "notebook"), "ots_pct")


@query
def r21_country_sot(spark, d):
    sot = _sot(spark, d, *SOT_MEASURED, "CountryOfOrigin")
    return monthly.country_sot(sot, fx.country(spark, d))


@query
def r22_country_ots(spark, d):
    ots = _ots(spark, d, *OTS_MEASURED, "ORIGIN_COUNTRY_CODE")
    on = {"ORIGIN_COUNTRY_CODE": "CountryOfOrigin"}
    return monthly.listed_ots(ots, r03_top_countries(spark, d), on)


@query
def r23_country_combined(spark, d):
    return monthly.country_combined(
        _sot(spark, d, *SOT_MEASURED, "CountryOfOrigin"),
        _ots_year(spark, d, *OTS_MEASURED, "ORIGIN_COUNTRY_CODE"),
        fx.country(spark, d),
    )


@query
def r23n_country_combined(spark, d):
    return monthly.country_combined(
        _sot_n(spark, d, *SOT_MEASURED, "CountryOfOrigin"),
        _ots_n(spark, d, *OTS_MEASURED, "ORIGIN_COUNTRY_CODE"),
        fx.country(spark, d),
        "notebook",
        _sot_extract(spark, d, "ShipCancelMonth", "CountryOfOrigin", "Units"),
    )


@query
def r24_vendor_sot(spark, d):
    return monthly.vendor_sot(_sot(spark, d, *SOT_MEASURED))


@query
def r25_vendor_ots(spark, d):
    on = {"Parent_Vendor": "Parent_Vendor"}
    return monthly.listed_ots(_ots(spark, d, *OTS_MEASURED), r04_top_vendors(spark, d), on)


@query
def r26_vendor_combined(spark, d):
    return monthly.vendor_combined(
        _sot(spark, d, *SOT_MEASURED), _ots_year(spark, d, *OTS_MEASURED)
    )


@query
def r26n_vendor_combined(spark, d):
    return monthly.vendor_combined(
        _sot_n(spark, d, *SOT_MEASURED),
        _ots_n(spark, d, *OTS_MEASURED),
        "notebook",
        _sot_extract(spark, d, "ShipCancelMonth", "Units"),
    )


@query
def r27_stocked_vs_shipped(spark, d):
    return monthly.stocked_vs_shipped(
        _ots_year(spark, d, "NUMBER_SEQ", "Month_Number", "Lateness", "Units"),
        _sot(spark, d, "NUMBER_SEQ", "Lateness"),
    )


@query
def r28_brand_delays(spark, d):
    return monthly.top_delays(_sot(spark, d, *SOT_MEASURED), "ReportingBrand")


@query
def r29_category_delays(spark, d):
    return monthly.top_delays(_sot(spark, d, *SOT_MEASURED, "Category"), "Category")


@query
def r28n_brand_delays(spark, d):
    sot = _sot_n(spark, d, *SOT_MEASURED)
    return monthly.top_delays(sot, "ReportingBrand", profile="notebook")


@query
def r29n_category_delays(spark, d):
    sot = _sot_n(spark, d, *SOT_MEASURED, "Category")
    return monthly.top_delays(sot, "Category", profile="notebook")


@query
def r30_vendor_week_stock(spark, d):
    return monthly.vendor_week_stock(_ots(spark, d, *SHARE))


@query
def r31_vendor_week_percent(spark, d):
    return monthly.vendor_week_stock(_ots(spark, d, *SHARE), with_percent=True)


# ---- dashboard ----


@query
def r32_centre_month(spark, d):
    return _rounded(dashboard.centre_month(_ots(spark, d, *SHARE), PARAMS), "ots_pct")


@query
def r33_centre_ytd(spark, d):
    return _rounded(dashboard.centre_ytd(_ots(spark, d, *SHARE), PARAMS), "ytd_ots_pct")


def _total(listed: tuple[str, ...], ytd: bool) -> Query:
    def run(spark, d):
        total = dashboard.centre_total(_ots(spark, d, *SHARE), PARAMS, listed, ytd)
        return _rounded(total, total.columns[-1])

    return run


QUERIES["r34_na_eu_month"] = _total(domains.NA_EU_CENTRES, ytd=False)
QUERIES["r35_na_eu_ytd"] = _total(domains.NA_EU_CENTRES, ytd=True)


@query
def r36_na_eu_row(spark, d):
    row = dashboard.total_row(
        _ots(spark, d, *SHARE), PARAMS, domains.NA_EU_CENTRES, domains.NA_EU_TOTAL
    )
    return _rounded(row, "ots_pct", "ytd_ots_pct")


QUERIES["r37_global_month"] = _total(domains.GLOBAL_CENTRES, ytd=False)
QUERIES["r38_global_ytd"] = _total(domains.GLOBAL_CENTRES, ytd=True)


@query
def r39_centre_joined(spark, d):
    table = dashboard.centre_joined(_ots(spark, d, *SHARE), PARAMS)
    return _rounded(table, "ots_pct", "ytd_ots_pct")


@query
def r40_global_row(spark, d):
    row = dashboard.total_row(
        _ots(spark, d, *SHARE), PARAMS, domains.GLOBAL_CENTRES, domains.GLOBAL_TOTAL
    )
    return _rounded(row, "ots_pct", "ytd_ots_pct")


@query
def r41_brand_month(spark, d):
    return _rounded(dashboard.brand_month(_ots(spark, d, *SHARE), PARAMS), "ots_pct")


@query
def r42_brand_ytd(spark, d):
    return _rounded(dashboard.brand_ytd(_ots(spark, d, *SHARE), PARAMS), "ytd_ots_pct")


@query
def r43_brand_joined(spark, d):
    table = dashboard.brand_joined(_ots(spark, d, *SHARE), PARAMS)
    return _rounded(table, "ots_pct", "ytd_ots_pct")


@query
def r44_market_check(spark, d):
    return dashboard.market_check(_ots(spark, d, "DC_NAME"))


@query
def r45_market_month(spark, d):
    return _rounded(dashboard.market_month(_ots(spark, d, *SHARE), PARAMS), "ots_pct")


@query
def r46_market_ytd(spark, d):
    return _rounded(dashboard.market_ytd(_ots(spark, d, *SHARE), PARAMS), "ytd_ots_pct")


@query
def r47_market_joined(spark, d):
    table = dashboard.market_joined(_ots(spark, d, *SHARE), PARAMS)
    return _rounded(table, "ots_pct", "ytd_ots_pct")


@query
def r48_dashboard(spark, d):
    table = dashboard.dashboard(_ots(spark, d, *SHARE), PARAMS)
    return _rounded(table, "ots_pct", "ytd_ots_pct")


@query
def p13_beside(spark, d):
    """The total row from two one-row results."""
    row = dashboard.total_row_beside(
        _ots(spark, d, *SHARE), PARAMS, domains.NA_EU_CENTRES, domains.NA_EU_TOTAL
    )
    return _rounded(row, "ots_pct", "ytd_ots_pct")


@query
def j10_centre_month_vs_ytd(spark, d):
    """The month table joined to the year-to-date table; a missing month matches itself."""
    ots = _ots(spark, d, *SHARE)
    table = ops.month_vs_ytd(
        dashboard.centre_month(ots, PARAMS),
        dashboard.centre_ytd(ots, PARAMS),
        ("entity", "Month_Number"),
    )
    return _rounded(table, "ots_pct", "ytd_ots_pct")


@query
def u01_dashboard_blocks(spark, d):
    """The dashboard from separate month and year-to-date tables."""
    table = dashboard.dashboard_from_blocks(_ots(spark, d, *SHARE), PARAMS)
    return _rounded(table, "ots_pct", "ytd_ots_pct")


@query
def r49_centre_by_month(spark, d):
    return _rounded(dashboard.centre_by_month(_ots(spark, d, *SHARE)), "ots_pct")


# ---- failure classification and impact ----

CLASSIFIED = (
    "ShipCancelMonth",
    "Category",
    "Units",
    "Lateness",
    "DAYS_LATE",
    "SHIP_MODE_CD",
    "SALES_TERMS_CODE",
    "ShipDateChoice",
    "XFR_Point_Place",
    "DC_GEO_LOC",
    "Contract_Ship_Cancel",
    "SHIP_CANCEL_DATE",
    "ACTUAL_ORIGIN_CONSOL_LCL_DATE",
    "ACTUAL_LP_LCL_DATE",
)


def _classified(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    wanted = _columns(CLASSIFIED, columns) if columns != ("*",) else ()
    return failure.classify(_sot(spark, d, *wanted), fx.transit_plan(spark, d))


@query
def r50_failure_classes(spark, d):
    return _classified(spark, d, "*")


def _impact(key: str | None, span: str) -> Query:
    def run(spark, d):
        table = impact.impact_by(_classified(spark, d), PARAMS, key, span)
        return _rounded(table, *ops.IMPACT_COLUMNS)

    return run


QUERIES["r51_brand_impact_month"] = _impact("ReportingBrand", "month")
QUERIES["r52_category_impact_month"] = _impact("Category", "month")
QUERIES["r53_company_impact_month"] = _impact(None, "month")
QUERIES["r54_brand_impact_ytd"] = _impact("ReportingBrand", "ytd")
QUERIES["r55_category_impact_ytd"] = _impact("Category", "ytd")
QUERIES["r56_company_impact_ytd"] = _impact(None, "ytd")


@query
def r57_vendor_air_failures(spark, d):
    return failure.vendor_air_failures(_classified(spark, d, "*"), PARAMS)


@query
def r58_consolidation_series(spark, d):
    return failure.consolidation_series(_classified(spark, d))


@query
def r59_consolidation_vs_late(spark, d):
    return failure.consolidation_vs_late(_classified(spark, d, "NUMBER_SEQ"))


@query
def r60_leading_vendors(spark, d):
    return impact.leading_vendors(_sot(spark, d, "Category", "Units"), PARAMS)


def _vendor_impact(spark: SparkSession, d: str, span: str) -> DataFrame:
    table = impact.vendor_impact(_classified(spark, d), PARAMS, span)
    return _rounded(table, *ops.IMPACT_COLUMNS)


@query
def r61_vendor_impact_month(spark, d):
    return _vendor_impact(spark, d, "month")


@query
def r62_vendor_impact_ytd(spark, d):
    return _vendor_impact(spark, d, "year")


@query
def p11_vendor_impact_text(spark, d):
    return impact.vendor_impact_text(_vendor_impact(spark, d, "month"))


# ---- delay reasons ----

REASONS = ("SHP_RSN_TYP_DESC", "Units")


@query
def r63_delayed_units(spark, d):
    return delays.delayed_units(_sot(spark, d, *REASONS), PARAMS)


@query
def r64_reason_units(spark, d):
    return delays.reason_units(_sot(spark, d, *REASONS), PARAMS)


@query
def r64_reason_units_delays(spark, d):
    return delays.reason_units(_sot(spark, d, *REASONS), PARAMS, delays_only=True)


@query
def r65_reason_spread(spark, d):
    return delays.reason_spread(_sot(spark, d, *REASONS), PARAMS)


@query
def r66_sub_reason_spread(spark, d):
    return delays.sub_reason_spread(_classified(spark, d), PARAMS)


@query
def r65_reason_box(spark, d):
    return delays.reason_boxes(_sot(spark, d, *REASONS), PARAMS)[0]


@query
def r65_reason_outliers(spark, d):
    """Outliers of the units of all lines with a reason, capped or not."""
    uncapped = replace(PARAMS, unit_cap=float("inf"))
    return delays.reason_boxes(_skewed(_sot(spark, d, *REASONS)), uncapped)[1]


@query
def r66_sub_reason_box(spark, d):
    return delays.sub_reason_boxes(_skewed(_classified(spark, d)), PARAMS)[0]


@query
def r66_sub_reason_outliers(spark, d):
    return delays.sub_reason_boxes(_skewed(_classified(spark, d)), PARAMS)[1]


def _skewed(lines: DataFrame) -> DataFrame:
    """Units to the third power: a long tail, which equal spacing lacks."""
    return lines.withColumn("Units", F.col("Units") * F.col("Units") * F.col("Units"))


# ---- ship choice ----

ROUTES = (*choice.ROUTE, "Contract_Ship_Cancel", "SHP_RSN_TYP_DESC", "Lateness", "Units")


def _routed(spark: SparkSession, d: str) -> DataFrame:
    return choice.routed_units(_sot(spark, d, *ROUTES), fx.ship_choice(spark, d))


@query
def r67_choice_base(spark, d):
    return choice.choice_base(_sot(spark, d, *ROUTES), fx.ship_choice(spark, d))


@query
def f15_first_choice_units(spark, d):
    """Units by route, first choices only."""
    rules = choice.first_choice(fx.ship_choice(spark, d))
    units = _sot(spark, d, *ROUTES).groupBy(*choice.ROUTE).agg(F.sum("Units").alias("units"))
    return ops.restrict(units, rules, {k: k for k in choice.ROUTE})


@query
def r68_first_choice(spark, d):
    table = choice.first_choice_performance(_routed(spark, d), PARAMS)
    return _rounded(table, "sot_pct_first", "sot_pct_all", "choice_impact")


@query
def r69_by_choice(spark, d):
    return _rounded(choice.performance_by_choice(_routed(spark, d), PARAMS), "sot_pct")


@query
def r70_late_brand_lines(spark, d):
    return choice.late_brand_lines(_sot(spark, d), PARAMS)


@query
def r71_late_brand_routes(spark, d):
    return choice.late_brand_routes(_sot(spark, d, *ROUTES), PARAMS)


# ---- vendor and brand detail ----

# These reports read the saved extract, before cleaning.

NAMES = ("Parent_Vendor", "ReportingBrand")
SERIES = (*NAMES, "Contract_Ship_Cancel", "Units", "Lateness", "SHP_RSN_TYP_DESC")
DETAIL = (*NAMES, "FISCAL_YEAR", "Fiscal_Month", "Category", "Units", "Lateness")


@query
def r72_vendor_series(spark, d):
    table = detail.weekly_series(fx.sot(spark, d, SERIES), PARAMS, "vendor")
    return _rounded(table, "sot_performance")


@query
def x15_series_span(spark, d):
    sot = fx.sot(spark, d, SERIES)
    return detail.series_span(detail.weekly_series(sot, PARAMS, "brand"))


@query
def r73_vendor_categories(spark, d):
    return detail.units_by_category(fx.sot(spark, d, DETAIL), PARAMS, "vendor")


@query
def r74_vendor_categories_month(spark, d):
    return detail.units_by_category(fx.sot(spark, d, DETAIL), PARAMS, "vendor", one_month=True)


@query
def r75_vendor_lateness_month(spark, d):
    return detail.lateness(fx.sot(spark, d, DETAIL), PARAMS, "vendor", one_month=True)


@query
def r76_vendor_brand_lateness(spark, d):
    return detail.brand_lateness(r75_vendor_lateness_month(spark, d))


@query
def r77_vendor_lateness_ytd(spark, d):
    return detail.lateness(fx.sot(spark, d, DETAIL), PARAMS, "vendor")


@query
def r78_vendor_largest_lines(spark, d):
    return detail.largest_lines(fx.sot(spark, d), PARAMS, "vendor")


@query
def r79_brand_series(spark, d):
    sot = fx.sot(spark, d, SERIES)
    table = detail.weekly_series(sot, PARAMS, "brand")
    return _rounded(table, "sot_performance", "delay_impact", "adjusted_sot")


@query
def r80_brand_categories(spark, d):
    return detail.units_by_category(fx.sot(spark, d, DETAIL), PARAMS, "brand")


@query
def r81_brand_categories_month(spark, d):
    return detail.units_by_category(fx.sot(spark, d, DETAIL), PARAMS, "brand", one_month=True)


@query
def r82_brand_lateness_month(spark, d):
    return detail.lateness(fx.sot(spark, d, DETAIL), PARAMS, "brand", one_month=True)


@query
def r83_brand_lateness_again(spark, d):
    return detail.brand_lateness(r82_brand_lateness_month(spark, d))


@query
def r84_brand_lateness_ytd(spark, d):
    return detail.lateness(fx.sot(spark, d, DETAIL), PARAMS, "brand")


@query
def r85_brand_largest_late_lines(spark, d):
    return detail.largest_lines(fx.sot(spark, d), PARAMS, "brand")

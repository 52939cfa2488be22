"""Whole report runs: from the extracts to the written files.

Inputs are the raw facts, read by :func:`dockside.sources.read_fact`.  Tables that
several reports share are written once to a scratch folder of the run and read back; the
folder is gone when the run ends.  The files of a run are published together, and
:func:`dockside.sources.published_files` names those of the last whole run.  File and table
names are fixed values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import (
    SOT_NAMES,
    finish,
    measures_by,
    ots_sums,
    read_snapshot_date,
    roll_up,
    sot_sums,
)
from ..params import ReportParams
from ..sources import (
    OTS_LINE_KEYS,
    SOT_LINE_KEYS,
    publish_run,
    run_folder,
    stage,
    tee,
    with_headings,
    write_book,
    write_lines,
    write_report,
    write_snapshot,
)
from . import choice, dashboard, delays, detail, failure, impact, monthly
from .checks import RunChecks
from .cleaning import clean_ots, clean_sot


@dataclass(frozen=True)
class Facts:
    """Cleaned facts, the shipped lines before cleaning, and the parameters with the
    snapshot date filled in."""

    sot: DataFrame
    ots: DataFrame
    params: ReportParams
    extract: DataFrame
    profile: str = "script"
    #: Cleaned stocked and shipped lines, collapsed and bucketed by line id, if they were saved.
    lines: tuple[DataFrame, DataFrame] | None = None


def prepare(
    sot: DataFrame,
    ots: DataFrame,
    params: ReportParams,
    fiscal_year: int | None = None,
    profile: str = "script",
    save_to: str | None = None,
    buckets: int | None = None,
) -> Facts:
    """Clean both facts; the snapshot date is looked up once, if it is not given.

    With ``save_to``, both extracts are first saved there as snapshots, and the reports
    read those; with ``buckets`` too, their lines are also saved collapsed in that many buckets
    of the line id, and the cross-table joins those where they lie.  ``fiscal_year`` cuts a
    stocked extract of several years.
    """
    lines = None
    if save_to:
        sot = write_snapshot(sot, f"{save_to}/SOT_Master")
        # A stocked extract of one year may lack the year.
        by = ("FISCAL_YEAR",) if "FISCAL_YEAR" in ots.columns else ()
        ots = write_snapshot(ots, f"{save_to}/OTS_Master", by)
    if params.snapshot is None:
        params = replace(params, snapshot=read_snapshot_date(sot))
    if save_to and buckets:
        lines = (
            clean_ots(write_lines(ots, f"{save_to}/OTS_Lines", OTS_LINE_KEYS, buckets), params, fiscal_year, profile),
            clean_sot(write_lines(sot, f"{save_to}/SOT_Lines", SOT_LINE_KEYS, buckets), params, profile),
        )
    return Facts(
        clean_sot(sot, params, profile), clean_ots(ots, params, fiscal_year, profile), params, sot, profile, lines
    )


def _sot_level(base: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return finish(roll_up(base, ("ShipCancelMonth", *keys), SOT_NAMES), SOT_NAMES)


@dataclass(frozen=True)
class Table:
    """A table of a run: its order in the file, and whether its size is bounded by months,
    brands, categories or centres."""

    rows: DataFrame
    order: Sequence[str] = ()
    bounded: bool = True


def weekly_tables(
    facts: Facts,
    vendors: DataFrame,
    country: DataFrame,
    folder: str,
    checks: RunChecks | None = None,
) -> dict[str, Table]:
    """The tables of the weekly run.

    Both facts are summed once by month, brand, category, vendor and country.  The combined
    tables, both lists and both rankings come from these sums; only the centre table and
    the cross-table read the facts again.  The notebook run has no cross-table.
    """
    notebook = facts.profile == "notebook"
    checks = checks or RunChecks()
    stocked_sums = ots_sums(air_total=not notebook)
    ots_names = tuple(stocked_sums)
    sot_base = stage(
        measures_by(
            checks.one_snapshot_date(facts.sot, "sot_snapshot"),
            ("ShipCancelMonth", "ReportingBrand", "Category", "Parent_Vendor", "CountryOfOrigin"),
            sot_sums() | ({} if notebook else monthly.lenient_sums()),
        ),
        "sot_base",
        f"{folder}/sot_base",
    )
    ots_base = stage(
        measures_by(
            checks.one_snapshot_date(facts.ots, "ots_snapshot"),
            ("Month_Number", "ReportingBrand", "Category", "Parent_Vendor", "ORIGIN_COUNTRY_CODE"),
            stocked_sums,
        ),
        "ots_base",
        f"{folder}/ots_base",
    )
    # The notebook draws its lists from lines before cleaning.
    if notebook:
        countries, leaders = monthly.top_countries(facts.extract, country), monthly.top_vendors(facts.extract)
    else:
        units = sot_base.withColumn("units", F.col("SOTUnits"))
        countries, leaders = monthly.leading_countries(units, country), monthly.leading_vendors(units)
    countries = stage(countries, "countries", f"{folder}/countries")
    leaders = stage(leaders, "vendors", f"{folder}/vendors")
    unfloored = ("OTSUnits",)

    def ots_level(base: DataFrame, keys: tuple[str, ...], keep: tuple[str, ...] = ()) -> DataFrame:
        return finish(roll_up(base, ("Month_Number", *keys), ots_names), ots_names, keep)

    def level(name: str) -> Table:
        keys = monthly.LEVELS[name]
        keep = unfloored if name == "company" else ()
        rows = monthly.combined(_sot_level(sot_base, keys), ots_level(ots_base, keys, keep), keys)
        return Table(rows, ("ShipCancelMonth", *keys))

    def listed(chosen: DataFrame, key: str, ots_key: str, how: str) -> Table:
        rows = monthly.listed_combined(sot_base, ots_base, chosen, key, ots_key, how, ots_names)
        return Table(rows, ("ShipCancelMonth",))

    vendor_keys = ("Category", "Parent_Vendor")

    def copies(base: DataFrame, month: str, names: Sequence[str]) -> DataFrame:
        rolled = roll_up(base, (*vendor_keys, month), names)
        return finish(monthly.listed_copies(rolled, vendors, names), names)

    preferred = monthly.combined(
        copies(sot_base, "ShipCancelMonth", SOT_NAMES),
        copies(ots_base, "Month_Number", ots_names),
        (*vendor_keys, "ShipCancelMonth"),
    ).orderBy(*(F.col(c).asc_nulls_last() for c in ("ShipCancelMonth", *vendor_keys)))

    def ranking(key: str) -> Table:
        return Table(monthly.delays_of_sums(sot_base, key, profile=facts.profile), bounded=False)

    tables = {
        "Monthly_Brand_Category_Combine": level("brand_category"),
        "Monthly_Brand_Combine": level("brand"),
        "Monthly_Category_Combine": level("category"),
        "Monthly_Company_Combine": level("company"),
        "Preferred_Vendor_New_Combine": Table(preferred, bounded=False),
        "Monthly_by_DC": Table(
            monthly.ots_by_centre(facts.ots, facts.profile),
            ("Fiscal_Month", "Month_Number", "DCCampus", "DC_NAME", "DestCtryCD"),
        ),
        "Monthly_Top_20_Countries": listed(countries, "CountryOfOrigin", "ORIGIN_COUNTRY_CODE", "inner"),
        "Monthly_Top_50_Vendors": listed(leaders, "Parent_Vendor", "Parent_Vendor", "left"),
        "Brand_Top_10_Delay": ranking("ReportingBrand"),
        "Category_Top_10_Delay": ranking("Category"),
    }
    if not notebook:
        if facts.lines:
            crossed = monthly.stocked_vs_shipped(*facts.lines, collapsed=True)
        else:
            crossed = monthly.stocked_vs_shipped(facts.ots, facts.sot)
        tables["OTSvsSOT"] = Table(crossed, ("Month_Number", "StockedOnTime", "ShippedOnTime"))
    return tables


ZERO_FILLED = (
    "Monthly_Brand_Category_Combine",
    "Monthly_Brand_Combine",
    "Preferred_Vendor_New_Combine",
)


class RunFiles(dict):
    """The published paths of a run by table, and the metrics of its ``checks``."""

    checks: dict[str, dict[str, Any]]


def _publish(
    facts: Facts, name: str, write: Callable[[ReportParams, RunChecks], dict[str, str]]
) -> RunFiles:
    """Write a run's files, judge its checks, and publish the files if all is well."""
    checks = RunChecks()
    metrics: dict[str, dict[str, Any]] = {}

    def checked(params: ReportParams) -> dict[str, str]:
        paths = write(params, checks)
        metrics.update(checks.verify())
        return paths

    files = RunFiles(publish_run(facts.sot.sparkSession, facts.params, name, checked))
    files.checks = metrics
    return files


def weekly_run(facts: Facts, vendors: DataFrame, country: DataFrame) -> RunFiles:
    """Write the weekly tables and return their folders; each fact is of one snapshot date."""

    def write(params: ReportParams, checks: RunChecks) -> dict[str, str]:
        with run_folder(facts.sot.sparkSession, "weekly") as folder:
            return {
                name: write_report(
                    t.rows, name, params, "0" if name in ZERO_FILLED else None, t.bounded, order=t.order
                )
                for name, t in weekly_tables(facts, vendors, country, folder, checks).items()
            }

    return _publish(facts, "weekly", write)


def stock_run(facts: Facts) -> RunFiles:
    """Write the stock table by vendor and week."""
    table = monthly.vendor_week_stock(facts.ots, with_percent=True)
    return _publish(facts, "stock", lambda params, _: {"OTS": write_report(table, "OTS", params)})


def impact_run(facts: Facts, plan: DataFrame, save_to: str | None = None) -> RunFiles:
    """Classify late lines, then write the line file, the impact tables, the vendor tables,
    the air failures, the consolidation series and the sub-reasons' box plot.

    The shares of every impact table add up to one.

    With ``save_to`` the classified lines stay there as a snapshot; else they are scratch.
    """
    with run_folder(facts.sot.sparkSession, "impact") as folder:
        lines = failure.classify(facts.sot, plan)
        if save_to:
            classified = write_snapshot(lines, f"{save_to}/SOT_Master_FOB")
        else:
            classified = stage(lines, "classified", f"{folder}/classified")
        return _publish(facts, "impact", lambda params, checks: _impact_files(classified, params, checks))


def _impact_files(classified: DataFrame, params: ReportParams, checks: RunChecks) -> dict[str, str]:
    tables = {
        "Trans_output": ("ReportingBrand", "month"),
        "Trans_output_category": ("Category", "month"),
        "Trans_output_company": (None, "month"),
        "Trans_output_YTD": ("ReportingBrand", "ytd"),
        "Trans_output_category_YTD": ("Category", "ytd"),
        "Trans_output_company_YTD": (None, "ytd"),
    }
    paths = {
        name: write_report(
            checks.shares_add_up(impact.impact_by(classified, params, key, span), name).coalesce(1), name, params
        )
        for name, (key, span) in tables.items()
    }
    vendor_tables = {
        name: impact.vendor_impact_text(impact.vendor_impact(classified, params, span))
        for name, span in (("Trans_output_Vendor", "month"), ("Trans_output_Vendor_YTD", "year"))
    }
    paths |= write_book(vendor_tables, f"{params.out_dir}/Impact_files")
    paths["SOT_Impact_lines"] = write_report(classified, "SOT_Impact_lines", params)
    paths["Vendor_air_failures"] = write_report(
        failure.vendor_air_failures(classified, params), "Vendor_air_failures", params
    )
    paths["Consolidation_series"] = write_report(
        failure.consolidation_series(classified), "Consolidation_series", params
    )
    paths["Delay_sub_reasons"] = write_report(
        delays.sub_reason_spread(classified, params), "Delay_sub_reasons", params,
        single_file=True, order=("sub_reason",),
    )
    boxes, outliers = delays.sub_reason_boxes(classified, params)
    paths["Delay_sub_reason_boxes"] = write_report(
        boxes, "Delay_sub_reason_boxes", params, single_file=True, order=("sub_reason",)
    )
    paths["Delay_sub_reason_outliers"] = write_report(outliers, "Delay_sub_reason_outliers", params)
    return paths


def delay_run(facts: Facts) -> RunFiles:
    """Write the tables of the week's transport delay reasons."""
    boxes, outliers = delays.reason_boxes(facts.sot, facts.params)
    tables = {
        "Delayed_units": delays.delayed_units(facts.sot, facts.params),
        "Delay_reasons": delays.reason_units(facts.sot, facts.params, delays_only=True),
        "All_reasons": delays.reason_units(facts.sot, facts.params),
        "Delay_reason_spread": delays.reason_spread(facts.sot, facts.params),
        "Delay_reason_boxes": boxes,
        "Delay_reason_outliers": outliers,
    }
    return _publish(facts, "delays", lambda params, _: write_book(tables, f"{params.out_dir}/Delay_reasons"))


def dashboard_run(facts: Facts) -> RunFiles:
    """Write the dashboard, in numbers and as text, the centre table and the market check.

    Every centre of a market's list has that market; centres of no list are counted.
    """

    def write(params: ReportParams, checks: RunChecks) -> dict[str, str]:
        check = f"{params.out_dir}/check.csv"
        tee(checks.known_markets(dashboard.market_check(facts.ots), "DC_NAME", "custom_country"), check)
        board = dashboard.dashboard(facts.ots, params).drop("block")
        return {
            "check": check,
            "Log_All_bind": write_report(board.coalesce(1), "Log_All_bind", params),
            "Log_All_text": write_report(dashboard.as_text(board).coalesce(1), "Log_All_text", params, "NA"),
            "Monthly_by_DC_log": write_report(
                dashboard.centre_by_month(facts.ots), "Monthly_by_DC_log", params, single_file=True,
                order=("Month_Number", "DC_NAME"),
            ),
        }

    return _publish(facts, "dashboard", write)


def choice_run(facts: Facts, rules: DataFrame) -> RunFiles:
    """Write the choice tables and the late lines of one brand."""

    def write(params: ReportParams, _: RunChecks) -> dict[str, str]:
        with run_folder(facts.sot.sparkSession, "choice") as folder:
            base = stage(choice.routed_units(facts.sot, rules), "routed", f"{folder}/routed")
            return write_book(
                {
                    "First choice": choice.first_choice_performance(base, params),
                    "By choice": choice.performance_by_choice(base, params),
                    "By Ship Choice Matrix": choice.late_brand_routes(facts.sot, params),
                    "Late DPOs curr week": choice.late_brand_lines(facts.sot, params),
                },
                f"{params.out_dir}/Ship_Choice",
            )

    return _publish(facts, "choice", write)


def detail_tables(
    sot: DataFrame, params: ReportParams, dimension: str
) -> dict[str, DataFrame]:
    """Every table of a vendor or brand detail page."""
    month = detail.lateness(sot, params, dimension, one_month=True)
    tables = {
        "series": detail.weekly_series(sot, params, dimension),
        "categories": detail.units_by_category(sot, params, dimension),
        "categories_month": detail.units_by_category(sot, params, dimension, one_month=True),
        "lateness_month": month,
        "brand_lateness_month": detail.brand_lateness(month),
        "lateness": detail.lateness(sot, params, dimension),
        "largest_lines": detail.largest_lines(sot, params, dimension),
    }
    return {name: with_headings(df) for name, df in tables.items()}


def detail_run(facts: Facts, dimension: str) -> RunFiles:
    """Write the tables of a vendor or brand detail page; they read lines before cleaning."""
    tables = detail_tables(facts.extract, facts.params, dimension)
    name = f"Detail_{dimension}"
    return _publish(facts, name, lambda params, _: write_book(tables, f"{params.out_dir}/{name}"))

"""Detail tables of one vendor or one brand."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import matching, ratio, whole
from ..operators import LATE, MEASURED, ON_TIME, cond_sum, plain_sum, top_k
from ..params import ReportParams

DIMENSIONS = {"vendor": "Parent_Vendor", "brand": "ReportingBrand"}
DATE = "Contract_Ship_Cancel"


def _of(dimension: str, params: ReportParams) -> Column:
    wanted = params.focus_vendor if dimension == "vendor" else params.focus_brand
    return F.col(DIMENSIONS[dimension]) == wanted


def _one_month(params: ReportParams) -> Column:
    return (F.col("FISCAL_YEAR") == params.fis_yr) & matching(
        "Fiscal_Month", params.month_pattern
    )


def weekly_series(sot: DataFrame, params: ReportParams, dimension: str) -> DataFrame:
    """On-time percent by contract date; a brand also gets its delay impact."""
    on_time, done = cond_sum("Units", ON_TIME), cond_sum("Units", MEASURED)
    columns = {"sot_performance": 100 * ratio(on_time, done)}
    if dimension == "brand":
        delayed = cond_sum("Units", f"{LATE} AND SHP_RSN_TYP_DESC <> '-'")
        columns["delay_impact"] = 100 * ratio(delayed, done)
    series = (
        sot.where(_of(dimension, params) & F.col(DATE).between(*params.period))
        .groupBy(DATE)
        .agg(*(c.alias(n) for n, c in columns.items()))
    )
    if dimension == "brand":
        series = series.withColumn(
            "adjusted_sot", F.col("sot_performance") + F.col("delay_impact")
        )
    return series.orderBy(DATE)


def series_span(series: DataFrame) -> DataFrame:
    """First and last date of a series, for its caption."""
    return series.agg(F.min(DATE).alias("first_date"), F.max(DATE).alias("last_date"))


def _units(rows: DataFrame, keys: Sequence[str], floored: bool = False) -> DataFrame:
    total = plain_sum("Units")
    return (
        rows.groupBy(*keys)
        .agg((whole(total) if floored else total).alias("SOT_Units"))
        .orderBy(F.col("SOT_Units").desc_nulls_last(), *(F.col(k).asc_nulls_last() for k in keys))
    )


def units_by_category(
    sot: DataFrame, params: ReportParams, dimension: str, one_month: bool = False
) -> DataFrame:
    keys = (DIMENSIONS[dimension], "Category")
    rows = sot.where(_of(dimension, params))
    if one_month:
        return _units(rows.where(_one_month(params)), ("Fiscal_Month", *keys))
    return _units(rows, keys)


def lateness(
    sot: DataFrame, params: ReportParams, dimension: str, one_month: bool = False
) -> DataFrame:
    """Units by status: a vendor by brand and category, a brand by vendor.

    The year-to-date table is floored, the one-month table is not.
    """
    keys = {
        "vendor": ("Parent_Vendor", "Category", "ReportingBrand", "Lateness"),
        "brand": ("Parent_Vendor", "ReportingBrand", "Lateness"),
    }[dimension]
    rows = sot.where(_of(dimension, params))
    if one_month:
        return _units(rows.where(_one_month(params)), keys)
    return _units(rows, keys, floored=True)


def brand_lateness(month_table: DataFrame) -> DataFrame:
    """A lateness table summed again to brand and status."""
    return month_table.groupBy("ReportingBrand", "Lateness").agg(
        plain_sum("SOT_Units").alias("shipped_units")
    )


def largest_lines(
    sot: DataFrame, params: ReportParams, dimension: str, n: int = 50
) -> DataFrame:
    """The year's largest lines; for a brand only late ones, without the first column."""
    rows = sot.where(_of(dimension, params) & (F.col("FISCAL_YEAR") == params.fis_yr))
    if dimension == "vendor":
        return top_k(rows, n, "Units", ("NUMBER_SEQ",))
    late = rows.where(F.col("Lateness") == "Late")
    return top_k(late, n, "Units", ("NUMBER_SEQ",)).drop(sot.columns[0])

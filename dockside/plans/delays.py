"""Units by transport delay reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import box_plots, cond_sum, five_numbers, plain_sum, value_counts
from ..params import ReportParams

NO_REASON = "-"
REASON = "SHP_RSN_TYP_DESC"


def _week(params: ReportParams) -> Column:
    return F.col("ShipCancelWeek") == params.eow


def delayed_units(sot: DataFrame, params: ReportParams) -> DataFrame:
    """Units of the week by reason, largest first."""
    return (
        sot.where(_week(params))
        .groupBy("ShipCancelWeek", REASON)
        .agg(cond_sum("Units", "true").alias("delayed_units"))
        .orderBy(F.col("delayed_units").desc_nulls_last(), F.col(REASON).asc_nulls_last())
    )


def reason_units(sot: DataFrame, params: ReportParams, delays_only: bool = False) -> DataFrame:
    """Bar heights per reason, with or without lines that have none."""
    rows = sot.where(_week(params))
    if delays_only:
        rows = rows.where(F.col(REASON) != NO_REASON)
    return rows.groupBy(REASON).agg(plain_sum("Units").alias("units"))


def _reason_lines(sot: DataFrame, params: ReportParams) -> DataFrame:
    """Lines of the week with a reason; large lines are left out."""
    return sot.where(
        _week(params) & (F.col(REASON) != NO_REASON) & (F.col("Units") < params.unit_cap)
    )


def _tested_lines(classified: DataFrame, params: ReportParams) -> DataFrame:
    """Lines of the week with a tested failure sub-reason."""
    return classified.where(_week(params) & (F.col("sub_reason") != "Not Tested"))


def reason_spread(sot: DataFrame, params: ReportParams) -> DataFrame:
    """Five-number summary of line units per delay reason."""
    return five_numbers(_reason_lines(sot, params), (REASON,), "Units")


def sub_reason_spread(classified: DataFrame, params: ReportParams) -> DataFrame:
    """Five-number summary of line units per tested failure sub-reason."""
    return five_numbers(_tested_lines(classified, params), ("sub_reason",), "Units")


def reason_boxes(sot: DataFrame, params: ReportParams) -> tuple[DataFrame, DataFrame]:
    """Box plot of line units per delay reason: the boxes, and the outliers as value and count."""
    return box_plots(value_counts(_reason_lines(sot, params), (REASON,), "Units"), (REASON,), "Units")


def sub_reason_boxes(classified: DataFrame, params: ReportParams) -> tuple[DataFrame, DataFrame]:
    """Box plot of line units per tested failure sub-reason."""
    key = ("sub_reason",)
    return box_plots(value_counts(_tested_lines(classified, params), key, "Units"), key, "Units")

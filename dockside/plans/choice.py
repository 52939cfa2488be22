"""Performance of first-choice shipping routes against all routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import if_else_null, ratio
from ..operators import LATE, ON_TIME, cond_sum, on_rules, plain_sum, restrict
from ..params import ReportParams

ROUTE = ("SHIP_MODE_CD", "Trade_Lane_Type", "SALES_TERMS_CODE", "ShipDateChoice")
DATE = "Contract_Ship_Cancel"


REASON = "SHP_RSN_TYP_DESC"


def _units_by_route(sot: DataFrame) -> DataFrame:
    return sot.groupBy("ReportingBrand", DATE, *ROUTE, REASON, "Lateness").agg(
        plain_sum("Units", wide=True).alias("vendor_units")
    )


def choice_base(sot: DataFrame, rules: DataFrame) -> DataFrame:
    """Units by brand, date, route, reason and status; every rule stays, largest first."""
    label = if_else_null(F.col(REASON) != "-", "Delay Reason", "")
    return (
        on_rules(_units_by_route(sot), rules, ROUTE, "vendor_units")
        .withColumn("delay_label", label)
        .select(
            "ReportingBrand",
            DATE,
            *ROUTE,
            REASON,
            "Lateness",
            F.col("vendor_units").cast("double").alias("vendor_units"),
            "Ship_Choice_Status",
            "delay_label",
        )
        # The group columns break ties, so that a very common unit count is still
        # split over tasks by the sort.
        .orderBy(
            F.col("vendor_units").desc_nulls_last(),
            *(F.col(c).asc_nulls_last() for c in (DATE, "ReportingBrand", *ROUTE, REASON, "Lateness")),
        )
    )


def routed_units(sot: DataFrame, rules: DataFrame) -> DataFrame:
    """The base for performance tables: an unused rule has no date and no units there."""
    return restrict(_units_by_route(sot), rules, {k: k for k in ROUTE})


def first_choice(rules: DataFrame) -> DataFrame:
    return rules.where(F.col("Ship_Choice_Status") == 1)


def _units_where(cond: str, nulls: str = "strict") -> Column:
    return cond_sum("vendor_units", cond, nulls, of="sums")


def first_choice_performance(base: DataFrame, params: ReportParams) -> DataFrame:
    """On-time percent of first choices and of all choices by contract date."""
    first, measured = "Ship_Choice_Status = 1", "Lateness <> 'Unmeasured'"
    share = {
        "sot_pct_first": (f"{ON_TIME} AND {first}", f"{measured} AND {first}"),
        "sot_pct_all": (ON_TIME, measured),
    }
    return (
        base.where(F.col(DATE).between(*params.period))
        .groupBy(DATE)
        .agg(
            _units_where(ON_TIME).alias("OnTimeUnits"),
            _units_where(LATE).alias("LateUnits"),
            _units_where("Lateness = 'Unmeasured'").alias("unmeasured_units"),
            *(
                (100 * ratio(_units_where(a, "lenient"), _units_where(b, "lenient"))).alias(n)
                for n, (a, b) in share.items()
            ),
            plain_sum("vendor_units", of="sums").alias("units"),
        )
        .withColumn("choice_impact", F.col("sot_pct_first") - F.col("sot_pct_all"))
        .where(F.col("units") >= params.min_units)
    )


def performance_by_choice(base: DataFrame, params: ReportParams) -> DataFrame:
    """On-time percent by contract date and choice status."""
    total = plain_sum("vendor_units", of="sums")
    return (
        base.groupBy(DATE, "Ship_Choice_Status")
        .agg(
            _units_where(ON_TIME).alias("OnTimeUnits"),
            _units_where(LATE).alias("LateUnits"),
            (100 * ratio(_units_where(ON_TIME), total)).alias("sot_pct"),
            total.alias("units"),
        )
        .where(F.col("units") >= params.min_units)
    )


def _late_of_brand(params: ReportParams) -> Column:
    return (
        (F.col("ReportingBrand") == params.focus_brand)
        & (F.col("Lateness") == "Late")
        & (F.col("ShipCancelWeek") == params.eow)
    )


def late_brand_lines(sot: DataFrame, params: ReportParams) -> DataFrame:
    """Late lines of one brand in the week."""
    return sot.where(_late_of_brand(params))


def late_brand_routes(sot: DataFrame, params: ReportParams) -> DataFrame:
    """Late units of one brand in the week by route, largest first."""
    return (
        sot.where(_late_of_brand(params))
        .groupBy("ReportingBrand", *ROUTE)
        .agg(plain_sum("Units").alias("vendor_units"))
        .orderBy(F.col("vendor_units").desc_nulls_last())
    )

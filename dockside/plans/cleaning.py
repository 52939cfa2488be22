"""Rows that every report leaves out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import not_matching
from ..operators import snapshot_date
from ..params import ReportParams

# Name patterns of excluded brands, vendors and centres.
FRANCHISE = "FRANCHISE"
EXCLUDED_VENDORS = ("Liberty Distribution", "dummy")
EXCLUDED_CENTRES = "JPF"
RETIRED_BRAND = "PIPERLIME"


def no_franchise() -> Column:
    return not_matching("ReportingBrand", FRANCHISE)


def clean_ots(
    ots: DataFrame,
    params: ReportParams,
    fiscal_year: int | None = None,
    profile: str = "script",
) -> DataFrame:
    """Stocked lines up to the week, without excluded vendors, brands and centres.

    The stocked extract is expected to hold one year; ``fiscal_year`` cuts a wider
    one.  The ``notebook`` profile keeps franchise brands and lines without a centre.
    """
    kept = (
        (F.col("Week") <= params.eow)
        & not_matching("Parent_Vendor", *EXCLUDED_VENDORS)
        & not_matching("DC_NAME", EXCLUDED_CENTRES)
    )
    if fiscal_year is not None:
        kept = kept & (F.col("FISCAL_YEAR") == fiscal_year)
    if profile == "script":
        kept = kept & F.col("DC_NAME").isNotNull() & no_franchise()
    return ots.where(kept)


def clean_sot(
    sot: DataFrame,
    params: ReportParams,
    profile: str = "script",
    pulled: Column | None = None,
) -> DataFrame:
    """Shipped lines of the year up to the week and the snapshot date.

    The date comes from the parameters, or else from ``pulled``, or else is looked up
    in the fact.  The ``notebook`` profile keeps franchise brands and every fiscal year.
    """
    if params.snapshot is not None:
        pulled = F.lit(params.snapshot)
    elif pulled is None:
        pulled = snapshot_date(sot)
    kept = (
        (F.col("ShipCancelWeek") <= params.eow)
        & not_matching("Parent_Vendor", *EXCLUDED_VENDORS)
        & (F.col("MetricShipDate") <= pulled)
    )
    if profile == "script":
        kept = kept & (F.col("FISCAL_YEAR") == params.fis_yr) & no_franchise()
    return sot.where(kept)

"""Likely cause of every late shipped line, and the line lists built on it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import first_true, if_else_null
from ..operators import enrich, first_rows
from ..params import ReportParams
from .cleaning import no_franchise

NOT_TESTED = "Not Tested"
UNDECIDED = "NA"


def _with_days(sot: DataFrame, plan: DataFrame) -> DataFrame:
    """Transit plan and the four day counts."""
    places = {"XFR_Point_Place": "tp_place", "DC_GEO_LOC": "geo_description"}
    contract = F.col("Contract_Ship_Cancel")
    consolidated = F.col("ACTUAL_ORIGIN_CONSOL_LCL_DATE")
    expected = F.col("SHIP_CANCEL_DATE")
    planned = F.date_sub(contract, F.col("days_before_ship_cancel"))
    return enrich(sot, plan, places).withColumns(
        {
            "planned_oc": planned,
            "days_late_to_oc": F.datediff(consolidated, planned),
            "days_anticipated_vs_contract": F.datediff(expected, contract),
            "lp_vs_anticipated": F.datediff(F.col("ACTUAL_LP_LCL_DATE"), expected),
        }
    )


def _deciding_terms() -> dict[str, Column]:
    """Terms that decide the cause by themselves, under the sub-reason they give.

    They exclude each other.  The first three also need a consolidation more than two
    days past the contract date.
    """
    terms, mode, choice = (
        F.col("SALES_TERMS_CODE"),
        F.col("SHIP_MODE_CD"),
        F.col("ShipDateChoice"),
    )
    overdue = F.col("ACTUAL_ORIGIN_CONSOL_LCL_DATE") > F.date_add("Contract_Ship_Cancel", 2)
    return {
        "FCA Ocean": (terms == "FCA") & (mode == "O") & overdue,
        "FOB AIR": (terms == "FOB") & (mode == "A") & overdue,
        "CFR AIR": (terms == "CFR") & (mode == "A") & overdue,
        "EXW": terms == "EXW",
        "DDP DCON": (terms == "DDP") & (choice == "DCON"),
        "DDU OC": (terms == "DDU") & (choice == "OC"),
    }


def classify(sot: DataFrame, plan: DataFrame) -> DataFrame:
    """Probable failure, sub-reason and consolidation test per line.

    One narrow stage after the join to the transit plan.  ``is_match`` compares the
    two labels as they stand before the overrides.
    """
    late = F.col("Lateness") == "Late"
    gate = late & (F.col("SALES_TERMS_CODE") == "FOB") & (F.col("SHIP_MODE_CD") == "O")
    slip = F.col("days_anticipated_vs_contract")
    behind = F.col("days_late_to_oc")
    days = F.col("DAYS_LATE")
    failure = first_true(
        (slip <= 6, "Transportation"),
        (slip >= 7, "Vendor"),
        (behind > 0, "Vendor"),
        (behind <= 0, "Transportation"),
        default=UNDECIDED,
    )
    reason = first_true(
        ((slip >= 0) & (slip <= 6), "Test1"),
        (slip >= 7, "Test2"),
        (behind.isNotNull(), "Test3"),
        default=UNDECIDED,
    )
    test = first_true(
        (behind > 0, "Vendor"),
        ((behind <= 0) & (days > behind), "Trans"),
        (days == behind, "Vendor"),
        default=UNDECIDED,
    )
    consolidated = F.col("ACTUAL_ORIGIN_CONSOL_LCL_DATE").isNotNull()
    labelled = _with_days(sot, plan).withColumns(
        {
            "probable_failure": if_else_null(gate, failure, NOT_TESTED),
            "sub_reason": if_else_null(gate, reason, NOT_TESTED),
            "test_by_oc": if_else_null(gate & consolidated, test, NOT_TESTED),
        }
    )
    # A late line under deciding terms gets their label; it gets null where the
    # deciding date is unknown.
    terms = _deciding_terms()
    decided = late & reduce(Column.__or__, terms.values())
    labelled = labelled.withColumns(
        {
            "is_match": F.col("probable_failure") == F.col("test_by_oc"),
            "__decided": decided,
            "__terms": first_true(*((rule, name) for name, rule in terms.items())),
        }
    )
    hit = F.col("__decided")
    return labelled.withColumns(
        {
            "probable_failure": if_else_null(hit, "Vendor", F.col("probable_failure")),
            "sub_reason": if_else_null(hit, F.col("__terms"), F.col("sub_reason")),
            "test_by_oc": if_else_null(hit, "Vendor", F.col("test_by_oc")),
        }
    ).drop("__decided", "__terms")


def vendor_air_failures(classified: DataFrame, params: ReportParams) -> DataFrame:
    """Lines of the week that failed at the vendor and went by air."""
    return classified.where(
        (F.col("ShipCancelWeek") == params.eow)
        & no_franchise()
        & (F.col("probable_failure") == "Vendor")
        & (F.col("SHIP_MODE_CD") == "A")
    )


def _clipped() -> Column:
    return F.col("days_late_to_oc").between(-45, 45)


def consolidation_series(classified: DataFrame) -> DataFrame:
    """Days late to origin consolidation by date, extremes left out."""
    return classified.where(_clipped()).select(
        F.to_date("ACTUAL_ORIGIN_CONSOL_LCL_DATE").alias("consolidated_on"), "days_late_to_oc"
    )


def consolidation_vs_late(classified: DataFrame, n: int = 100) -> DataFrame:
    """Days late to consolidation against days late, on the first ``n`` lines."""
    return (
        first_rows(classified, n, ("NUMBER_SEQ",))
        .where(_clipped())
        .where((F.col("days_late_to_oc") != 0) | (F.col("DAYS_LATE") != 0))
        .select(
            F.to_date("ACTUAL_ORIGIN_CONSOL_LCL_DATE").alias("consolidated_on"),
            "days_late_to_oc",
            "DAYS_LATE",
            "Lateness",
        )
        .orderBy("consolidated_on")
    )

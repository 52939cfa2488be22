"""Share of measured units lost to each cause, by brand, category, vendor and company.

Inputs named ``classified`` come from :func:`dockside.plans.failure.classify`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import (
    IMPACT_COLUMNS,
    cond_sum,
    domain_frame,
    impact_measures,
    nulls_to_text,
    on_spine,
    plain_sum,
    top_n,
)
from ..params import ReportParams
from . import domains
from .cleaning import no_franchise

LISTS = {"ReportingBrand": domains.BRANDS, "Category": domains.CATEGORIES}


def _span(params: ReportParams, span: str) -> Column:
    year = F.col("FISCAL_YEAR") == params.fis_yr
    bounds = {
        "month": F.col("ShipCancelMonth") == params.fis_month,
        "ytd": year & (F.col("ShipCancelWeek") <= params.eow),
        "year": year,
    }
    return bounds[span] & no_franchise()


def impact_by(
    classified: DataFrame, params: ReportParams, key: str | None, span: str
) -> DataFrame:
    """Impact table of a month or of the year to date; without a key, the company row."""
    rows = classified.where(_span(params, span))
    if key is None:
        return impact_measures(rows)
    listed = LISTS[key]
    table = impact_measures(rows.where(F.col(key).isin(*listed)), (key,))
    spine = domain_frame(classified.sparkSession, listed, key)
    return on_spine(table, spine, key).orderBy("ordinal").drop("ordinal")


def leading_vendors(classified: DataFrame, params: ReportParams, n: int = 15) -> DataFrame:
    """Vendors with most units of the year per category, ties kept."""
    keys = ("Category", "Parent_Vendor")
    totals = (
        classified.where(_span(params, "year"))
        .groupBy(*keys)
        .agg(plain_sum("Units").alias("total_units"))
    )
    return top_n(totals, n, "total_units", ("Category",)).orderBy(
        F.col("Category").asc_nulls_last(), F.col("total_units").desc_nulls_last()
    )


def vendor_impact(
    classified: DataFrame, params: ReportParams, span: str, n: int = 15
) -> DataFrame:
    """Impact of the leading vendors; categories without one keep an empty row.

    One aggregate gives both the year's units, which decide who leads, and the measures
    of the span.
    """
    keys = ("Category", "Parent_Vendor")
    rows = classified.withColumns({"in_year": _span(params, "year"), "in_span": _span(params, span)})
    year = F.expr("count_if(in_year) > 0")
    own = {
        "total_units": F.when(year, cond_sum("Units", "in_year", "subset")),
        "lines": F.expr("count_if(in_span)"),
        "units": cond_sum("Units", "in_span", "subset"),
    }
    table = impact_measures(rows.where("in_year OR in_span"), keys, own, within="in_span")
    seen = F.col("lines") > 0  # a leader without a line in the span has no measures
    table = table.withColumns({c: F.when(seen, F.col(c)) for c in ("units", *IMPACT_COLUMNS)})
    led = top_n(table, n, "total_units", ("Category",)).withColumn("blank", F.when(seen, ""))
    spine = domain_frame(classified.sparkSession, domains.CATEGORIES, "Category")
    return on_spine(led, spine, "Category").select(
        "Category", "Parent_Vendor", "blank", "units", *IMPACT_COLUMNS
    )


def vendor_impact_text(table: DataFrame) -> DataFrame:
    """The same table as text, with a dash for every missing value."""
    return nulls_to_text(table, "-")

"""Distribution-centre dashboard: month against year to date, every listed row shown.

Inputs are cleaned stocked lines.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import not_matching, ratio, whole
from ..operators import (
    LATE,
    MEASURED,
    ON_TIME,
    beside,
    cond_sum,
    domain_frame,
    month_vs_ytd,
    on_spine,
    on_time_ratio,
    percent_texts,
    plain_sum,
    relabel,
    sql_text,
    stack,
)
from ..params import ReportParams
from . import domains
from .cleaning import RETIRED_BRAND, no_franchise

MONTH = "Month_Number"


def _rows(ots: DataFrame, retired: bool = True) -> DataFrame:
    """Dashboard lines; centre blocks leave the retired brand out, the others keep it."""
    kept = no_franchise()
    if retired:
        kept = kept & not_matching("ReportingBrand", RETIRED_BRAND)
    return ots.where(kept)


def _entity_shares(
    rows: DataFrame,
    entity: Column,
    listed: Sequence[str],
    shares: Mapping[str, Column],
    params: ReportParams,
) -> DataFrame:
    """On-time shares per listed entity, on the spine of the list.

    Unlisted entities are dropped before the aggregate, not by the spine join.
    """
    agg = (
        rows.withColumn("entity", entity)
        .where(F.col("entity").isin(*listed))
        .groupBy("entity")
        .agg(*(c.alias(n) for n, c in shares.items()))
        .withColumn(MONTH, F.lit(params.fis_month))
    )
    spine = domain_frame(rows.sparkSession, listed, "entity")
    return on_spine(agg, spine, "entity").select("entity", MONTH, *shares)


def _month(
    rows: DataFrame, entity: Column, listed: Sequence[str], params: ReportParams
) -> DataFrame:
    this_month = rows.where(F.col(MONTH) == params.fis_month)
    return _entity_shares(this_month, entity, listed, {"ots_pct": on_time_ratio()}, params)


def _ytd(
    rows: DataFrame, entity: Column, listed: Sequence[str], params: ReportParams
) -> DataFrame:
    return _entity_shares(rows, entity, listed, {"ytd_ots_pct": on_time_ratio()}, params)


def _month_and_ytd(
    rows: DataFrame, entity: Column, listed: Sequence[str], params: ReportParams
) -> DataFrame:
    """Both shares from one pass over the year-to-date rows."""
    within = f"{MONTH} = {params.fis_month}"
    shares = {"ots_pct": on_time_ratio(within=within), "ytd_ots_pct": on_time_ratio()}
    return _entity_shares(rows, entity, listed, shares, params)


def _until(rows: DataFrame, params: ReportParams) -> DataFrame:
    return rows.where(F.col(MONTH) <= params.fis_month)


_CENTRE, _CENTRES = "DC_NAME", domains.NA_EU_CENTRES


def centre_month(ots: DataFrame, params: ReportParams) -> DataFrame:
    return _month(_rows(ots), F.col(_CENTRE), _CENTRES, params)


def centre_ytd(ots: DataFrame, params: ReportParams) -> DataFrame:
    return _ytd(_until(_rows(ots), params), F.col(_CENTRE), _CENTRES, params)


def centre_joined(ots: DataFrame, params: ReportParams) -> DataFrame:
    return _month_and_ytd(_until(_rows(ots), params), F.col(_CENTRE), _CENTRES, params)


def centre_total(
    ots: DataFrame,
    params: ReportParams,
    listed: Sequence[str],
    ytd: bool,
    label: str = "",
) -> DataFrame:
    """One row: on-time share of all listed centres together."""
    month = F.col(MONTH)
    bound = month <= params.fis_month if ytd else month == params.fis_month
    return (
        _rows(ots)
        .where(bound & F.col("DC_NAME").isin(*listed))
        .agg(on_time_ratio().alias("ytd_ots_pct" if ytd else "ots_pct"))
        .select(F.lit(label).alias("entity"), F.lit(params.fis_month).alias(MONTH), "*")
    )


def total_row(
    ots: DataFrame, params: ReportParams, listed: Sequence[str], label: str
) -> DataFrame:
    """Month and year-to-date totals side by side, labelled, from one pass."""
    return (
        _until(_rows(ots), params)
        .where(F.col("DC_NAME").isin(*listed))
        .agg(
            on_time_ratio(within=f"{MONTH} = {params.fis_month}").alias("ots_pct"),
            on_time_ratio().alias("ytd_ots_pct"),
        )
        .select(F.lit(label).alias("entity"), F.lit(params.fis_month).alias(MONTH), "*")
    )


def total_row_beside(
    ots: DataFrame, params: ReportParams, listed: Sequence[str], label: str
) -> DataFrame:
    """The same row from the two one-row totals."""
    month = centre_total(ots, params, listed, ytd=False)
    ytd = centre_total(ots, params, listed, ytd=True).select("ytd_ots_pct")
    return beside(month, ytd).withColumn("entity", F.lit(label))


def _display_brand() -> Column:
    return relabel("ReportingBrand", domains.BRAND_GROUPS)


def brand_month(ots: DataFrame, params: ReportParams) -> DataFrame:
    return _month(_rows(ots, False), _display_brand(), domains.DISPLAY_BRANDS, params)


def brand_ytd(ots: DataFrame, params: ReportParams) -> DataFrame:
    rows = _until(_rows(ots, False), params)
    return _ytd(rows, _display_brand(), domains.DISPLAY_BRANDS, params)


def brand_joined(ots: DataFrame, params: ReportParams) -> DataFrame:
    rows = _until(_rows(ots, False), params)
    return _month_and_ytd(rows, _display_brand(), domains.DISPLAY_BRANDS, params)


def market() -> Column:
    """Market country of a centre; an unmapped centre has none."""
    return relabel("DC_NAME", domains.MARKET_CENTRES)


def market_check(ots: DataFrame) -> DataFrame:
    """Line count per centre and market, to find centres without a market."""
    return (
        ots.groupBy("DC_NAME", market().alias("custom_country"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.col("custom_country").asc_nulls_last(), F.col("DC_NAME").asc_nulls_last())
    )


def market_month(ots: DataFrame, params: ReportParams) -> DataFrame:
    return _month(_rows(ots, False), market(), domains.MARKETS, params)


def market_ytd(ots: DataFrame, params: ReportParams) -> DataFrame:
    """All months of the extract: the published report has no month bound here."""
    return _ytd(_rows(ots, False), market(), domains.MARKETS, params)


def market_joined(ots: DataFrame, params: ReportParams) -> DataFrame:
    return _month_and_ytd(_rows(ots, False), market(), domains.MARKETS, params)


def dashboard_from_blocks(ots: DataFrame, params: ReportParams) -> DataFrame:
    """The dashboard as published: month tables joined to year-to-date tables, stacked.

    :func:`dashboard` gives the same rows from one pass.
    """
    keys = ("entity", MONTH)
    blocks = (
        month_vs_ytd(centre_month(ots, params), centre_ytd(ots, params), keys),
        total_row_beside(ots, params, domains.NA_EU_CENTRES, domains.NA_EU_TOTAL),
        month_vs_ytd(brand_month(ots, params), brand_ytd(ots, params), keys),
        month_vs_ytd(market_month(ots, params), market_ytd(ots, params), keys),
        total_row_beside(ots, params, domains.GLOBAL_CENTRES, domains.GLOBAL_TOTAL),
    )
    return stack(*(b.withColumn("block", F.lit(i)) for i, b in enumerate(blocks, 1))).select(
        "block", "entity", MONTH, "ots_pct", "ytd_ots_pct"
    )


def _spines() -> Mapping[int, Sequence[str]]:
    return {
        1: domains.NA_EU_CENTRES,
        2: (domains.NA_EU_TOTAL,),
        3: domains.DISPLAY_BRANDS,
        4: domains.MARKETS,
        5: (domains.GLOBAL_TOTAL,),
    }


def dashboard(ots: DataFrame, params: ReportParams) -> DataFrame:
    """The same five blocks from one pass over the fact.

    Lines are summed by centre, brand and month first.  Each of those few rows is
    then repeated for the blocks it belongs to, and the blocks are summed together.
    """
    cells = (
        _rows(ots, False)
        .groupBy("DC_NAME", "ReportingBrand", MONTH)
        .agg(
            cond_sum("Units", ON_TIME, wide=True).alias("on_time"),
            cond_sum("Units", MEASURED, wide=True).alias("measured"),
        )
    )
    centre = F.col("DC_NAME")
    current = not_matching("ReportingBrand", RETIRED_BRAND)
    in_year = F.col(MONTH) <= params.fis_month
    na_eu, world = (
        centre.isin(*domains.NA_EU_CENTRES),
        centre.isin(*domains.GLOBAL_CENTRES),
    )

    def member(block: int, entity: Column, cond: Column) -> Column:
        return F.when(cond, F.struct(F.lit(block).alias("block"), entity.alias("entity")))

    memberships = F.array_compact(
        F.array(
            member(1, centre, current & in_year & na_eu),
            member(2, F.lit(domains.NA_EU_TOTAL), current & in_year & na_eu),
            member(3, _display_brand(), in_year),
            member(4, market(), F.lit(True)),
            member(5, F.lit(domains.GLOBAL_TOTAL), current & in_year & world),
        )
    )
    this_month = F.col(MONTH) == params.fis_month
    shares = (
        cells.select("*", F.inline(memberships))
        .groupBy("block", "entity")
        .agg(
            ratio(
                F.sum(F.when(this_month, F.col("on_time"))),
                F.sum(F.when(this_month, F.col("measured"))),
            ).alias("ots_pct"),
            ratio(F.sum("on_time"), F.sum("measured")).alias("ytd_ots_pct"),
        )
        .withColumn(MONTH, F.lit(params.fis_month))
    )
    rows = ", ".join(
        f"({b}, {i}, {sql_text(e)})"
        for b, listed in _spines().items()
        for i, e in enumerate(listed)
    )
    spine = ots.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS t(block, ordinal, entity)")
    out = spine.join(shares, ["block", "entity"], "left")
    # The two totals always carry the month, whether or not a line was found.
    total = F.col("block").isin(2, 5)
    return (
        out.withColumn(MONTH, F.when(total, F.lit(params.fis_month)).otherwise(F.col(MONTH)))
        .orderBy("block", "ordinal")
        .select("block", "entity", MONTH, "ots_pct", "ytd_ots_pct")
    )


def as_text(board: DataFrame) -> DataFrame:
    """The dashboard as published: shares as percent text, each column with its own digits."""
    texts = percent_texts(board, {"ots_pct": "__month", "ytd_ots_pct": "__ytd"})
    return texts.select("entity", MONTH, F.col("__month").alias("ots_pct"), F.col("__ytd").alias("ytd_ots_pct"))


def centre_by_month(ots: DataFrame) -> DataFrame:
    """Units and on-time share by month and centre, all months."""
    return _rows(ots, False).groupBy(MONTH, "DC_NAME").agg(
        on_time_ratio("strict").alias("ots_pct"),
        whole(plain_sum("Units", wide=True)).alias("raw_units"),
        whole(cond_sum("Units", MEASURED, "strict", wide=True)).alias("measured_units"),
        whole(cond_sum("Units", ON_TIME, "strict", wide=True)).alias("OnTimeUnits"),
        whole(cond_sum("Units", LATE, "strict", wide=True)).alias("LateUnits"),
    )

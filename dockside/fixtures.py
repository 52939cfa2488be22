"""The two fact views and the four dimensions, derived from the given tables.

Column expressions are SQL text that Spark and DuckDB both accept; the check SQL
uses the same text.  The Spark side joins only the tables that the wanted columns
read.  That is safe because every foreign key of ``lineitem`` and ``orders``
resolves to exactly one row (tested), so a join that adds no column changes nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .params import ReportParams
from .schemas import fields

# ---- fixed values: test parameters, schemas and expressions of the derived data ----

PARAMS = ReportParams(
    eow=48,
    fis_yr=2000,
    fis_month=11,
    snapshot=date(2001, 6, 30),
    period=(date(2000, 1, 1), date(2000, 12, 31)),
    month_pattern="DEC",
    min_units=500.0,
    unit_cap=40.0,
    focus_brand="ATHLETA",
    focus_vendor="Supplier#000000011",
)

TABLES = {
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_quantity double, l_returnflag string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey long, o_custkey long, o_orderpriority string",
    "part": "p_partkey long, p_brand string, p_type string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int",
    "customer": "c_custkey long, c_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}

SHIPPED = "CAST(l_shipdate AS DATE)"
STOCKED = f"({SHIPPED} + 20)"
SHIP_DAYS = "((l_partkey + 3 * l_suppkey + l_linenumber) % 24 - 12)"
STOCK_DAYS = f"({SHIP_DAYS} + l_linenumber % 3)"
CONTRACT = f"({SHIPPED} - CAST({SHIP_DAYS} AS INT))"
UNMEASURED = "(l_orderkey % 20 = 0)"
UNDETERMINED = "(l_partkey % 25 = 0)"
MONTH_NAMES = "'JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC'"
LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
BRAND = (
    "CASE CAST(substr(p_brand, 7) AS INT) % 11 WHEN 0 THEN 'GAP NA' WHEN 1 THEN 'BR NA' "
    "WHEN 2 THEN 'ON NA' WHEN 3 THEN 'GO NA' WHEN 4 THEN 'BRFS NA' WHEN 5 THEN 'GAP INTL' "
    "WHEN 6 THEN 'BR INTL' WHEN 7 THEN 'ON INTL' WHEN 8 THEN 'GO INTL' WHEN 9 THEN 'ATHLETA' "
    "ELSE 'Franchise EU' END"
)
CATEGORY = (
    "CASE p_type WHEN 'ECONOMY' THEN 'Wovens' WHEN 'SMALL' THEN 'Knits' "
    "WHEN 'MEDIUM' THEN 'Denim and Woven Bottoms' WHEN 'PROMO' THEN 'Sweaters' "
    "WHEN 'STANDARD' THEN 'IP' ELSE 'Accessories' END"
)
VENDOR = (
    "CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN s_suppkey % 50 = 7 "
    "THEN 'LIBERTY Distribution Co' WHEN s_suppkey % 50 = 8 THEN 'Dummy Vendor' "
    "ELSE s_name END"
)
MODE_CATEGORY = (
    "CASE WHEN o_orderpriority = '1-URGENT' THEN 'PrepaidAir' "
    "WHEN o_orderpriority = '2-HIGH' THEN 'CollectAir' ELSE 'Ocean' END"
)


def _week(day: str) -> str:
    return f"CAST(floor((dayofyear({day}) - 1) / 7.0) AS INT) + 1"


def _month_name(day: str) -> str:
    return f"substr({MONTH_NAMES}, 3 * month({day}) - 2, 3)"


SOT = {
    "NUMBER_SEQ": LINE_ID,
    "Data_Pulled": "DATE '2001-06-30'",
    "FISCAL_YEAR": f"CAST(year({SHIPPED}) AS INT)",
    "ShipCancelMonth": f"CAST(month({SHIPPED}) AS INT)",
    "ShipCancelWeek": _week(SHIPPED),
    "Fiscal_Month": _month_name(SHIPPED),
    "ReportingBrand": BRAND,
    "Category": CATEGORY,
    "Parent_Vendor": VENDOR,
    "CountryOfOrigin": "sn.n_name",
    "MetricShipDate": SHIPPED,
    "Units": "l_quantity",
    "Lateness": f"CASE WHEN {UNMEASURED} THEN 'Unmeasured' "
    f"WHEN {SHIP_DAYS} >= 1 THEN 'Late' ELSE 'OnTime' END",
    "DAYS_LATE": f"CASE WHEN {UNMEASURED} THEN NULL ELSE CAST({SHIP_DAYS} AS INT) END",
    "SHP_MODE_CATG_NM": MODE_CATEGORY,
    "SHIP_MODE_CD": "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'A' ELSE 'O' END",
    "SALES_TERMS_CODE": "CASE l_orderkey % 10 WHEN 5 THEN 'FCA' WHEN 6 THEN 'CFR' "
    "WHEN 7 THEN 'EXW' WHEN 8 THEN 'DDP' WHEN 9 THEN 'DDU' ELSE 'FOB' END",
    "ShipDateChoice": "CASE l_linenumber % 3 WHEN 0 THEN 'DCON' WHEN 1 THEN 'OC' ELSE 'LP' END",
    "Trade_Lane_Type": "CASE WHEN sn.n_regionkey = cn.n_regionkey THEN 'INTRA' ELSE 'INTER' END",
    "SHP_RSN_TYP_DESC": "CASE l_linenumber WHEN 1 THEN 'Port Congestion' "
    "WHEN 2 THEN 'Customs Hold' WHEN 3 THEN 'Carrier Delay' ELSE '-' END",
    "XFR_Point_Place": "concat('TP', sn.n_nationkey % 8)",
    "DC_GEO_LOC": "r_name",
    "Contract_Ship_Cancel": CONTRACT,
    "SHIP_CANCEL_DATE": f"CASE WHEN l_orderkey % 37 = 0 THEN NULL "
    f"ELSE {CONTRACT} + CAST(l_orderkey % 13 - 3 AS INT) END",
    "ACTUAL_ORIGIN_CONSOL_LCL_DATE": f"CASE WHEN l_partkey % 11 = 0 THEN NULL "
    f"ELSE {SHIPPED} - CAST(l_suppkey % 9 AS INT) END",
    "ACTUAL_LP_LCL_DATE": f"CASE WHEN l_partkey % 13 = 0 THEN NULL "
    f"ELSE {SHIPPED} + CAST(l_linenumber % 4 AS INT) END",
}

# The same lines with what real extracts hold: fractional and missing units, unknown and
# missing status, late lines without a day.  It tells the null modes apart.
SOT_ROUGH = SOT | {
    "Units": "CASE WHEN l_linenumber = 4 AND l_partkey % 10 = 3 THEN NULL ELSE l_quantity * 0.35 END",
    "Lateness": f"CASE WHEN l_orderkey % 29 = 0 THEN NULL WHEN l_orderkey % 31 = 0 "
    f"THEN 'Unmeasurable' ELSE {SOT['Lateness']} END",
    "DAYS_LATE": f"CASE WHEN l_orderkey % 17 = 0 THEN 0 ELSE {SOT['DAYS_LATE']} END",
}

# The same lines in units so small that a year's total passes 64 bits in ten-thousandths.
SOT_LARGE = SOT | {"Units": "l_quantity * 4000000000 + 0.25"}

OTS = {
    "NUMBER_SEQ": LINE_ID,
    "Data_Pulled": "DATE '2001-06-30'",
    "FISCAL_YEAR": f"CAST(year({STOCKED}) AS INT)",
    "Week": _week(STOCKED),
    "Month_Number": f"CAST(month({STOCKED}) AS INT)",
    "Fiscal_Month": _month_name(STOCKED),
    "ReportingBrand": BRAND,
    "Category": CATEGORY,
    "Parent_Vendor": VENDOR,
    "ORIGIN_COUNTRY_CODE": "sn.n_name",
    "DC_NAME": "dc",
    "DCCampus": "campus",
    "DestCtryCD": "ctry",
    "Units": "l_quantity",
    "Lateness": f"CASE WHEN {UNDETERMINED} THEN 'Undetermined' "
    f"WHEN {STOCK_DAYS} >= 1 THEN 'Late' ELSE 'OnTime' END",
    "Days_Late": f"CASE WHEN {UNDETERMINED} THEN NULL ELSE CAST({STOCK_DAYS} AS INT) END",
    "SHP_MODE_CATG_NM": MODE_CATEGORY,
}

# Returned lines never reach stock, so some shipped lines have no stocked line.
OTS_ROWS = "l_returnflag <> 'R'"

DC_MAP = (
    "(VALUES (0,'BDC','BRM','CA'), (1,'FDC','FRS','US'), (2,'NDC','NYK','US'), "
    "(3,'ODC','OHI','US'), (4,'PDC','PHX','US'), (5,'SCD','SOC','US'), (6,'SDC','STF','GB'), "
    "(7,'TDC','TEN','US'), (8,'GUK','RUG','GB'), (9,'CFC','BRM','CA'), (10,'OCC','OHI','US'), "
    "(11,'OFC','OHI','US'), (13,'PUC','PHX','US'), (14,'SHD','SHA','CN'), "
    "(15,'HK DC','HKG','HK'), (16,'JPD','JPN','JP'), (17,'JPF','JPN','JP')) "
    "m(idx, dc, campus, ctry)"
)

COUNTRY = (
    "SELECT n_name AS CTRY_CD, concat('Country ', n_nationkey) AS CTRY_DESC "
    "FROM {nation} WHERE n_nationkey <> 24"
)
PREFERRED_VENDOR = (
    "SELECT v.Category AS new_category, s_name AS vendor_name, s_suppkey AS vendor_id, "
    "'Preferred' AS category_status FROM {supplier} JOIN (VALUES (0,'Wovens'),(1,'Knits'),"
    "(2,'Denim and Woven Bottoms'),(3,'Sweaters'),(4,'IP'),(5,'Accessories')) v(k, Category) "
    "ON s_suppkey % 6 = k OR s_suppkey % 7 = k UNION ALL "
    "SELECT 'Wovens', s_name, s_suppkey + 100000, 'Preferred' FROM {supplier} "
    "WHERE s_suppkey = 6"
)
TRANSIT_PLAN = (
    "SELECT concat('TP', p) AS tp_place, r_name AS geo_description, "
    "CAST(3 + (p + r_regionkey) % 7 AS INT) AS days_before_ship_cancel "
    "FROM {region} CROSS JOIN (VALUES (0),(1),(2),(3),(4),(5),(6)) t(p)"
)
SHIP_CHOICE = (
    "SELECT m AS SHIP_MODE_CD, l AS Trade_Lane_Type, t AS SALES_TERMS_CODE, "
    "c AS ShipDateChoice, CASE WHEN c = 'OC' THEN 1 ELSE 2 END AS Ship_Choice_Status "
    "FROM (VALUES ('A'),('O')) a(m) CROSS JOIN (VALUES ('INTRA'),('INTER')) b(l) "
    "CROSS JOIN (VALUES ('FOB'),('FCA'),('CFR'),('EXW'),('DDP'),('CIF')) d(t) "
    "CROSS JOIN (VALUES ('DCON'),('OC'),('LP')) e(c)"
)

# The same three dimensions for the Spark side, which expands lists without joins.
VENDOR_CATEGORIES = (
    "Wovens", "Knits", "Denim and Woven Bottoms", "Sweaters", "IP", "Accessories",
)
ROUTE_VALUES = {
    "SHIP_MODE_CD": ("A", "O"),
    "Trade_Lane_Type": ("INTRA", "INTER"),
    "SALES_TERMS_CODE": ("FOB", "FCA", "CFR", "EXW", "DDP", "CIF"),
    "ShipDateChoice": ("DCON", "OC", "LP"),
}

# ---- end of fixed values ----

_USES = {
    "orders": re.compile(r"\bo_\w+"),
    "part": re.compile(r"\bp_\w+"),
    "supplier": re.compile(r"\bs_\w+|\bsn\."),
    "origin": re.compile(r"\bsn\."),
    "customer": re.compile(r"\bcn\.|\br_\w+|\bdc\b|\bcampus\b|\bctry\b"),
    "destination": re.compile(r"\bcn\.|\br_\w+"),
    "centre": re.compile(r"\bdc\b|\bcampus\b|\bctry\b"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table, with only the columns the views read (no schema inference job)."""
    return spark.read.schema(fields(TABLES[name])).parquet(f"{sf_dir}/{name}.parquet")


def _source(spark: SparkSession, sf_dir: str, exprs: Iterable[str], lines: DataFrame) -> DataFrame:
    """Join to ``lines`` the tables that the expressions read.

    Customer and destination are joined to orders first, so the much larger line
    table is shuffled for orders, part and supplier only.  Lines and orders both grow
    with the data, so neither is broadcast to the other.
    """
    text = " ".join(exprs)
    needs = {name for name, pattern in _USES.items() if pattern.search(text)}

    def t(name: str) -> DataFrame:
        return table(spark, sf_dir, name)

    out = lines
    if needs & {"orders", "customer"}:
        orders = t("orders")
        if "customer" in needs:
            orders = orders.join(t("customer"), F.expr("o_custkey = c_custkey"))
            if "destination" in needs:
                orders = orders.join(
                    t("nation").alias("cn"), F.expr("c_nationkey = cn.n_nationkey")
                ).join(t("region"), F.expr("cn.n_regionkey = r_regionkey"))
            if "centre" in needs:
                centres = spark.sql(f"SELECT * FROM {DC_MAP}")
                orders = orders.join(centres, F.expr("c_nationkey % 20 = idx"), "left")
            orders = orders.hint("merge")
        out = out.join(orders, F.expr("l_orderkey = o_orderkey"))
    if "part" in needs:
        out = out.join(t("part"), F.expr("l_partkey = p_partkey"))
    if "supplier" in needs:
        out = out.join(t("supplier"), F.expr("l_suppkey = s_suppkey"))
        if "origin" in needs:
            out = out.join(t("nation").alias("sn"), F.expr("s_nationkey = sn.n_nationkey"))
    return out


def _view(
    spark: SparkSession,
    sf_dir: str,
    exprs: Mapping[str, str],
    columns: Iterable[str] | None,
    lines: DataFrame,
) -> DataFrame:
    chosen = {c: exprs[c] for c in (columns or exprs)}
    source = _source(spark, sf_dir, chosen.values(), lines)
    return source.selectExpr(*(f"{e} AS {c}" for c, e in chosen.items()))


def sot(
    spark: SparkSession,
    sf_dir: str,
    columns: Iterable[str] | None = None,
    year: int | None = None,
) -> DataFrame:
    """Shipped lines; ``year`` skips row groups that hold no line of that fiscal year."""
    lines = table(spark, sf_dir, "lineitem")
    if year:
        lines = lines.where(_in_year("l_shipdate", year))
    return _view(spark, sf_dir, SOT, columns, lines)


def sot_rough(
    spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None
) -> DataFrame:
    """Shipped lines with fractional and missing values."""
    return _view(spark, sf_dir, SOT_ROUGH, columns, table(spark, sf_dir, "lineitem"))


def sot_large(
    spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None
) -> DataFrame:
    """Shipped lines with very many units."""
    return _view(spark, sf_dir, SOT_LARGE, columns, table(spark, sf_dir, "lineitem"))


def ots(
    spark: SparkSession,
    sf_dir: str,
    columns: Iterable[str] | None = None,
    year: int | None = None,
) -> DataFrame:
    """Stocked lines; stock dates lie twenty days after shipment."""
    lines = table(spark, sf_dir, "lineitem").where(OTS_ROWS)
    if year:
        lines = lines.where(_in_year("l_shipdate", year, shift=20))
    return _view(spark, sf_dir, OTS, columns, lines)


def _in_year(col: str, year: int, shift: int = 0) -> str:
    """A range on the stored column, which the parquet reader checks per row group."""
    start = f"TIMESTAMP_NTZ '{year}-01-01 00:00:00' - INTERVAL '{shift}' DAY"
    stop = f"TIMESTAMP_NTZ '{year + 1}-01-01 00:00:00' - INTERVAL '{shift}' DAY"
    return f"{col} >= {start} AND {col} < {stop}"


def country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(COUNTRY, nation=table(spark, sf_dir, "nation"))


def preferred_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listed categories of each vendor, expanded in place."""
    pairs = F.posexplode(F.array(*(F.lit(c) for c in VENDOR_CATEGORIES)))
    vendors = table(spark, sf_dir, "supplier")
    columns = ("new_category", "vendor_name", "vendor_id", "category_status")
    listed = (
        vendors.select("*", pairs.alias("k", "category"))
        .where("s_suppkey % 6 = k OR s_suppkey % 7 = k")
        .select("category", "s_name", "s_suppkey", F.lit("Preferred"))
    )
    twice = vendors.where("s_suppkey = 6").selectExpr(
        "'Wovens'", "s_name", "s_suppkey + 100000", "'Preferred'"
    )
    return listed.union(twice).toDF(*columns)


def transit_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.explode(F.sequence(F.lit(0), F.lit(6)))
    return (
        table(spark, sf_dir, "region")
        .select("*", place.alias("p"))
        .selectExpr(
            "concat('TP', p) AS tp_place",
            "r_name AS geo_description",
            "CAST(3 + (p + r_regionkey) % 7 AS INT) AS days_before_ship_cancel",
        )
    )


def ship_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed rule matrix; it does not grow with the data."""
    rules = spark.range(1)
    for name, values in ROUTE_VALUES.items():
        rules = rules.select("*", F.explode(F.array(*(F.lit(v) for v in values))).alias(name))
    status = F.when(F.col("ShipDateChoice") == "OC", 1).otherwise(2)
    return rules.select(*ROUTE_VALUES, status.alias("Ship_Choice_Status"))


def check_ctes() -> dict[str, str]:
    """The same views as CTE bodies for the check SQL, with every table joined."""
    joined = (
        "lineitem JOIN orders ON l_orderkey = o_orderkey "
        "JOIN part ON l_partkey = p_partkey "
        "JOIN supplier ON l_suppkey = s_suppkey "
        "JOIN customer ON o_custkey = c_custkey "
        "JOIN nation sn ON s_nationkey = sn.n_nationkey "
        "JOIN nation cn ON c_nationkey = cn.n_nationkey "
        "JOIN region ON cn.n_regionkey = r_regionkey"
    )

    def body(exprs: Mapping[str, str]) -> str:
        return ", ".join(f"{e} AS {c}" for c, e in exprs.items())

    plain = {"nation": "nation", "supplier": "supplier", "region": "region"}
    return {
        "sot": f"SELECT {body(SOT)} FROM {joined}",
        "sot_rough": f"SELECT {body(SOT_ROUGH)} FROM {joined}",
        "sot_large": f"SELECT {body(SOT_LARGE)} FROM {joined}",
        "ots": f"SELECT {body(OTS)} FROM {joined} "
        f"LEFT JOIN {DC_MAP} ON c_nationkey % 20 = idx WHERE {OTS_ROWS}",
        "country": COUNTRY.format(**plain),
        "preferred_vendor": PREFERRED_VENDOR.format(**plain),
        "ttp": TRANSIT_PLAN.format(**plain),
        "ship_choice": SHIP_CHOICE,
    }

"""Check SQL: every query again, as plain SQL over the given tables.

Written from the report definitions, not from the DataFrame plans.  Only the derived
fact and dimension views share their column expressions with :mod:`dockside.fixtures`.
"""

from __future__ import annotations

from .fixtures import check_ctes
from .plans import domains

CHECKS: dict[str, str] = {}

# The test parameters.
YEAR, WEEK, MONTH = 2000, 48, 11
PERIOD = "DATE '2000-01-01' AND DATE '2000-12-31'"
VENDOR = "'Supplier#000000011'"
BRAND = "'ATHLETA'"

_NO_FRANCHISE = "coalesce(NOT regexp_matches(ReportingBrand, 'franchise', 'i'), true)"
_NO_RETIRED = "coalesce(NOT regexp_matches(ReportingBrand, 'piperlime', 'i'), true)"
_VENDORS = (
    "coalesce(NOT regexp_matches(Parent_Vendor, 'liberty distribution', 'i'), true) "
    "AND coalesce(NOT regexp_matches(Parent_Vendor, 'dummy', 'i'), true)"
)
_CENTRES = "coalesce(NOT regexp_matches(DC_NAME, 'jpf', 'i'), true)"
_SOT_N = (
    f"SELECT * FROM sot WHERE ShipCancelWeek <= {WEEK} AND {_VENDORS} "
    "AND MetricShipDate <= (SELECT max(Data_Pulled) FROM sot)"
)
_OTS_N = f"SELECT * FROM ots WHERE Week <= {WEEK} AND {_VENDORS} AND {_CENTRES}"


def _listing(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _domain(values, name: str) -> str:
    return "(VALUES " + ", ".join(f"({_listing([v])})" for v in values) + f") spine({name})"


def _floor(expr: str) -> str:
    return f"CAST(floor({expr}) AS BIGINT)"


def _sum(cond: str, value: str = "Units") -> str:
    return f"coalesce(sum({value}) FILTER (WHERE {cond}), 0)"


_LATE = "Lateness = 'Late'"
_ON_TIME = "Lateness = 'OnTime'"
_AIR = "SHP_MODE_CATG_NM = 'PrepaidAir'"


def _sot_raw(times: str = "") -> dict[str, str]:
    days = "Units * DAYS_LATE"
    return {
        "SOTUnits": "sum(Units)",
        "SOTOnTimeUnits": _sum(_ON_TIME),
        "SOTLateUnits": _sum(_LATE),
        "SOTLate5daysUnits": _sum(f"{_LATE} AND DAYS_LATE > 5"),
        "WTSOTLateUnits": _sum(f"{_LATE} AND DAYS_LATE >= 1", days),
        "PPAUnits": _sum(_AIR),
        "PPASOTLateUnits": _sum(f"{_AIR} AND {_LATE}"),
        "PPASOT5daysLateUnits": _sum(f"{_AIR} AND {_LATE} AND DAYS_LATE > 5"),
        "WTPPASOTLateUnits": _sum(f"{_AIR} AND {_LATE} AND DAYS_LATE >= 1", days),
    }


def _ots_raw() -> dict[str, str]:
    return {
        "OTSUnits": "sum(Units)",
        "OTSOnTimeUnits": _sum(_ON_TIME),
        "OTSLateUnits": _sum(_LATE),
        "OTSLate5daysUnits": _sum(f"{_LATE} AND Days_Late > 5"),
        "WTOTSLateUnits": _sum(f"{_LATE} AND Days_Late >= 1", "Units * Days_Late"),
        "PPAOTSLateUnits": _sum(f"{_AIR} AND {_LATE}"),
        "PPAOTSUnits": _sum(_AIR),
    }


def _measures(raw: dict[str, str], skip=(), unfloored=()) -> str:
    return ", ".join(
        f"{e if n in unfloored else _floor(e)} AS {n}" for n, e in raw.items() if n not in skip
    )


_BOTH = (
    "SOTUnits, SOTOnTimeUnits, SOTLateUnits, SOTLate5daysUnits, WTSOTLateUnits, OTSUnits, "
    "OTSOnTimeUnits, OTSLateUnits, OTSLate5daysUnits, WTOTSLateUnits, PPAUnits, "
    "PPASOTLateUnits, PPAOTSLateUnits, PPASOT5daysLateUnits, WTPPASOTLateUnits"
)

# ---- named parts, added to a query when its text mentions them ----

_PARTS = dict(check_ctes())
_PARTS |= {
    "sot_n": _SOT_N,
    "ots_n": _OTS_N,
    "sot_c": f"SELECT * FROM sot_n WHERE FISCAL_YEAR = {YEAR} AND {_NO_FRANCHISE}",
    "ots_c": f"SELECT * FROM ots_n WHERE DC_NAME IS NOT NULL AND {_NO_FRANCHISE}",
    # The combined tables compare with one shipped year.
    "ots_y": f"SELECT * FROM ots_c WHERE FISCAL_YEAR = {YEAR}",
}


def _country_list(fact: str) -> str:
    return (
        f"SELECT CountryOfOrigin, CTRY_DESC, {_floor('sum(Units)')} AS units_by_country "
        f"FROM {fact} LEFT JOIN country ON CountryOfOrigin = CTRY_CD GROUP BY 1, 2 "
        "ORDER BY 3 DESC, 1 NULLS LAST, 2 NULLS LAST LIMIT 20"
    )


def _vendor_list(fact: str) -> str:
    return (
        f"SELECT Parent_Vendor, {_floor('sum(Units)')} AS units_by_vendor "
        f"FROM {fact} GROUP BY 1 ORDER BY 2 DESC, 1 NULLS LAST LIMIT 50"
    )


_PARTS |= {
    "top_country": _country_list("sot_c"),
    "top_country_n": _country_list("sot"),
    "top_vendor": _vendor_list("sot_c"),
    "top_vendor_n": _vendor_list("sot"),
}

_LATE_FOB = "Lateness = 'Late' AND SALES_TERMS_CODE = 'FOB' AND SHIP_MODE_CD = 'O'"
_OVERDUE = "ACTUAL_ORIGIN_CONSOL_LCL_DATE > Contract_Ship_Cancel + 2"
_PARTS["days"] = (
    "SELECT s.*, t.days_before_ship_cancel, "
    "Contract_Ship_Cancel - t.days_before_ship_cancel AS planned_oc, "
    "CAST(ACTUAL_ORIGIN_CONSOL_LCL_DATE - "
    "(Contract_Ship_Cancel - t.days_before_ship_cancel) AS INT) AS days_late_to_oc, "
    "CAST(SHIP_CANCEL_DATE - Contract_Ship_Cancel AS INT) AS days_anticipated_vs_contract, "
    "CAST(ACTUAL_LP_LCL_DATE - SHIP_CANCEL_DATE AS INT) AS lp_vs_anticipated "
    "FROM sot_c s LEFT JOIN ttp t ON XFR_Point_Place = tp_place AND DC_GEO_LOC = geo_description"
)
_PARTS["tested"] = f"""
SELECT *,
  CASE WHEN NOT ({_LATE_FOB}) THEN 'Not Tested'
       WHEN SHIP_CANCEL_DATE <= Contract_Ship_Cancel + 6 THEN 'Transportation'
       WHEN SHIP_CANCEL_DATE >= Contract_Ship_Cancel + 7 THEN 'Vendor'
       WHEN ACTUAL_ORIGIN_CONSOL_LCL_DATE > planned_oc THEN 'Vendor'
       WHEN ACTUAL_ORIGIN_CONSOL_LCL_DATE <= planned_oc THEN 'Transportation'
       ELSE 'NA' END AS failure0,
  CASE WHEN NOT ({_LATE_FOB}) THEN 'Not Tested'
       WHEN SHIP_CANCEL_DATE >= Contract_Ship_Cancel
        AND SHIP_CANCEL_DATE <= Contract_Ship_Cancel + 6 THEN 'Test1'
       WHEN SHIP_CANCEL_DATE >= Contract_Ship_Cancel + 7 THEN 'Test2'
       WHEN ACTUAL_ORIGIN_CONSOL_LCL_DATE > planned_oc THEN 'Test3'
       WHEN ACTUAL_ORIGIN_CONSOL_LCL_DATE <= planned_oc THEN 'Test3'
       ELSE 'NA' END AS reason0,
  CASE WHEN NOT ({_LATE_FOB} AND ACTUAL_ORIGIN_CONSOL_LCL_DATE IS NOT NULL) THEN 'Not Tested'
       WHEN ACTUAL_ORIGIN_CONSOL_LCL_DATE > planned_oc THEN 'Vendor'
       WHEN ACTUAL_ORIGIN_CONSOL_LCL_DATE > planned_oc AND DAYS_LATE >= days_late_to_oc THEN 'Trans'
       WHEN ACTUAL_ORIGIN_CONSOL_LCL_DATE <= planned_oc AND DAYS_LATE > days_late_to_oc THEN 'Trans'
       WHEN DAYS_LATE - days_late_to_oc = 0 THEN 'Vendor'
       ELSE 'NA' END AS test0
FROM days
"""


def _overridden(base: str, label: str | None) -> str:
    """Late lines under deciding terms; an unknown date under dated terms gives null."""
    dated = (("FCA", "O", "FCA Ocean"), ("FOB", "A", "FOB AIR"), ("CFR", "A", "CFR AIR"))
    plain = (
        ("EXW", "true", "EXW"),
        ("DDP", "ShipDateChoice = 'DCON'", "DDP DCON"),
        ("DDU", "ShipDateChoice = 'OC'", "DDU OC"),
    )
    arms = []
    for terms, mode, name in dated:
        here = f"Lateness = 'Late' AND SALES_TERMS_CODE = '{terms}' AND SHIP_MODE_CD = '{mode}'"
        arms.append(f"WHEN {here} AND ACTUAL_ORIGIN_CONSOL_LCL_DATE IS NULL THEN NULL")
        arms.append(f"WHEN {here} AND {_OVERDUE} THEN '{label or name}'")
    for terms, cond, name in plain:
        arms.append(
            f"WHEN Lateness = 'Late' AND SALES_TERMS_CODE = '{terms}' AND {cond} "
            f"THEN '{label or name}'"
        )
    return f"CASE {' '.join(arms)} ELSE {base} END"


_PARTS["classified"] = (
    "SELECT * EXCLUDE (failure0, reason0, test0), "
    "failure0 = test0 AS is_match, "
    f"{_overridden('failure0', 'Vendor')} AS probable_failure, "
    f"{_overridden('reason0', None)} AS sub_reason, "
    f"{_overridden('test0', 'Vendor')} AS test_by_oc FROM tested"
)
_PARTS["leaders"] = (
    "SELECT Category, Parent_Vendor, total_units FROM (SELECT *, rank() OVER "
    "(PARTITION BY Category ORDER BY total_units DESC) AS place FROM (SELECT Category, "
    "Parent_Vendor, sum(Units) AS total_units FROM sot_c "
    f"WHERE FISCAL_YEAR = {YEAR} AND {_NO_FRANCHISE} GROUP BY 1, 2)) WHERE place <= 15"
)
_PARTS["choices"] = (
    "SELECT g.ReportingBrand, g.Contract_Ship_Cancel, r.SHIP_MODE_CD, r.Trade_Lane_Type, "
    "r.SALES_TERMS_CODE, r.ShipDateChoice, g.SHP_RSN_TYP_DESC, g.Lateness, g.vendor_units, "
    "r.Ship_Choice_Status, CASE WHEN g.SHP_RSN_TYP_DESC <> '-' THEN 'Delay Reason' "
    "WHEN g.SHP_RSN_TYP_DESC = '-' THEN '' END AS delay_label "
    "FROM ship_choice r LEFT JOIN (SELECT ReportingBrand, Contract_Ship_Cancel, SHIP_MODE_CD, "
    "Trade_Lane_Type, SALES_TERMS_CODE, ShipDateChoice, SHP_RSN_TYP_DESC, Lateness, "
    "sum(Units) AS vendor_units FROM sot_c GROUP BY ALL) g "
    "ON r.SHIP_MODE_CD = g.SHIP_MODE_CD AND r.Trade_Lane_Type = g.Trade_Lane_Type "
    "AND r.SALES_TERMS_CODE = g.SALES_TERMS_CODE AND r.ShipDateChoice = g.ShipDateChoice"
)


def _mentions(text: str, name: str) -> bool:
    words = text.replace("(", " ").replace(")", " ").replace(",", " ").replace(".", " ").split()
    return any(a in ("FROM", "JOIN") and b == name for a, b in zip(words, words[1:], strict=False))


def check(name: str, body: str) -> None:
    """Register a query with the parts it needs, in dependency order."""
    needed: set[str] = set()
    texts = [body]
    while texts:
        text = texts.pop()
        for part, sql in _PARTS.items():
            if part not in needed and _mentions(text, part):
                needed.add(part)
                texts.append(sql)
    parts = [f"{p} AS ({sql})" for p, sql in _PARTS.items() if p in needed]
    CHECKS[name] = ("WITH " + ", ".join(parts) + " " if parts else "") + body


# ---- sources, sinks and single operators ----

check("s01_shipped_lines", "SELECT * FROM sot")
check("s01_stocked_lines", "SELECT * FROM ots")
check(
    "s03_snapshot",
    "SELECT FISCAL_YEAR, ShipCancelMonth, Lateness, count(*) AS n, sum(Units) AS units "
    "FROM sot GROUP BY ALL",
)
check(
    "s03_failed_save",
    "SELECT FISCAL_YEAR, ShipCancelMonth, Lateness, count(*) AS n, sum(Units) AS units "
    f"FROM sot WHERE FISCAL_YEAR >= {YEAR - 2} GROUP BY ALL",
)
check("s01_equal_cuts", "SELECT 8 AS ranges, true AS even, count(*) AS lines FROM sot")
check(
    "w04_run_checks",
    "SELECT 'sot' AS fact, min(Data_Pulled) AS first, max(Data_Pulled) AS last, count(*) AS lines FROM sot_c "
    "UNION ALL SELECT 'ots', min(Data_Pulled), max(Data_Pulled), count(*) FROM ots_c",
)
check(
    "s06_bad_rows",
    "SELECT CASE WHEN vendor_id % 10 = 3 THEN 'bad' ELSE 'good' END AS kind, "
    "concat_ws(',', new_category, vendor_name, CASE WHEN vendor_id % 10 = 3 THEN concat('x', vendor_id) "
    "ELSE CAST(vendor_id AS VARCHAR) END, category_status) AS line FROM preferred_vendor",
)
check(
    "s04_quoted_csv",
    "SELECT new_category, vendor_name || ', \"Ltd\"' AS vendor_name, vendor_id, category_status "
    "FROM preferred_vendor",
)
check(
    "s05_caret_file",
    "SELECT CASE CTRY_CD WHEN 'NATION_3' THEN 'NA' ELSE CTRY_CD END AS CTRY_CD, CTRY_DESC "
    "FROM country",
)
check(
    "s08_sheet_as_csv",
    "SELECT s.*, days_before_ship_cancel FROM (SELECT XFR_Point_Place, DC_GEO_LOC, "
    "sum(Units) AS units FROM sot GROUP BY ALL) s LEFT JOIN ttp "
    "ON XFR_Point_Place = tp_place AND DC_GEO_LOC = geo_description",
)
check(
    "p09_country_relabel",
    "SELECT CASE DestCtryCD WHEN 'CA' THEN 'Canada' END AS country, count(*) AS n, "
    "sum(Units) AS units FROM ots GROUP BY ALL",
)
check(
    "p14_vendor_levels",
    "SELECT DISTINCT Parent_Vendor FROM sot WHERE Parent_Vendor IS NOT NULL",
)
check(
    "p14_sixth_vendor",
    "SELECT Parent_Vendor FROM (SELECT DISTINCT Parent_Vendor FROM sot "
    "WHERE Parent_Vendor IS NOT NULL) ORDER BY 1 LIMIT 1 OFFSET 5",
)
check("w03_first_lines", "SELECT * FROM sot ORDER BY NUMBER_SEQ LIMIT 6")
check(
    "w04_snapshot_dates",
    "SELECT 'SOT' AS fact, max(Data_Pulled) AS pulled, count(DISTINCT Data_Pulled) AS dates "
    "FROM sot UNION ALL SELECT 'OTS', max(Data_Pulled), count(DISTINCT Data_Pulled) FROM ots",
)
check(
    "x05_thousands",
    "SELECT ReportingBrand, format('{:,}', CAST(sum(Units) AS BIGINT)) AS units_text "
    "FROM sot_c GROUP BY 1",
)

# ---- cleaning and lists ----

check("r01n_clean_ots", _OTS_N)
check("r02n_clean_sot", _SOT_N)
check("r01_clean_ots", f"{_OTS_N} AND DC_NAME IS NOT NULL AND {_NO_FRANCHISE}")
check("r02_clean_sot", "SELECT * FROM sot_c")
check("r03_top_countries", "SELECT * FROM top_country")
check("r04_top_vendors", "SELECT * FROM top_vendor")
check("r03n_top_countries", "SELECT * FROM top_country_n")
check("r04n_top_vendors", "SELECT * FROM top_vendor_n")

# ---- monthly measures ----


def _sot_by(keys: str, fact: str = "sot_c") -> str:
    lead = f"ShipCancelMonth, {keys}" if keys else "ShipCancelMonth"
    return f"SELECT {lead}, {_measures(_sot_raw())} FROM {fact} GROUP BY {lead}"


def _ots_by(keys: str, fact: str = "ots_c", skip=(), unfloored=()) -> str:
    lead = f"Month_Number, {keys}" if keys else "Month_Number"
    return f"SELECT {lead}, {_measures(_ots_raw(), skip, unfloored)} FROM {fact} GROUP BY {lead}"


_LEVELS = {
    "brand_category": "ReportingBrand, Category",
    "brand": "ReportingBrand",
    "category": "Category",
    "company": "",
}
for _number, (_level, _keys) in enumerate(_LEVELS.items()):
    _total = ("OTSUnits",) if _level == "company" else ()
    check(f"r{5 + _number:02d}_sot_{_level}", _sot_by(_keys))
    check(f"r{9 + _number:02d}_ots_{_level}", _ots_by(_keys, unfloored=_total))
    for _tag, _sot, _ots, _skip in (
        ("", "sot_c", "ots_y", ()),
        ("n", "sot_n", "ots_n", ("PPAOTSUnits",)),
    ):
        _lead = f"ShipCancelMonth, {_keys}" if _keys else "ShipCancelMonth"
        _on = " AND ".join(
            ["a.ShipCancelMonth = b.Month_Number"]
            + [f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in _keys.split(", ") if k]
        )
        _own = ", ".join("a." + c for c in _lead.split(", "))
        check(
            f"r{15 + _number}{_tag}_{_level}_combined",
            f"SELECT {_own}, {_BOTH}{'' if _skip else ', PPAOTSUnits'} "
            f"FROM ({_sot_by(_keys, _sot)}) a "
            f"LEFT JOIN ({_ots_by(_keys, _ots, _skip, _total)}) b ON {_on}",
        )
CHECKS["s09_report_file"] = CHECKS["r16_brand_combined"]


def _all_levels(by, month: str, names: list[str], double: tuple[str, ...] = ()) -> str:
    arms = []
    for level, keys in _LEVELS.items():
        brand = "ReportingBrand" if "ReportingBrand" in keys else "CAST(NULL AS VARCHAR)"
        category = "Category" if "Category" in keys else "CAST(NULL AS VARCHAR)"
        shown = ", ".join(f"CAST({n} AS DOUBLE) AS {n}" if n in double else n for n in names)
        arms.append(
            f"SELECT '{level}' AS level, {month}, {brand} AS ReportingBrand, "
            f"{category} AS Category, {shown} FROM ({by(keys)})"
        )
    return " UNION ALL ".join(arms)


check("r05_r08_sot_levels", _all_levels(_sot_by, "ShipCancelMonth", list(_sot_raw())))
check(
    "r09_r12_ots_levels",
    _all_levels(
        lambda k: _ots_by(k, unfloored=() if k else ("OTSUnits",)),
        "Month_Number",
        list(_ots_raw()),
        ("OTSUnits",),
    ),
)

# ---- measures of fractional and missing values ----

_ROUGH_KEYS = "Parent_Vendor, FISCAL_YEAR, ShipCancelMonth"
_EXACT = "CAST(Units AS DECIMAL(18, 4))"


def _mode(cond: str, nulls: str) -> str:
    total = f"CAST({_sum(cond, _EXACT)} AS DOUBLE)"
    bad = {
        "lenient": "false",
        "strict": f"({cond}) IS NULL OR (({cond}) AND Units IS NULL)",
        "subset": f"coalesce({cond}, false) AND Units IS NULL",
    }[nulls]
    return f"CASE WHEN coalesce(bool_or({bad}), false) THEN NULL ELSE {total} END"


for _name, _nulls in (("a01_strict", "strict"), ("a02_lenient", "lenient"), ("a03_subset", "subset")):
    check(
        f"{_name}_sums",
        f"SELECT {_ROUGH_KEYS}, {_mode(_ON_TIME, _nulls)} AS on_time, {_mode(_LATE, _nulls)} AS late, "
        f"{_mode('true', _nulls)} AS all_units FROM sot_rough GROUP BY ALL",
    )
check(
    "a04_mixed_impact",
    f"SELECT {_ROUGH_KEYS}, {_mode(_ON_TIME, 'lenient')} AS on_time, "
    f"""{_mode("Lateness <> 'Unmeasured'", 'subset')} AS measured FROM sot_rough GROUP BY ALL""",
)
_exact_raw = {n: e.replace("Units", _EXACT) for n, e in _sot_raw().items()}
_large = {n: e.replace("Units", "CAST(Units AS DECIMAL(28, 4))") for n, e in _sot_raw().items()}
check(
    "a05_large_totals",
    f"SELECT FISCAL_YEAR, {_measures(_large)} FROM sot_large GROUP BY ROLLUP (FISCAL_YEAR)",
)
check(
    "x01_floor",
    f"SELECT ShipCancelMonth, {_measures(_exact_raw)} FROM sot_rough "
    "WHERE Units IS NOT NULL AND Lateness IS NOT NULL GROUP BY 1",
)
check(
    "m05_weighted",
    f"SELECT {_ROUGH_KEYS}, {_measures(_exact_raw, skip=('SOTUnits',))} FROM sot_rough GROUP BY ALL",
)
check(
    "j06_any_status",
    "SELECT o.Month_Number, o.Lateness AS StockedOnTime, s.Lateness AS ShippedOnTime, "
    f"{_floor('sum(o.Units)')} AS SumOfUnits FROM ots_c o JOIN sot_rough s "
    "ON o.NUMBER_SEQ = s.NUMBER_SEQ WHERE o.Lateness <> 'Undetermined' "
    "AND s.Lateness <> 'Unmeasured' GROUP BY 1, 2, 3",
)
check(
    "p15_random_rows",
    f"SELECT * FROM ({_sot_by('ReportingBrand, Category')}) ORDER BY "
    "md5(concat_ws('|', '7', ShipCancelMonth, ReportingBrand, Category)) LIMIT 10",
)

# ---- preferred vendors ----

_PREFERRED = "ON Category = new_category AND Parent_Vendor = vendor_name"


def _preferred(fact: str, raw: dict[str, str], month: str, skip=()) -> str:
    return (
        f"SELECT Category, Parent_Vendor, {month}, {_measures(raw, skip)} "
        f"FROM {fact} JOIN preferred_vendor {_PREFERRED} GROUP BY 1, 2, 3"
    )


check("r13_sot_preferred", _preferred("sot_c", _sot_raw(), "ShipCancelMonth"))
check("r14_ots_preferred", _preferred("ots_c", _ots_raw(), "Month_Number"))
check(
    "j02_sot_preferred_once",
    f"SELECT Category, Parent_Vendor, ShipCancelMonth, {_measures(_sot_raw())} FROM sot_c "
    "WHERE EXISTS (SELECT 1 FROM preferred_vendor WHERE Category = new_category "
    "AND Parent_Vendor = vendor_name) GROUP BY 1, 2, 3",
)
for _tag, _sot, _ots, _skip in (
    ("", "sot_c", "ots_y", ()),
    ("n", "sot_n", "ots_n", ("PPAOTSUnits",)),
):
    check(
        f"r19{_tag}_preferred_combined",
        f"SELECT a.Category, a.Parent_Vendor, a.ShipCancelMonth, {_BOTH}"
        f"{'' if _skip else ', PPAOTSUnits'} "
        f"FROM ({_preferred(_sot, _sot_raw(), 'ShipCancelMonth')}) a "
        f"LEFT JOIN ({_preferred(_ots, _ots_raw(), 'Month_Number', _skip)}) b "
        "ON a.Category = b.Category AND a.Parent_Vendor = b.Parent_Vendor "
        "AND a.ShipCancelMonth = b.Month_Number",
    )
_zeroed = _BOTH.split(", ") + ["PPAOTSUnits"]
check(
    "s10_null_token",
    "SELECT a.Category, a.Parent_Vendor, a.ShipCancelMonth, "
    + ", ".join(f"coalesce({c}, 0) AS {c}" for c in _zeroed)
    + f" FROM ({_preferred('sot_c', _sot_raw(), 'ShipCancelMonth')}) a "
    f"LEFT JOIN ({_preferred('ots_y', _ots_raw(), 'Month_Number')}) b "
    "ON a.Category = b.Category AND a.Parent_Vendor = b.Parent_Vendor "
    "AND a.ShipCancelMonth = b.Month_Number",
)

# ---- centres, top lists, cross-table, rankings ----

_MEASURED = "Lateness IN ('OnTime', 'Late')"
_SHARE = f"round({_sum(_ON_TIME)} / nullif({_sum(_MEASURED)}, 0), 6)"
for _tag, _ots, _share in (
    ("", "ots_c", _SHARE),
    ("n", "ots_n", f"round({_sum(_ON_TIME)} / nullif(sum(Units), 0), 6)"),
):
    check(
        f"r20{_tag}_ots_by_centre",
        f"SELECT Fiscal_Month, Month_Number, {_floor(_sum(_ON_TIME))} AS OnTimeUnits, "
        f"{_floor('sum(Units)')} AS total_units, DCCampus, DC_NAME, DestCtryCD, "
        f"{_share} AS ots_pct, {_floor(_sum(f'{_LATE} AND Days_Late > 5'))} AS OTSLate5daysUnits, "
        f"{_floor(_sum(f'{_LATE} AND Days_Late >= 1', 'Units * Days_Late'))} AS WTOTSLateUnits, "
        f"{_floor(_sum(_LATE))} AS LateUnits FROM {_ots} "
        "GROUP BY Fiscal_Month, Month_Number, DCCampus, DC_NAME, DestCtryCD",
    )


def _listed_sot(listed: str, key: str, fact: str) -> str:
    return (
        f"SELECT ShipCancelMonth, {_measures(_sot_raw())} FROM {fact} f "
        f"JOIN {listed} t ON f.{key} IS NOT DISTINCT FROM t.{key} GROUP BY 1"
    )


def _listed_ots(listed: str, key: str, own: str, fact: str, skip=()) -> str:
    return (
        f"SELECT Month_Number, {_measures(_ots_raw(), skip, ('OTSUnits',))} FROM {fact} f "
        f"JOIN {listed} t ON f.{own} IS NOT DISTINCT FROM t.{key} GROUP BY 1"
    )


check("r21_country_sot", _listed_sot("top_country", "CountryOfOrigin", "sot_c"))
check(
    "r22_country_ots",
    _listed_ots("top_country", "CountryOfOrigin", "ORIGIN_COUNTRY_CODE", "ots_c"),
)
check("r24_vendor_sot", _listed_sot("top_vendor", "Parent_Vendor", "sot_c"))
check("r25_vendor_ots", _listed_ots("top_vendor", "Parent_Vendor", "Parent_Vendor", "ots_c"))
for _tag, _sot, _ots, _skip in (
    ("", "sot_c", "ots_y", ()),
    ("n", "sot_n", "ots_n", ("PPAOTSUnits",)),
):
    _suffix = "_n" if _tag else ""
    for _name, _list, _key, _own, _how in (
        ("r23{}_country_combined", "top_country", "CountryOfOrigin", "ORIGIN_COUNTRY_CODE", ""),
        ("r26{}_vendor_combined", "top_vendor", "Parent_Vendor", "Parent_Vendor", "LEFT "),
    ):
        check(
            _name.format(_tag),
            f"SELECT a.ShipCancelMonth, {_BOTH}{'' if _skip else ', PPAOTSUnits'} "
            f"FROM ({_listed_sot(_list + _suffix, _key, _sot)}) a {_how}JOIN "
            f"({_listed_ots(_list + _suffix, _key, _own, _ots, _skip)}) b "
            "ON a.ShipCancelMonth = b.Month_Number",
        )
check(
    "r27_stocked_vs_shipped",
    "SELECT o.Month_Number, o.Lateness AS StockedOnTime, s.Lateness AS ShippedOnTime, "
    f"{_floor('sum(o.Units)')} AS SumOfUnits FROM ots_y o JOIN sot_c s "
    "ON o.NUMBER_SEQ = s.NUMBER_SEQ WHERE o.Lateness <> 'Undetermined' "
    "AND s.Lateness <> 'Unmeasured' GROUP BY 1, 2, 3",
)
CHECKS["j06_bucketed_lines"] = CHECKS["r27_stocked_vs_shipped"]
for _tag, _sot in (("", "sot_c"), ("n", "sot_n")):
    for _name, _key in (
        ("r28{}_brand_delays", "ReportingBrand"),
        ("r29{}_category_delays", "Category"),
    ):
        _raw = _sot_raw()
        _shown = {
            "SOTUnits": _raw["SOTUnits"],
            "AdjustedSOTUnits": f"{_sum(_ON_TIME)} + {_sum(_LATE)}",
            **{
                n: _raw[n]
                for n in ("SOTOnTimeUnits", "SOTLateUnits", "SOTLate5daysUnits", "WTSOTLateUnits")
            },
        }
        check(
            _name.format(_tag),
            f"SELECT * EXCLUDE (place) FROM (SELECT *, rank() OVER (PARTITION BY {_key}, "
            "ShipCancelMonth ORDER BY SOTLateUnits DESC) AS place FROM "
            f"(SELECT {_key}, ShipCancelMonth, Parent_Vendor, {_measures(_shown)} "
            f"FROM {_sot} GROUP BY 1, 2, 3)) WHERE place <= 10",
        )
_PERCENT = f"round_even(100 * ({_sum(_ON_TIME)} / nullif(sum(Units), 0)), 1)"
check(
    "r30_vendor_week_stock",
    f"SELECT Parent_Vendor, Month_Number, Week, {_sum(_ON_TIME)} AS OnTime_Units_sum, "
    "sum(Units) AS Total_Units_sum, sum(Units) AS Measurable_Units_sum FROM ots_c "
    "GROUP BY 1, 2, 3",
)
check(
    "r31_vendor_week_percent",
    f"SELECT Parent_Vendor, Month_Number, Week, {_sum(_ON_TIME)} AS OnTime_Units_sum, "
    f"{_sum(_LATE)} AS Late_Units_sum, sum(Units) AS Total_Units_sum, "
    f"sum(Units) AS Measurable_Units_sum, {_PERCENT} AS OTS_Percent_value FROM ots_c "
    "GROUP BY 1, 2, 3",
)

# ---- dashboard ----

_BRAND_CASE = (
    "CASE "
    + " ".join(
        f"WHEN ReportingBrand IN ({_listing(old)}) THEN '{new}'"
        for new, old in domains.BRAND_GROUPS.items()
    )
    + " END"
)
_MARKET_CASE = (
    "CASE "
    + " ".join(
        f"WHEN DC_NAME IN ({_listing(dcs)}) THEN '{market}'"
        for market, dcs in domains.MARKET_CENTRES.items()
    )
    + " END"
)


def _on_spine(entity: str, listed, months: str, name: str, extra: str = "true") -> str:
    return (
        f"SELECT spine.entity, m AS Month_Number, {name} FROM {_domain(listed, 'entity')} "
        f"LEFT JOIN (SELECT {entity} AS entity, CAST({MONTH} AS INT) AS m, {_SHARE} AS {name} "
        f"FROM ots_c WHERE {months} AND {extra} GROUP BY 1) g ON g.entity = spine.entity"
    )


_THIS, _YTD = f"Month_Number = {MONTH}", f"Month_Number <= {MONTH}"


def _joined(month: str, ytd: str) -> str:
    return (
        f"SELECT y.entity, y.Month_Number, ots_pct, ytd_ots_pct FROM ({ytd}) y "
        f"LEFT JOIN ({month}) m ON m.entity = y.entity "
        "AND m.Month_Number IS NOT DISTINCT FROM y.Month_Number"
    )


_BLOCKS = {
    "centre": (
        _on_spine("DC_NAME", domains.NA_EU_CENTRES, _THIS, "ots_pct", _NO_RETIRED),
        _on_spine("DC_NAME", domains.NA_EU_CENTRES, _YTD, "ytd_ots_pct", _NO_RETIRED),
    ),
    "brand": (
        _on_spine(_BRAND_CASE, domains.DISPLAY_BRANDS, _THIS, "ots_pct"),
        _on_spine(_BRAND_CASE, domains.DISPLAY_BRANDS, _YTD, "ytd_ots_pct"),
    ),
    "market": (
        _on_spine(_MARKET_CASE, domains.MARKETS, _THIS, "ots_pct"),
        _on_spine(_MARKET_CASE, domains.MARKETS, "true", "ytd_ots_pct"),
    ),
}
for _block, (_m, _y, _j) in {
    "centre": ("r32", "r33", "r39"),
    "brand": ("r41", "r42", "r43"),
    "market": ("r45", "r46", "r47"),
}.items():
    check(f"{_m}_{_block}_month", _BLOCKS[_block][0])
    check(f"{_y}_{_block}_ytd", _BLOCKS[_block][1])
    check(f"{_j}_{_block}_joined", _joined(*_BLOCKS[_block]))
# Shares of one column have the digits that its spread asks for: a step of one below the spread's
# leading digit, in percent, less the zeros that all of them end with.
_TENTHS = " ".join(f"WHEN {d} THEN printf('%.{d}f', round_even(p, {d}))" for d in range(7))


def _percent_digits(table: str, keys: str) -> str:
    ends = "length(CAST(CAST(round_even(p * power(10, digits), 0) AS BIGINT) AS VARCHAR))"
    cut = "length(rtrim(CAST(CAST(round_even(p * power(10, digits), 0) AS BIGINT) AS VARCHAR), '0'))"
    return (
        f"SELECT * FROM (WITH t AS ({table}), p AS (SELECT *, 100 * share AS p FROM t), "
        "s AS (SELECT CASE WHEN max(share) = min(share) THEN max(share) ELSE max(share) - min(share) END AS span "
        "FROM t), d AS (SELECT CASE WHEN span > 0 THEN CAST(-floor(log10(span)) AS INT) ELSE 0 END AS digits FROM s), "
        f"n AS (SELECT greatest(max(CASE WHEN p = 0 THEN 0 ELSE greatest(digits - ({ends} - {cut}), 0) END), 0) "
        "AS shown FROM p, d) "
        f"SELECT {keys}, CASE shown {_TENTHS} END || '%' AS share_text FROM p, d, n)"
    )


check(
    "x04_percent_digits",
    _percent_digits(
        "SELECT DC_NAME, Month_Number, "
        f"CAST({_sum(_ON_TIME)} AS DOUBLE) / nullif({_sum(_MEASURED)}, 0) AS share FROM ots_c GROUP BY 1, 2",
        "DC_NAME, Month_Number",
    ),
)
check(
    "x04_percent_text",
    "SELECT spine.entity, m AS Month_Number, ots_text "
    f"FROM {_domain(domains.NA_EU_CENTRES, 'entity')} LEFT JOIN (SELECT DC_NAME AS entity, "
    f"CAST({MONTH} AS INT) AS m, printf('%.1f%%', 100 * ({_sum(_ON_TIME)} / "
    f"nullif({_sum(_MEASURED)}, 0))) AS ots_text FROM ots_c WHERE {_THIS} AND {_NO_RETIRED} "
    "GROUP BY 1) g ON g.entity = spine.entity",
)


def _total(listed, label: str, shares: dict[str, str]) -> str:
    shown = ", ".join(
        f"round({_sum(f'{_ON_TIME} AND {m}')} / nullif({_sum(f'{_MEASURED} AND {m}')}, 0), 6) "
        f"AS {n}"
        for n, m in shares.items()
    )
    return (
        f"SELECT {_listing([label])} AS entity, CAST({MONTH} AS INT) AS Month_Number, {shown} "
        f"FROM ots_c WHERE DC_NAME IN ({_listing(listed)}) AND {_NO_RETIRED}"
    )


_ROWS = {
    "na_eu": (domains.NA_EU_CENTRES, domains.NA_EU_TOTAL, ("r34", "r35", "r36")),
    "global": (domains.GLOBAL_CENTRES, domains.GLOBAL_TOTAL, ("r37", "r38", "r40")),
}
_TOTALS = {}
for _name, (_listed, _label, (_m, _y, _row)) in _ROWS.items():
    check(f"{_m}_{_name}_month", _total(_listed, "", {"ots_pct": _THIS}))
    check(f"{_y}_{_name}_ytd", _total(_listed, "", {"ytd_ots_pct": _YTD}))
    _TOTALS[_name] = _total(_listed, _label, {"ots_pct": _THIS, "ytd_ots_pct": _YTD})
    check(f"{_row}_{_name}_row", _TOTALS[_name])
_UNION = " UNION ALL ".join(
    f"SELECT {i} AS block, * FROM ({sql})"
    for i, sql in enumerate(
        (
            _joined(*_BLOCKS["centre"]),
            _TOTALS["na_eu"],
            _joined(*_BLOCKS["brand"]),
            _joined(*_BLOCKS["market"]),
            _TOTALS["global"],
        ),
        1,
    )
)
check("r48_dashboard", _UNION)
check("u01_dashboard_blocks", _UNION)
CHECKS["p13_beside"] = CHECKS["r36_na_eu_row"]
CHECKS["j10_centre_month_vs_ytd"] = CHECKS["r39_centre_joined"]
check(
    "r44_market_check",
    f"SELECT DC_NAME, {_MARKET_CASE} AS custom_country, count(*) AS n FROM ots_c GROUP BY 1, 2",
)
CHECKS["s11_tee"] = CHECKS["r44_market_check"]
check(
    "r49_centre_by_month",
    f"SELECT Month_Number, DC_NAME, {_SHARE} AS ots_pct, {_floor('sum(Units)')} AS raw_units, "
    f"{_floor(_sum(_MEASURED))} AS measured_units, {_floor(_sum(_ON_TIME))} AS OnTimeUnits, "
    f"{_floor(_sum(_LATE))} AS LateUnits FROM ots_c GROUP BY 1, 2",
)

# ---- failure classes and impact ----

check("r50_failure_classes", "SELECT * FROM classified")

_BASE = _sum("Lateness <> 'Unmeasured'")
_SHARES = {
    "sot_pct": _ON_TIME,
    "transport_impact": "probable_failure = 'Transportation'",
    "air_vendor_impact": "probable_failure = 'Vendor' AND SHIP_MODE_CD = 'A'",
    "vendor_non_air_impact": "probable_failure = 'Vendor' AND SHIP_MODE_CD <> 'A'",
}


def _impact_table(keys: str, rows: str, extra: str = "") -> str:
    raw = ", ".join(f"{_sum(c)} / nullif({_BASE}, 0) AS {n}" for n, c in _SHARES.items())
    known = " + ".join(_SHARES)
    lead = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    shown = ", ".join(f"round({n}, 6) AS {n}" for n in _SHARES)
    return (
        f"SELECT {lead}{extra and 'units, '}{shown}, "
        "round(sot_pct - 0.95::DOUBLE, 6) AS sot_variance, "
        f"round(1 - ({known}), 6) AS unmeasured_impact, "
        f"round({known} + (1 - ({known})), 6) AS total_impact "
        f"FROM (SELECT {lead}{extra}{raw} FROM classified WHERE {rows} AND {_NO_FRANCHISE} {group})"
    )


_SPANS = {
    "month": f"ShipCancelMonth = {MONTH}",
    "ytd": f"FISCAL_YEAR = {YEAR} AND ShipCancelWeek <= {WEEK}",
    "year": f"FISCAL_YEAR = {YEAR}",
}
_IMPACT = (
    "sot_pct, sot_variance, transport_impact, air_vendor_impact, vendor_non_air_impact, "
    "unmeasured_impact, total_impact"
)
for _first, _span in ((51, "month"), (54, "ytd")):
    for _offset, (_name, _key, _listed) in enumerate(
        (
            ("brand", "ReportingBrand", domains.BRANDS),
            ("category", "Category", domains.CATEGORIES),
        )
    ):
        check(
            f"r{_first + _offset}_{_name}_impact_{_span}",
            f"SELECT spine.{_key}, {_IMPACT} FROM {_domain(_listed, _key)} "
            f"LEFT JOIN ({_impact_table(_key, _SPANS[_span])}) g ON g.{_key} = spine.{_key}",
        )
    check(f"r{_first + 2}_company_impact_{_span}", _impact_table("", _SPANS[_span]))
check(
    "r57_vendor_air_failures",
    f"SELECT * FROM classified WHERE ShipCancelWeek = {WEEK} AND {_NO_FRANCHISE} "
    "AND probable_failure = 'Vendor' AND SHIP_MODE_CD = 'A'",
)
check(
    "r58_consolidation_series",
    "SELECT ACTUAL_ORIGIN_CONSOL_LCL_DATE AS consolidated_on, days_late_to_oc FROM classified "
    "WHERE days_late_to_oc <= 45 AND days_late_to_oc >= -45",
)
check(
    "r59_consolidation_vs_late",
    "SELECT ACTUAL_ORIGIN_CONSOL_LCL_DATE AS consolidated_on, days_late_to_oc, DAYS_LATE, "
    "Lateness FROM (SELECT * FROM classified ORDER BY NUMBER_SEQ LIMIT 100) "
    "WHERE days_late_to_oc <= 45 AND days_late_to_oc >= -45 "
    "AND (days_late_to_oc <> 0 OR DAYS_LATE <> 0)",
)
check("r60_leading_vendors", "SELECT * FROM leaders")


def _vendor_impact(span: str) -> str:
    table = _impact_table("Parent_Vendor, Category", _SPANS[span], "sum(Units) AS units, ")
    return (
        f"SELECT spine.Category, v.Parent_Vendor, v.blank, v.units, {_IMPACT} "
        f"FROM {_domain(domains.CATEGORIES, 'Category')} LEFT JOIN "
        "(SELECT l.Category, l.Parent_Vendor, CASE WHEN g.Category IS NOT NULL THEN '' END "
        f"AS blank, g.* EXCLUDE (Category, Parent_Vendor) FROM leaders l LEFT JOIN ({table}) g "
        "ON l.Category = g.Category AND l.Parent_Vendor IS NOT DISTINCT FROM g.Parent_Vendor) v "
        "ON v.Category = spine.Category"
    )


check("r61_vendor_impact_month", _vendor_impact("month"))
check("r62_vendor_impact_ytd", _vendor_impact("year"))
check(
    "p11_vendor_impact_text",
    "SELECT coalesce(Category, '-') AS Category, coalesce(Parent_Vendor, '-') AS Parent_Vendor, "
    "coalesce(blank, '-') AS blank, "
    + ", ".join(
        f"coalesce(CAST(CAST({c} AS DECIMAL(28, 6)) AS VARCHAR), '-') AS {c}"
        for c in ["units", *_IMPACT.split(", ")]
    )
    + f" FROM ({_vendor_impact('month')})",
)

# ---- delay reasons ----

check(
    "r63_delayed_units",
    "SELECT ShipCancelWeek, SHP_RSN_TYP_DESC, coalesce(sum(Units), 0) AS delayed_units "
    f"FROM sot_c WHERE ShipCancelWeek = {WEEK} GROUP BY 1, 2",
)
for _name, _cond in (
    ("r64_reason_units", "true"),
    ("r64_reason_units_delays", "SHP_RSN_TYP_DESC <> '-'"),
):
    check(
        _name,
        f"SELECT SHP_RSN_TYP_DESC, sum(Units) AS units FROM sot_c WHERE ShipCancelWeek = {WEEK} "
        f"AND {_cond} GROUP BY 1",
    )
_FIVE = (
    "count(Units) AS rows, min(Units) AS low, quantile_cont(Units, 0.25) AS q1, "
    "quantile_cont(Units, 0.5) AS median, quantile_cont(Units, 0.75) AS q3, max(Units) AS high"
)
check(
    "r65_reason_spread",
    f"SELECT SHP_RSN_TYP_DESC, {_FIVE} FROM sot_c WHERE ShipCancelWeek = {WEEK} "
    "AND SHP_RSN_TYP_DESC <> '-' AND Units < 40 GROUP BY 1",
)
check(
    "r66_sub_reason_spread",
    f"SELECT sub_reason, {_FIVE} FROM classified WHERE ShipCancelWeek = {WEEK} "
    "AND sub_reason <> 'Not Tested' GROUP BY 1",
)


def _boxes(key: str, rows: str, value: str, outliers: bool) -> str:
    five = (
        f"SELECT {key}, count(Units) AS rows, quantile_cont(Units, 0.25) AS q1, "
        "quantile_cont(Units, 0.5) AS median, quantile_cont(Units, 0.75) AS q3 FROM v GROUP BY 1"
    )
    lead = (
        f"WITH v AS (SELECT {key}, {value} AS Units FROM {rows} AND Units IS NOT NULL), five AS ({five}), "
        "f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS low_fence, q3 + 1.5 * (q3 - q1) AS high_fence FROM five) "
    )
    if outliers:
        return (
            f"SELECT * FROM ({lead} SELECT {key}, Units, count(*) AS n FROM v JOIN f USING ({key}) "
            "WHERE Units < low_fence OR Units > high_fence GROUP BY 1, 2)"
        )
    inside = "Units BETWEEN low_fence AND high_fence"
    return (
        f"SELECT * FROM ({lead} SELECT {key}, rows, least(min(Units) FILTER ({inside}), q1) AS low_whisker, q1, median, q3, "
        f"greatest(max(Units) FILTER ({inside}), q3) AS high_whisker, low_fence, high_fence, "
        f"count(*) FILTER (NOT ({inside})) AS outliers FROM v JOIN f USING ({key}) "
        f"GROUP BY {key}, rows, q1, median, q3, low_fence, high_fence)"
    )


_REASON_ROWS = f"sot_c WHERE ShipCancelWeek = {WEEK} AND SHP_RSN_TYP_DESC <> '-'"
_TESTED_ROWS = f"classified WHERE ShipCancelWeek = {WEEK} AND sub_reason <> 'Not Tested'"
_CUBED = "Units * Units * Units"
check("r65_reason_box", _boxes("SHP_RSN_TYP_DESC", f"{_REASON_ROWS} AND Units < 40", "Units", False))
check("r65_reason_outliers", _boxes("SHP_RSN_TYP_DESC", _REASON_ROWS, _CUBED, True))
check("r66_sub_reason_box", _boxes("sub_reason", _TESTED_ROWS, _CUBED, False))
check("r66_sub_reason_outliers", _boxes("sub_reason", _TESTED_ROWS, _CUBED, True))

# ---- ship choice ----

check("r67_choice_base", "SELECT * FROM choices")
check(
    "f15_first_choice_units",
    "SELECT g.*, Ship_Choice_Status FROM (SELECT SHIP_MODE_CD, Trade_Lane_Type, "
    "SALES_TERMS_CODE, ShipDateChoice, sum(Units) AS units FROM sot_c GROUP BY ALL) g "
    "JOIN ship_choice USING (SHIP_MODE_CD, Trade_Lane_Type, SALES_TERMS_CODE, ShipDateChoice) "
    "WHERE Ship_Choice_Status = 1",
)
_VU = "vendor_units"


def _choice_share(extra: str) -> str:
    return (
        f"100 * ({_sum(f'{_ON_TIME} AND {extra}', _VU)} / "
        f"nullif({_sum(f'''Lateness <> 'Unmeasured' AND {extra}''', _VU)}, 0))"
    )


check(
    "r68_first_choice",
    "SELECT Contract_Ship_Cancel, OnTimeUnits, LateUnits, unmeasured_units, "
    "round(f, 6) AS sot_pct_first, round(a, 6) AS sot_pct_all, units, "
    "round(f - a, 6) AS choice_impact FROM (SELECT Contract_Ship_Cancel, "
    f"{_sum(_ON_TIME, _VU)} AS OnTimeUnits, {_sum(_LATE, _VU)} AS LateUnits, "
    f"{_sum('''Lateness = 'Unmeasured' ''', _VU)} AS unmeasured_units, "
    f"{_choice_share('Ship_Choice_Status = 1')} AS f, {_choice_share('true')} AS a, "
    f"sum({_VU}) AS units FROM choices WHERE Contract_Ship_Cancel BETWEEN {PERIOD} GROUP BY 1) "
    "WHERE units >= 500",
)
check(
    "r69_by_choice",
    f"SELECT Contract_Ship_Cancel, Ship_Choice_Status, {_sum(_ON_TIME, _VU)} AS OnTimeUnits, "
    f"{_sum(_LATE, _VU)} AS LateUnits, "
    f"round(100 * ({_sum(_ON_TIME, _VU)} / nullif(sum({_VU}), 0)), 6) AS sot_pct, "
    f"sum({_VU}) AS units FROM choices GROUP BY 1, 2 HAVING sum({_VU}) >= 500",
)
_LATE_BRAND = f"ReportingBrand = {BRAND} AND {_LATE} AND ShipCancelWeek = {WEEK}"
check("r70_late_brand_lines", f"SELECT * FROM sot_c WHERE {_LATE_BRAND}")
check(
    "r71_late_brand_routes",
    "SELECT ReportingBrand, SHIP_MODE_CD, Trade_Lane_Type, SALES_TERMS_CODE, ShipDateChoice, "
    f"sum(Units) AS vendor_units FROM sot_c WHERE {_LATE_BRAND} GROUP BY ALL",
)
_ROUTE = "SHIP_MODE_CD, Trade_Lane_Type, SALES_TERMS_CODE, ShipDateChoice"
check(
    "s12_book",
    f"SELECT 'Late lines' AS \"table\", {_ROUTE}, Units AS units FROM sot_c WHERE {_LATE_BRAND} "
    f"UNION ALL SELECT 'By route', {_ROUTE}, sum(Units) FROM sot_c WHERE {_LATE_BRAND} GROUP BY ALL",
)
check(
    "s06_rule_table",
    f"SELECT r.*, units FROM ship_choice r LEFT JOIN (SELECT {_ROUTE}, sum(Units) AS units "
    f"FROM sot_c GROUP BY ALL) USING ({_ROUTE})",
)

# ---- detail ----

_DONE = f"nullif({_sum(_ON_TIME)} + {_sum(_LATE)}, 0)"
_DELAYED = _sum(f"{_LATE} AND SHP_RSN_TYP_DESC <> '-'")
_OF_VENDOR, _OF_BRAND = f"Parent_Vendor = {VENDOR}", f"ReportingBrand = {BRAND}"
_IN_PERIOD = f"Contract_Ship_Cancel BETWEEN {PERIOD}"
_IN_DECEMBER = f"FISCAL_YEAR = {YEAR} AND regexp_matches(Fiscal_Month, 'dec', 'i')"
check(
    "r72_vendor_series",
    f"SELECT Contract_Ship_Cancel, round(100 * ({_sum(_ON_TIME)} / {_DONE}), 6) "
    f"AS sot_performance FROM sot WHERE {_OF_VENDOR} AND {_IN_PERIOD} GROUP BY 1",
)
check(
    "r79_brand_series",
    "SELECT Contract_Ship_Cancel, round(p, 6) AS sot_performance, round(i, 6) AS delay_impact, "
    "round(p + i, 6) AS adjusted_sot FROM (SELECT Contract_Ship_Cancel, "
    f"100 * ({_sum(_ON_TIME)} / {_DONE}) AS p, 100 * ({_DELAYED} / {_DONE}) AS i "
    f"FROM sot WHERE {_OF_BRAND} AND {_IN_PERIOD} GROUP BY 1)",
)
check(
    "x15_series_span",
    "SELECT min(Contract_Ship_Cancel) AS first_date, max(Contract_Ship_Cancel) AS last_date "
    f"FROM sot WHERE {_OF_BRAND} AND {_IN_PERIOD}",
)
for _ytd, _month, _key, _rows in (
    ("r73_vendor_categories", "r74_vendor_categories_month", "Parent_Vendor", _OF_VENDOR),
    ("r80_brand_categories", "r81_brand_categories_month", "ReportingBrand", _OF_BRAND),
):
    check(
        _ytd,
        f"SELECT {_key}, Category, sum(Units) AS SOT_Units FROM sot WHERE {_rows} GROUP BY 1, 2",
    )
    check(
        _month,
        f"SELECT Fiscal_Month, {_key}, Category, sum(Units) AS SOT_Units FROM sot "
        f"WHERE {_rows} AND {_IN_DECEMBER} GROUP BY 1, 2, 3",
    )
for _month, _again, _ytd, _keys, _rows in (
    (
        "r75_vendor_lateness_month",
        "r76_vendor_brand_lateness",
        "r77_vendor_lateness_ytd",
        "Parent_Vendor, Category, ReportingBrand, Lateness",
        _OF_VENDOR,
    ),
    (
        "r82_brand_lateness_month",
        "r83_brand_lateness_again",
        "r84_brand_lateness_ytd",
        "Parent_Vendor, ReportingBrand, Lateness",
        _OF_BRAND,
    ),
):
    check(
        _month,
        f"SELECT {_keys}, sum(Units) AS SOT_Units FROM sot WHERE {_rows} AND {_IN_DECEMBER} "
        "GROUP BY ALL",
    )
    check(
        _again,
        f"SELECT ReportingBrand, Lateness, sum(Units) AS shipped_units FROM sot WHERE {_rows} "
        f"AND {_IN_DECEMBER} GROUP BY 1, 2",
    )
    check(
        _ytd,
        f"SELECT {_keys}, {_floor('sum(Units)')} AS SOT_Units FROM sot WHERE {_rows} GROUP BY ALL",
    )
check(
    "r78_vendor_largest_lines",
    f"SELECT * FROM sot WHERE {_OF_VENDOR} AND FISCAL_YEAR = {YEAR} "
    "ORDER BY Units DESC NULLS LAST, NUMBER_SEQ LIMIT 50",
)
check(
    "r85_brand_largest_late_lines",
    f"SELECT * EXCLUDE (NUMBER_SEQ) FROM (SELECT * FROM sot WHERE {_OF_BRAND} "
    f"AND FISCAL_YEAR = {YEAR} AND {_LATE} ORDER BY Units DESC NULLS LAST, NUMBER_SEQ LIMIT 50)",
)

"""Closed lists that reports must show or map.

All values here are fixed values: they must equal the published lists for the
reports to show the same rows.
"""

from __future__ import annotations

NA_EU_CENTRES = (
    "BDC", "FDC", "NDC", "ODC", "PDC", "SCD", "SDC", "TDC", "GUK", "CFC", "OCC", "OFC",
    "PUC", "WFC",
)
GLOBAL_CENTRES = (
    "BDC", "FDC", "NDC", "ODC", "PDC", "SCD", "SDC", "TDC", "GUK", "CFC", "OFC", "WFC",
    "PUC", "SHD", "TFC", "HK DC", "JPD", "EAO", "EFC",
)
DISPLAY_BRANDS = ("Banana Republic", "Gap", "Old Navy", "BRFS", "GFO")
BRAND_GROUPS = {
    "Banana Republic": ("BR NA", "BR INTL"),
    "Gap": ("GAP INTL", "GAP NA"),
    "Old Navy": ("ON NA", "ON INTL"),
    "BRFS": ("BRFS NA",),
    "GFO": ("GO NA", "GO INTL"),
    "Athleta": ("ATHLETA",),
}
MARKETS = ("US", "CA", "GB", "JP", "CN", "HK")
MARKET_CENTRES = {
    "US": ("FDC", "ODC", "PDC", "SCD", "TDC", "OCC", "OFC", "WFC", "PUC", "NDC", "EAO"),
    "CA": ("BDC", "CFC"),
    "GB": ("GUK",),
    "JP": ("JPD",),
    "CN": ("SHD",),
    "HK": ("HK DC",),
}
COUNTRY_GROUPS = {"Canada": ("CA",)}
CATEGORIES = (
    "Wovens",
    "Knits",
    "Denim and Woven Bottoms",
    "Sweaters",
    "IP",
    "Accessories",
    "Category Other",
    "3P & Lic",
)
BRANDS = (
    "GAP NA", "BR NA", "ON NA", "GO NA", "BRFS NA",
    "GAP INTL", "BR INTL", "ON INTL", "GO INTL", "ATHLETA",
)
NA_EU_TOTAL = "Total DC's (NA+EU)"
GLOBAL_TOTAL = "Global"

# Headings of the published files, where they are not plain identifiers.
HEADINGS = {
    "units_by_country": "Units by Country",
    "units_by_vendor": "Units by Vendor",
    "total_units": "Total Units",
    "raw_units": "Raw Units",
    "measured_units": "Measured Units",
    "ots_pct": "OTS%",
    "ytd_ots_pct": "YTD OTS%",
    "sot_pct": "SOT %",
    "sot_variance": "SOT Variance from Target",
    "transport_impact": "Transport_Impact",
    "air_vendor_impact": "Air_Vendor_Impact",
    "vendor_non_air_impact": "Vendor_non_Air_Impact",
    "unmeasured_impact": "Unmeasured_Impact",
    "total_impact": "Total_Impact",
    "units": "Units",
    "entity": "Entity",
    "blank": "Blank",
    "delayed_units": "Delayed Units",
    "vendor_units": "Vendor Units",
    "delay_label": "Transportation Delay Reason",
    "unmeasured_units": "Unmeasured Units",
    "sot_pct_first": "SOT % (first Choice)",
    "sot_pct_all": "SOT % (all)",
    "choice_impact": "Impact",
    "sot_performance": "SOT Performance",
    "delay_impact": "Transportation Delay Impact",
    "adjusted_sot": "Adjusted SOT",
    "shipped_units": "Shipped Units",
    "planned_oc": "Planned OC (Derived)",
    "days_late_to_oc": "Days Late to OC",
    "days_anticipated_vs_contract": "Days Anticipated vs Contract",
    "lp_vs_anticipated": "LP vs Anticipated",
    "probable_failure": "Probable Failure",
    "sub_reason": "Sub Reason",
    "test_by_oc": "Test by OC",
    "is_match": "Match?",
    "days_before_ship_cancel": "Days.Before.Ship.Cancel",
}

"""Fixed schemas of the two fact tables and the small dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def fields(text: str) -> T.StructType:
    """A schema from ``name type`` pairs; unlike DDL parsing it needs no session."""
    pairs = (item.split() for item in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# The status of lines that the two facts could not measure.
SHIPPED_UNKNOWN = "Unmeasured"
STOCKED_UNKNOWN = "Undetermined"

SOT = fields(
    """
    NUMBER_SEQ string, Data_Pulled date, FISCAL_YEAR int, ShipCancelMonth int,
    ShipCancelWeek int, Fiscal_Month string, ReportingBrand string, Category string,
    Parent_Vendor string, CountryOfOrigin string, MetricShipDate date, Units double,
    Lateness string, DAYS_LATE int, SHP_MODE_CATG_NM string, SHIP_MODE_CD string,
    SALES_TERMS_CODE string, ShipDateChoice string, Trade_Lane_Type string,
    SHP_RSN_TYP_DESC string, XFR_Point_Place string, DC_GEO_LOC string,
    Contract_Ship_Cancel date, SHIP_CANCEL_DATE date,
    ACTUAL_ORIGIN_CONSOL_LCL_DATE date, ACTUAL_LP_LCL_DATE date
    """
)

OTS = fields(
    """
    NUMBER_SEQ string, Data_Pulled date, FISCAL_YEAR int, Week int, Month_Number int,
    Fiscal_Month string, ReportingBrand string, Category string, Parent_Vendor string,
    ORIGIN_COUNTRY_CODE string, DC_NAME string, DCCampus string, DestCtryCD string,
    Units double, Lateness string, Days_Late int, SHP_MODE_CATG_NM string
    """
)

# A stocked extract holds one year and may lack the column; only a cut to one year needs it.
OTS = T.StructType(
    [
        T.StructField(f.name, f.dataType, metadata={"optional": True} if f.name == "FISCAL_YEAR" else None)
        for f in OTS.fields
    ]
)

# Headers of the published dimension files; every field is text, so that
# identifiers keep their leading zeros.
PREFERRED_VENDOR_FILE = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "New Category",
            "Category",
            "Vendor ID",
            "Vendor Legacy ID",
            "Vendor Name",
            "Category Status?",
        )
    ]
)
COUNTRY_FILE = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "CTRY_CD",
            "CTRY_DESC",
            "LST_UPDT_DTTM",
            "CRT_DTTM",
            "LST_UPDT_USER_ID",
            "LST_UPDT_DTTM1",
        )
    ]
)

PREFERRED_VENDOR = fields(
    "new_category string, vendor_name string, vendor_id long, category_status string"
)
COUNTRY = fields("CTRY_CD string, CTRY_DESC string")
TRANSIT_PLAN = fields(
    "tp_place string, geo_description string, days_before_ship_cancel int"
)
SHIP_CHOICE = fields(
    """
    SHIP_MODE_CD string, Trade_Lane_Type string, SALES_TERMS_CODE string,
    ShipDateChoice string, Ship_Choice_Status int
    """
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Check that every schema column is present with its type, and select them.

    A wider extract passes; a missing or retyped column fails before any job runs.  Columns
    that the schema marks as optional may be missing.
    """
    found = {f.name: f.dataType for f in df.schema.fields}
    schema = T.StructType(
        [f for f in schema.fields if f.name in found or not f.metadata.get("optional")]
    )
    wrong = [
        f"{f.name}: wanted {f.dataType.simpleString()}, got "
        + (found[f.name].simpleString() if f.name in found else "nothing")
        for f in schema.fields
        if found.get(f.name) != f.dataType
    ]
    if wrong:
        raise ValueError("schema mismatch: " + "; ".join(wrong))
    return df.select(*schema.fieldNames())

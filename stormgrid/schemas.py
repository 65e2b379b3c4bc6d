"""Declared schemas of the feeds and published tables (no inference at read time)."""

from __future__ import annotations

from pyspark.sql import types as T

from stormgrid import constants as C


_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(),
    "date": T.DateType(), "timestamp": T.TimestampType(),
}


def _struct(text: str) -> T.StructType:
    """Schema from `name type` pairs; unlike DDL parsing this needs no running session."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (pair.split() for pair in text.split(","))])


INCIDENT_DEVICE = _struct(
    "INCIDENT_ID bigint, LOCATION_ID bigint, INCIDENT_DEVICE_ID bigint, STRCTUR_NO string, CIRCT_ID double, "
    "DNI_EQUIP_TYPE string, EQUIP_STN_NO string, CALL_QTY int, DOWNSTREAM_CUST_QTY int, KVA_VAL double, "
    "DOWNSTREAM_KVA_VAL double, CREATION_DATETIME string, SUBST_ID bigint, CLUE_CD string, PRIORITY_VAL double"
)
LOCATION = _struct(
    "INCIDENT_ID bigint, LOCATION_ID bigint, MAJ_OTG_ID bigint, CITY_NAM string, OCCURN_CD bigint, CAUSE_CD string, "
    "ENERGIZED_DATETIME string, GEO_X_COORD double, GEO_Y_COORD double"
)
INCIDENT = _struct("INCIDENT_ID bigint")
FACILITY = _struct(
    "FAC_JOB_ID bigint, INCIDENT_ID bigint, STRCTUR_NO string, CIRCT_ID double, DNI_EQUIP_TYPE string, "
    "EQUIP_STN_NO string, CALL_QTY int, DOWNSTREAM_CUST_QTY int, KVA_VAL double, DOWNSTREAM_KVA_VAL double, "
    "CREATION_DATETIME string, ENERGIZED_DATETIME string, ETR_DATETIME string, SUBST_ID bigint, MAJ_OTG_ID bigint, "
    "CLUE_CD string, OCCURN_CD bigint"
)
CLUE_MAP = _struct("CLUE_CD string, CLUE_DESC string")
OCCURRENCE_MAP = _struct("OCCURN_CD bigint, OCCURN_DESC string")
CAUSE_MAP = _struct("CAUSE_CD string, CAUSE_DESC string")
MARKER_MAP = _struct("Marker string, LAT double, LONG double")
LANDMARK_MAP = _struct("Location string, Landmark string")
FORECAST_DAY = _struct(
    "timestamp timestamp, Location string, Latitude double, Longitude double, timestampInit timestamp, "
    "Job_Update_Time timestamp, precipProb double, snowfallProb double, "
    + ", ".join(f"{f} double" for f in C.ROLLUP_FEATURES)
)
FORECAST_HOUR = _struct(
    "Job_Update_Time timestamp, timestamp timestamp, timestampInit timestamp, temp double, windSpd double, "
    "snowfallProb double, precipProb double, Location string"
)
PREDICTIONS = _struct(
    "OUTAGE_ID string, INCIDENT_ID bigint, STRCTUR_NO string, CIRCT_ID bigint, DNI_EQUIP_TYPE string, "
    "Creation_Time string, Estimated_Restoration_Time string, ETR double, Weather_Profile string, Last_Updated string"
)
STORM_PREPARATIONS = _struct(
    "Date date, Number_of_days_ahead string, Number_of_outages bigint, Customer_quantity double, "
    "Customers_LL_95 int, Customers_UL_95 int, Outages_LL_95 int, Outages_UL_95 int"
)
STORM_PROFILES = _struct("timestamp date, Location string, clusters string")
CLUE_COUNTS = _struct("Date date, " + ", ".join(f"{name} bigint" for name in C.DAILY_COUNTERS))
LAST_FILES = _struct("feed string, path string")

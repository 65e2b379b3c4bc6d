"""Code lists, keyword tables, coordinates, labels and bands.

Everything here must equal the published figures for the results to be right;
nothing in this module computes.
"""

from __future__ import annotations

# --- fixed values: the outage grain -------------------------------------------------
GRAIN = ["INCIDENT_ID", "STRCTUR_NO", "CIRCT_ID", "DNI_EQUIP_TYPE"]

# --- fixed values: codes that do not describe a real outage -------------------------
NON_CONNECTED_STATION = "<NCC>"
EXCLUDED_CLUES = ["01", "09OD"]
EXCLUDED_OCCURRENCES = [
    30003001, 33003301, 33003302, 34003400, 34003401, 34003402, 34003403, 34003404, 34003405, 34003406,
    34003407, 34003408, 34003409, 35003500, 35003501, 35003502, 35003503, 35003504, 35003505, 35003506,
    35003507, 35003508, 36003600, 36003601, 36003602, 36003603, 36003604, 36003605, 36003606, 36003607,
    36003608, 37003703, 38003802, 38003803, 38003804, 38003807, 39003910, 41004100, 41004101, 41004102,
    48004800, 48004802, 48004803, 49004900, 49004901, 49004902, 50005000, 50005001, 50005002, 52005200,
    52005201, 52005202, 52005203, 52005204, 52005205, 52005206, 52005207, 53005300, 53005301, 53005302,
    53005303, 53005304, 53005305, 53005306, 53005307, 53005308, 53005309, 53005310, 54005400, 54005401,
    54005402, 54005403, 54005404, 54005405, 34003410, 30003000, 36503650, 36503651, 36503652, 36503653,
    36503654, 36503655, 36503656, 36503657, 36503658,
]

# --- fixed values: keyword flags ----------------------------------------------------
# flag name: (source description, any of these texts, none of these texts, ignore case)
CLUE_KEYWORDS = {
    "POLE_CLUE_FLG": (["pole"], [], True),
    "PART_LIGHT_CLUE_FLG": (["part lights"], [], True),
    "EMERGENCY_CLUE_FLG": (["emergency"], [], True),
    "POWER_OUT_CLUE_FLG": (["power out"], [], True),
    "TREE_CLUE_FLG": (["tree"], [], True),
    "WIRE_DOWN_CLUE_FLG": (["wire down"], [], True),
    "IVR_CLUE_FLG": (["ivr"], [], True),
    "EQUIPMENT_CLUE_FLG": (["EQUIPMENT"], [], False),
    "TRANSFORMER_CLUE_FLG": (["TRANSFORMER"], [], False),
    "OPEN_DEVICE_CLUE_FLG": (["OPEN DEVICE"], [], False),
}
CAUSE_KEYWORDS = {
    "OH_CAUSE_FLG": (["OH", "O.H."], [], False),
    "UG_CAUSE_FLG": (["UG", "U.G."], [], False),
    "ANIMAL_CAUSE_FLG": (["ANIMAL"], [], False),
    "WEATHER_CAUSE_FLG": (["WEATHER"], [], False),
    "WEATHER_COLD_CAUSE_FLG": (["COLD"], [], False),
    "WEATHER_LIGHTNING_CAUSE_FLG": (["LIGHTNING"], [], False),
    "WEATHER__SNOW_CAUSE_FLG": (["SNOW"], [], False),
    "WEATHER__WIND_CAUSE_FLG": (["WIND"], [], False),
    "WEATHER__HEAT_CAUSE_FLG": (["HEAT"], [], False),
    "WEATHER__FLOOD_CAUSE_FLG": (["FLOOD"], [], False),
    "PUBLIC_CAUSE_FLG": (["PUBLIC"], [], False),
    "STREET_CAUSE_FLG": (["ST "], [], False),
    "SUBSTATION_CAUSE_FLG": (["SUBSTATION"], [], False),
    "TREE_CAUSE_FLG": (["TREE"], [], False),
    "MISCELLANEOUS_CAUSE_FLG": (["MISCELLANEOUS"], [], False),
    "CUST_REQUEST_CAUSE_FLG": (["CUSTOMER REQUEST"], [], False),
    "NO_CAUSE_FLG": (["NO CAUSE"], [], False),
    "PLANNED_CAUSE_FLG": (["PLANNED WORK"], [], False),
    "NO_OUTAGE_CAUSE_FLG": (["NO OUTAGE"], [], False),
}
OCCURRENCE_KEYWORDS = {
    "FUSE_OCCURN_FLG": (["FUSE"], ["FUSE NOT"], False),
    "CUST_EQUIP_OCCURN_FLG": (["CUSTOMER EQUIP"], [], False),
    "POLE_OCCURN_FLG": (["POLE"], [], False),
    "TRANSFORMER_OCCURN_FLG": (["TRANSFORMER"], [], False),
    "METER_OCCURN_FLG": (["METER"], [], False),
    "SERVICE_OCCURN_FLG": (["SERVICE"], [], False),
    "CABLE_OCCURN_FLG": (["CABLE"], [], False),
    "ST_OCCURN_FLG": (["ST"], [], False),
    "FIRE_OCCURN_FLG": (["FIRE"], [], False),
    "FOUND_OPEN_OCCURN_FLG": (["FOUND OPEN"], ["NOT FOUND OPEN"], False),
    "PUBLIC_SAFETY_OCCURN_FLG": (["SAFETY"], [], False),
    "WIRE_OCCURN_FLG": (["WIRE"], [], False),
    "SWITCH_OCCURN_FLG": (["SWITCH"], [], False),
    "CUTOUT_OCCURN_FLG": (["CUTOUT"], [], False),
    "REGULATOR_OCCURN_FLG": (["REGULATOR"], [], False),
    "CAP_BANK_OCCURN_FLG": (["CAP BANK"], [], False),
    "OH_OCCURN_FLG": (["OH"], [], False),
    "RECLOSER_OCCURN_FLG": (["RECLOSER"], [], False),
}
KEYWORD_FLAGS = [*CLUE_KEYWORDS, *CAUSE_KEYWORDS, *OCCURRENCE_KEYWORDS]
PRIORITY_VALUES = [1, 2, 3, 5]
PRIORITY_FLAGS = [f"PRIORITY_VAL_{v}_0" for v in PRIORITY_VALUES]
TEXT_FLAGS = [*KEYWORD_FLAGS, *PRIORITY_FLAGS, "DAY_FLAG"]

# --- fixed values: flags counted per day --------------------------------------------
DAILY_COUNTERS = {
    "NO_OF_POWER_OUT_CLUE_PER_DAY": "POWER_OUT_CLUE_FLG",
    "NO_OF_OPEN_DEVICE_CLUE_PER_DAY": "OPEN_DEVICE_CLUE_FLG",
    "NO_OF_IVR_CLUE_PER_DAY": "IVR_CLUE_FLG",
    "NO_OF_ANIMAL_CAUSE_PER_DAY": "ANIMAL_CAUSE_FLG",
    "NO_OF_WIRE_OCCURN_PER_DAY": "WIRE_OCCURN_FLG",
}

# --- fixed values: text flags turned into model inputs ------------------------------
INDICATORS_FALSE = [
    "POWER_OUT_CLUE_FLG", "ST_OCCURN_FLG", "WIRE_OCCURN_FLG", "FUSE_OCCURN_FLG", "NO_CAUSE_FLG",
    "UG_CAUSE_FLG", "POLE_CLUE_FLG", "ANIMAL_CAUSE_FLG", "TREE_CAUSE_FLG", "PUBLIC_SAFETY_OCCURN_FLG",
]
INDICATORS_TRUE = [
    "ST_OCCURN_FLG", "PUBLIC_SAFETY_OCCURN_FLG", "ANIMAL_CAUSE_FLG", "DAY_FLAG", "TREE_CAUSE_FLG",
    "POWER_OUT_CLUE_FLG",
]

# --- fixed values: places -----------------------------------------------------------
NO_CITY = "NO_CITY"
NO_LOCATION = "NO_LOCATION"
CITY_CENTER = (39.7684, -86.1581)
DEPOTS = [
    ("34th", 39.8802, -86.2324),
    ("ARL.", 39.8802, -86.0854),
    ("MILL", 39.7880, -86.2296),
    ("ENGLISH", 39.7880, -86.0868),
    ("W.I.", 39.7003, -86.2303),
    ("SOUTH", 39.7003, -86.0834),
]
MARKERS = [
    (39.9613, -86.4034), (39.8971, -86.3045), (39.9060, -86.2001), (39.9024, -86.0738), (39.8960, -85.9783),
    (39.8339, -86.3155), (39.8412, -86.2056), (39.8381, -86.0985), (39.8386, -85.9811), (39.7579, -86.3155),
    (39.7621, -86.2042), (39.7621, -86.0923), (39.7695, -85.9708), (39.6617, -86.2935), (39.6639, -86.1823),
    (39.6702, -86.0669), (39.6744, -85.9557), (39.5909, -86.4212), (39.5295, -86.5874), (39.5475, -86.2743),
]
EARTH_RADIUS_KM = 6371.0
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
METERS_PER_MILE = 1609.344

# --- fixed values: weather features -------------------------------------------------
_TRIPLES = [
    "cldCvr", "dewPt", "feelsLike", "heatIndex", "mslPres", "relHum", "sfcPres", "spcHum", "temp",
    "wetBulb", "windChill", "windSpd100m", "windSpd80m", "windSpd",
]
WEATHER_FEATURES = [f"{name}{stat}" for name in _TRIPLES for stat in ("Avg", "Max", "Min")] + [
    "precip", "snowfall", "radSolarAvg", "radSolarMax", "radSolarTot", "windDir100mAvg", "windDir80mAvg", "windDirAvg",
]
ROLLUP_FEATURES = [*WEATHER_FEATURES, "radSolarMin"]
# These take the maximum although their names end in Avg or carry no statistic.
ROLLUP_MAX = ["precip", "snowfall", "radSolarTot", "windDir80mAvg", "windDirAvg"]
CUSTOMER_MODEL_FEATURES = [
    "dewPtAvg", "feelsLikeAvg", "feelsLikeMax", "feelsLikeMin", "heatIndexAvg", "heatIndexMin", "mslPresMax",
    "mslPresMin", "precip", "radSolarAvg", "sfcPresMax", "sfcPresMin", "spcHumAvg", "windSpd100mAvg",
    "windSpd100mMax", "windSpd80mMax", "windSpdAvg", "windSpdMax",
]
RANGE_FEATURES = ["temp", "windSpd", "sfcPres", "cldCvr", "relHum"]
RATIO_FEATURES = ["relHum", "sfcPres"]
WIND_SECTORS = [
    (1, 45, "N-E-N"), (45, 90, "N-E-E"), (90, 180, "S-E-E"), (180, 225, "S-W-S"),
    (225, 270, "S-W-W"), (270, 315, "N-W-W"), (315, 360, "N-W-N"),
]
PROFILES = {
    "Cluster1": "Hot Days with Sudden Rain",
    "Cluster2": "Strong Breeze with Sudden Rain",
    "Cluster3": "Thunderstorms",
    "Cluster4": "Chilly Day with Chances of Snow",
    "Cluster5": "Strong Chilled Breeze with Chances of Snow",
    "Cluster6": "Hot Days with Chance of Rain",
}
DAY_LABELS = {-2: "DAY_B_YDAY", -1: "YDAY", 0: "TODAY", 1: "TOM", 2: "DAY_A_TOM"}
HORIZON_LABELS = {1: "One day ahead", 2: "Two days ahead"}
HOUR_FILTERS = [("Next 6 Hours", 6), ("Next 12 Hours", 12), ("Next 24 Hours", 24)]

# --- fixed values: forecast bands (upper bound of the bucket, residual deviation) ----
BAND_Z = 1.96
OUTAGE_BANDS = [(25, 13.52), (50, 12.07), (100, 15.13), (250, 35.90), (None, 172.96)]
CUSTOMER_BANDS = [(2500, 1363.56), (4000, 1566.72), (7000, 3850.02), (20000, 5592.56), (None, 4387.43)]

# --- fixed values: restoration-time rules -------------------------------------------
LONG_OUTAGE_MINUTES = 1440
SHORT_OUTAGE_ADDITION = 45
LONG_OUTAGE_ADDITION = 360
MIN_DIAGNOSTIC_TTR = 30
TRAILING_HOURS = 10

# --- fixed values: columns that never enter the component model ---------------------
COMPONENT_LABELS = ["MAJ_OTG_ID", "Date", "OUTAGES", "CUST_QTY", "STORM_DURATION", "OUTAGED_RECOVERY"]
COMPONENT_SKIPPED_FEATURE = "radSolarMin"
JUNK_COLUMNS = r"^(Unnamed|_c0)"

# --- fixed values: names found inside the feeds -------------------------------------
LOCATION_PREFIX = "IPL"
LIVE_FEEDS = {
    "device": "INCIDENT_DEVICE_IPL",
    "incident": "INCIDENT_IPL",
    "location": "LOCATION_IPL",
}
HISTORY_MARK = "HIS"
HISTORY_FEED = "FACILITY_IPL_Daily"
FORECAST_CLOCK = "05:00:00"
EASTERN = "US/Eastern"

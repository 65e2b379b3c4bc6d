"""The derived tables once more, as DuckDB SQL, for the comparison queries."""

from __future__ import annotations

from stormgrid import constants as C
from stormgrid.catalog import tables


def text(value) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def pick(texts: list, index: str) -> str:
    return f"([{', '.join(text(t) for t in texts)}])[({index}) % {len(texts)} + 1]"


def stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def seconds(column: str) -> str:
    return f"CAST(epoch({column}) AS BIGINT)"


def at(sec: str) -> str:
    return f"make_timestamp(CAST({sec} AS BIGINT) * 1000000)"


_DEVICE = """
  l_orderkey AS INCIDENT_ID,
  CAST(CASE WHEN l_partkey % 19 = 0 THEN -1 ELSE l_orderkey % 1000 + 1 + 1000 * (l_linenumber % 2) END AS BIGINT) AS LOCATION_ID,
  l_partkey * 10 + l_linenumber AS INCIDENT_DEVICE_ID,
  CASE WHEN l_partkey % 53 <> 0 THEN 'S' || (l_partkey % 97) END AS STRCTUR_NO,
  l_suppkey AS CIRCT_ID, l_returnflag AS DNI_EQUIP_TYPE,
  CASE WHEN l_partkey % 29 = 0 THEN '<NCC>' WHEN l_partkey % 31 <> 0 THEN 'E' END AS EQUIP_STN_NO,
  CAST(l_linenumber AS BIGINT) AS CALL_QTY,
  CAST(l_quantity AS BIGINT) - 5 AS DOWNSTREAM_CUST_QTY,
  CASE WHEN l_partkey % 7 <> 0 THEN l_extendedprice END AS KVA_VAL,
  l_extendedprice * (1 - l_discount) AS DOWNSTREAM_KVA_VAL,
  CASE WHEN l_partkey % 23 <> 0 THEN l_partkey % 41 END AS SUBST_ID"""

_DEVICE_CLUE = """
  CASE WHEN l_partkey % 16 = 0 THEN '01' WHEN l_partkey % 16 = 1 THEN '00A' WHEN l_partkey % 16 = 2 THEN '09OD'
       WHEN l_partkey % 16 = 3 THEN '1EF' WHEN l_partkey % 16 <> 4 THEN '0' || (l_partkey % 200 + 200) END AS CLUE_CD,
  CASE WHEN l_partkey % 6 <> 0 THEN CAST(l_partkey % 6 AS DOUBLE) END AS PRIORITY_VAL"""

_GRAIN = ", ".join(C.GRAIN)
_GRAIN_SET = " AND ".join(f"{k} IS NOT NULL" for k in C.GRAIN)
_OUTAGE_ID = "CAST(INCIDENT_ID AS VARCHAR) || STRCTUR_NO || CAST(CIRCT_ID AS VARCHAR) || DNI_EQUIP_TYPE"

CLEAN = f"""
  DOWNSTREAM_CUST_QTY > 0 AND EQUIP_STN_NO IS NOT NULL AND EQUIP_STN_NO <> '<NCC>'
  AND CIRCT_ID <> 0 AND STRCTUR_NO IS NOT NULL AND DNI_EQUIP_TYPE IS NOT NULL
  AND CLUE_CD LIKE '0%' AND CLUE_CD NOT LIKE '00%' AND CLUE_CD <> '01' AND CLUE_CD <> '09OD'
  AND (OCCURN_CD IS NULL OR OCCURN_CD NOT IN ({', '.join(map(str, C.EXCLUDED_OCCURRENCES))}))"""

MIX = "o_orderkey * 7 + o_custkey + half * 3"


def _condition(source: str, rule) -> str:
    any_of, none_of, ignore_case = rule
    source = f"lower({source})" if ignore_case else source
    found = " OR ".join(f"contains({source}, {text(w)})" for w in any_of)
    hidden = "".join(f" AND NOT contains({source}, {text(w)})" for w in none_of)
    return f"(({found}){hidden})"


def flag_sql(clue: str = "CLUE_DESC", cause: str = "CAUSE_DESC", occurrence: str = "OCCURN_DESC") -> dict[str, str]:
    """Each keyword flag as a 0/1 expression."""
    groups = [(clue, C.CLUE_KEYWORDS), (cause, C.CAUSE_KEYWORDS), (occurrence, C.OCCURRENCE_KEYWORDS)]
    return {
        name: f"CAST(CASE WHEN {_condition(source, rule)} THEN 1 ELSE 0 END AS BIGINT)"
        for source, table in groups
        for name, rule in table.items()
    }


def all_flag_sql() -> dict[str, str]:
    priority = {
        name: f"CAST(CASE WHEN PRIORITY_VAL = {v} THEN 1 ELSE 0 END AS BIGINT)"
        for name, v in zip(C.PRIORITY_FLAGS, C.PRIORITY_VALUES)
    }
    return flag_sql() | priority


def _features() -> str:
    lines = []
    for i, family in enumerate(tables.FAMILIES):
        lines += [
            f"cs / (n * 100::DOUBLE) + {i} AS {family}Avg", f"cx / 100::DOUBLE + {i} AS {family}Max",
            f"cn / 100::DOUBLE - {i} AS {family}Min",
        ]
    lines += [
        "(cs % 97) / 10::DOUBLE AS precip", "(cs % 31) / 10::DOUBLE AS snowfall",
        "cs / (n * 100::DOUBLE) * 2 AS radSolarAvg", "cx / 100::DOUBLE * 2 AS radSolarMax",
        "cs / 100::DOUBLE AS radSolarTot", "cn / 100::DOUBLE * 2 AS radSolarMin",
        "(cs % 3600) / 10::DOUBLE AS windDir100mAvg", "(cx % 3600) / 10::DOUBLE AS windDir80mAvg",
        "(cs % 3611) / 10::DOUBLE AS windDirAvg",
    ]
    return ",\n  ".join(lines)


def _by_marker(unit: str) -> str:
    return f"""
  SELECT CAST(date_trunc('{unit}', ts) AS TIMESTAMP) AS moment, user_id % 20 + 1 AS marker,
    CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cs, max(CAST(round(value * 100) AS BIGINT)) AS cx,
    min(CAST(round(value * 100) AS BIGINT)) AS cn, count(*) AS n
  FROM events GROUP BY ALL"""


_LOADS = """
  SELECT moment, marker, load_no, n, cs + (load_no - 1) * 100 * n AS cs, cx + (load_no - 1) * 100 AS cx, cn + (load_no - 1) * 100 AS cn
  FROM {} CROSS JOIN (VALUES (1), (2)) AS t(load_no)"""

_FACILITY_CODES = ["01", "00A", "09OD", "0AB", "0CD", "1EF", None]
_CREATED = f"({seconds('o_orderdate')} + (l_orderkey * 7919) % 86400)"

CTES: dict[str, tuple[list[str], str]] = {
    "device": ([], f"SELECT {_DEVICE}, {_DEVICE_CLUE}, {at('1704067200 + (' + seconds('l_shipdate') + ' // 86400 % 30) * 86400 + (l_orderkey * 7919) % 86400')} AS CREATION_DATETIME FROM lineitem"),
    "location": ([], f"""
  SELECT o_orderkey AS INCIDENT_ID, CAST(o_orderkey % 1000 + 1 + 1000 * half AS BIGINT) AS LOCATION_ID, o_custkey AS MAJ_OTG_ID,
    {pick(tables.CITIES, MIX)} AS CITY_NAM,
    CASE WHEN ({MIX}) % 17 <> 0 THEN 30003000 + ({MIX}) % 400 END AS OCCURN_CD,
    CAST(({MIX}) % 300 AS VARCHAR) AS CAUSE_CD,
    CASE WHEN ({MIX}) % 11 <> 0 THEN {at(seconds('o_orderdate') + f' + (({MIX}) * 3571) % 8640000')} END AS ENERGIZED_DATETIME,
    CASE WHEN ({MIX}) % 13 <> 0 THEN CAST(150000 + (o_custkey * 37) % 80000 AS DOUBLE) END AS GEO_X_COORD,
    CASE WHEN ({MIX}) % 13 <> 0 THEN CAST(1600000 + (o_orderkey * 53) % 100000 AS DOUBLE) END AS GEO_Y_COORD
  FROM orders CROSS JOIN (VALUES (0), (1)) AS h(half)"""),
    "facility": ([], f"""
  SELECT {_DEVICE}, l_orderkey * 8 + l_linenumber AS FAC_JOB_ID, o_custkey AS MAJ_OTG_ID,
    {pick(_FACILITY_CODES, 'l_partkey')} AS CLUE_CD,
    CAST(CASE WHEN l_partkey % 13 = 0 THEN 30003001 WHEN l_partkey % 17 <> 0 THEN 99 END AS BIGINT) AS OCCURN_CD,
    {at(_CREATED)} AS CREATION_DATETIME,
    CASE WHEN l_orderkey % 11 <> 0 THEN {at(_CREATED + ' + ((l_partkey * 31) % 3000) * 60')} END AS ENERGIZED_DATETIME,
    {at(_CREATED + ' + ((l_suppkey * 17) % 900 - 60) * 60')} AS ETR_DATETIME
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "clue_map": ([], f"SELECT DISTINCT '0' || (p_partkey % 200 + 200) AS CLUE_CD, {pick(tables.CLUE_TEXTS, 'p_partkey % 200')} AS CLUE_DESC FROM part"),
    "cause_map": ([], f"SELECT DISTINCT CAST(p_partkey % 300 AS VARCHAR) AS CAUSE_CD, {pick(tables.CAUSE_TEXTS, 'p_partkey % 300')} AS CAUSE_DESC FROM part"),
    "occurrence_map": ([], f"SELECT DISTINCT 30003000 + p_partkey % 400 AS OCCURN_CD, {pick(tables.OCCURRENCE_TEXTS, 'p_partkey % 400')} AS OCCURN_DESC FROM part"),
    "joined": (["device", "location"], """
  SELECT d.*, l.MAJ_OTG_ID, l.CITY_NAM, l.OCCURN_CD, l.CAUSE_CD, l.ENERGIZED_DATETIME
  FROM device d LEFT JOIN location l ON d.INCIDENT_ID = l.INCIDENT_ID AND d.LOCATION_ID = l.LOCATION_ID"""),
    "clean_live": (["joined"], f"SELECT * FROM joined WHERE {CLEAN}"),
    "described": (["clean_live", "clue_map", "cause_map", "occurrence_map"], """
  SELECT r.*, CLUE_DESC, CAUSE_DESC, OCCURN_DESC FROM clean_live r LEFT JOIN clue_map USING (CLUE_CD)
  LEFT JOIN occurrence_map USING (OCCURN_CD) LEFT JOIN cause_map USING (CAUSE_CD)"""),
    "clean_facility": (["facility"], f"SELECT * FROM facility WHERE {CLEAN}"),
    "live_grain": (["clean_live"], f"""
  SELECT {_GRAIN}, CAST(coalesce(sum(CALL_QTY), 0) AS BIGINT) AS CALL_QTY, CAST(coalesce(sum(DOWNSTREAM_CUST_QTY), 0) AS BIGINT) AS CUST_QTY,
    max(KVA_VAL) AS KVA_VAL, max(DOWNSTREAM_KVA_VAL) AS DOWNSTREAM_KVA_VAL, max(INCIDENT_DEVICE_ID) AS INCIDENT_DEVICE_ID,
    min(CREATION_DATETIME) AS CREATION_DATETIME, min(SUBST_ID) AS SUBST_ID, max(LOCATION_ID) AS LOCATION_ID,
    max(ENERGIZED_DATETIME) AS ENERGIZED_DATETIME, {_OUTAGE_ID} AS OUTAGE_ID
  FROM clean_live WHERE {_GRAIN_SET} GROUP BY {_GRAIN}"""),
    "facility_grain": (["clean_facility"], f"""
  SELECT {_GRAIN}, CAST(coalesce(sum(CALL_QTY), 0) AS BIGINT) AS CALL_QTY, CAST(coalesce(sum(DOWNSTREAM_CUST_QTY), 0) AS BIGINT) AS CUST_QTY,
    max(KVA_VAL) AS KVA_VAL, max(DOWNSTREAM_KVA_VAL) AS DOWNSTREAM_KVA_VAL, min(CREATION_DATETIME) AS CREATION_DATETIME,
    max(ENERGIZED_DATETIME) AS ENERGIZED_DATETIME, min(SUBST_ID) AS SUBST_ID, max(MAJ_OTG_ID) AS MAJ_OTG_ID,
    max(ETR_DATETIME) AS ETR_DATETIME, {_OUTAGE_ID} AS OUTAGE_ID
  FROM clean_facility WHERE {_GRAIN_SET} GROUP BY {_GRAIN}"""),
    "timed": (["facility_grain"], f"""
  SELECT *, {{ttr}} AS TTR, {{etr}} AS OMS_ETR FROM facility_grain""".format(
        ttr="round_even(round_even((epoch(ENERGIZED_DATETIME) - epoch(CREATION_DATETIME)) / 60::DOUBLE, 4), 0)",
        etr="round_even(round_even((epoch(ETR_DATETIME) - epoch(CREATION_DATETIME)) / 60::DOUBLE, 4) / 60::DOUBLE, 0)",
    )),
    "cities": (["clean_live"], f"""
  SELECT {_GRAIN}, coalesce(min_by(city, (INCIDENT_DEVICE_ID, city)) FILTER (WHERE city <> 'NO_CITY'), 'NO_CITY') AS CITY_NAM
  FROM (SELECT *, CASE WHEN contains(CITY_NAM, 'INDIAN') THEN 'INDIANAPOLIS' ELSE coalesce(CITY_NAM, 'NO_CITY') END AS city FROM clean_live)
  WHERE {_GRAIN_SET} GROUP BY {_GRAIN}"""),
    "live_flags": (["described"], f"""
  SELECT {_GRAIN}, {', '.join(f'max({e}) AS {n}' for n, e in all_flag_sql().items())}
  FROM described WHERE {_GRAIN_SET} GROUP BY {_GRAIN}"""),
    "outage_events": ([], "SELECT CAST(event_id AS VARCHAR) AS OUTAGE_ID, CAST(date_trunc('second', ts) AS TIMESTAMP) AS CREATION_DATETIME, event_type, user_id, value FROM events"),
    "day_markers": ([], _by_marker("day")),
    "hour_markers": ([], _by_marker("hour")),
    "day_loads": (["day_markers"], _LOADS.format("day_markers")),
    "hour_loads": (["hour_markers"], _LOADS.format("hour_markers")),
    "forecast_day": (["day_loads"], f"""
  SELECT moment + INTERVAL 5 HOUR AS "timestamp", 'IPL_Marker' || marker AS Location,
    ([{', '.join(str(a) for a, _ in C.MARKERS)}])[marker]::DOUBLE AS Latitude, ([{', '.join(str(b) for _, b in C.MARKERS)}])[marker]::DOUBLE AS Longitude,
    moment AS timestampInit, moment + load_no * INTERVAL 1 HOUR AS Job_Update_Time,
    (cx % 1000) / 10::DOUBLE AS precipProb, (cn % 1000) / 10::DOUBLE AS snowfallProb, {_features()}
  FROM day_loads"""),
    "latest_day": (["forecast_day"], """
  SELECT * FROM forecast_day QUALIFY row_number() OVER (PARTITION BY "timestamp", Location ORDER BY Job_Update_Time DESC) = 1"""),
    "forecast_hour": (["hour_loads"], """
  SELECT date_trunc('day', moment) + load_no * INTERVAL 1 HOUR AS Job_Update_Time, moment AS "timestamp",
    CAST(date_trunc('day', moment) AS TIMESTAMP) AS timestampInit,
    cs / (n * 100::DOUBLE) AS temp, cx / 1000::DOUBLE AS windSpd, (cn % 1000) / 10::DOUBLE AS snowfallProb,
    (cx % 1000) / 10::DOUBLE AS precipProb, 'IPL_Marker' || marker AS Location
  FROM hour_loads"""),
    "storm_profiles": (["day_markers"], """
  SELECT CAST(moment AS DATE) AS "timestamp", 'Marker ' || marker AS Location, 'Cluster' || (cs % 7 + 1) AS clusters FROM day_markers"""),
    "manifest": ([], """
  SELECT DISTINCT CAST(ts AS DATE) AS day, 'OMS/' || strftime(ts, '%Y%m%d') || '/' ||
    CASE event_type WHEN 'view' THEN 'INCIDENT_DEVICE_IPL' WHEN 'click' THEN 'INCIDENT_IPL' WHEN 'purchase' THEN 'LOCATION_IPL'
      WHEN 'signup' THEN 'INCIDENT_IPL_HIS' WHEN 'error' THEN 'FACILITY_IPL_Daily_HIS' END
    || '_' || lpad(CAST(hour(ts) // 6 * 6 AS VARCHAR), 2, '0') || '0000.csv' AS path FROM events"""),
    "current_files": (["manifest"], """
  SELECT day, feed, CASE WHEN feed = 'history' THEN min(path) ELSE max(path) END AS path FROM (
    SELECT day, path, CASE WHEN contains(path, 'INCIDENT_DEVICE_IPL') AND NOT contains(path, 'HIS') THEN 'device'
      WHEN contains(path, 'INCIDENT_IPL') AND NOT contains(path, 'HIS') THEN 'incident'
      WHEN contains(path, 'LOCATION_IPL') AND NOT contains(path, 'HIS') THEN 'location'
      WHEN contains(path, 'FACILITY_IPL_Daily') AND contains(path, 'HIS') THEN 'history' END AS feed FROM manifest)
  WHERE feed IS NOT NULL GROUP BY day, feed"""),
    "event_coordinates": ([], """
  SELECT CAST(event_id AS VARCHAR) AS OUTAGE_ID, CASE WHEN event_id % 41 <> 0 THEN 39.5::DOUBLE + (event_id * 7 % 500) / 1000::DOUBLE END AS LAT,
    CASE WHEN event_id % 41 <> 0 THEN -86.5::DOUBLE + ((user_id * 13 + event_id) % 700) / 1000::DOUBLE END AS LONG,
    user_id % 40 + 1 AS CUST_QTY FROM events"""),
    "preparations": ([], """
  SELECT Date, CASE WHEN ahead = 1 THEN 'One day ahead' ELSE 'Two days ahead' END AS Number_of_days_ahead,
    n + ahead AS Number_of_outages, CAST(c % 9000 * ahead AS DOUBLE) AS Customer_quantity
  FROM (SELECT CAST(o_orderdate AS DATE) AS Date, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS c FROM orders GROUP BY ALL)
  CROSS JOIN (VALUES (1), (2)) AS a(ahead)"""),
    "markers": ([], "SELECT * FROM (VALUES " + ", ".join(f"({i}, {a}::DOUBLE, {b}::DOUBLE)" for i, (a, b) in enumerate(C.MARKERS, 1)) + ") AS m(idx, mlat, mlon)"),
    "depots": ([], "SELECT * FROM (VALUES " + ", ".join(f"({i}, {text(n)}, {a}::DOUBLE, {b}::DOUBLE)" for i, (n, a, b) in enumerate(C.DEPOTS, 1)) + ") AS d(idx, name, dlat, dlon)"),
}


def sql(needs: str, body: str, extra: dict[str, str] | None = None) -> str:
    """`WITH` the named tables (and what they need) `body`."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for other in CTES[name][0]:
            visit(other)
        order.append(name)

    for name in needs.split():
        visit(name)
    parts = [f"{n} AS ({CTES[n][1]})" for n in order] + [f"{n} AS ({s})" for n, s in (extra or {}).items()]
    return (f"WITH {', '.join(parts)} " if parts else "") + body


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    half = f"pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)"
    return f"(2 * 6371 * atan2(sqrt({half}), sqrt(1 - ({half}))))"


def ladder(column: str, cases: list[tuple[str, object]], default: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN {c.format(column)} THEN {v}" for c, v in cases) + f" ELSE {default} END"



def wind(column: str) -> str:
    return ladder(column, [(f"{{0}} >= {a} AND {{0}} < {b}", text(n)) for a, b, n in C.WIND_SECTORS])


def band(column: str, bands: list[tuple], sign: str) -> str:
    sigma = ladder(column, [(f"{{0}} <= {u}" if u is not None else "{0} IS NOT NULL", f"{s}::DOUBLE") for u, s in bands])
    value = f"{column} {sign} {sigma} * 1.96::DOUBLE"
    value = f"CASE WHEN {column} IS NOT NULL THEN greatest(0, {value}) END" if sign == "-" else value
    return f"CAST(round_even({value}, 0) AS BIGINT)"

"""Queries: filters, joins, aggregates, latest rows, sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from stormgrid import constants as C
from stormgrid.catalog import tables as t
from stormgrid.catalog.oracle import CLEAN, all_flag_sql, sql, stamp
from stormgrid.catalog.registry import query
from stormgrid.functions import flags, times
from stormgrid.operators import aggregate, clean, joins, latest
from stormgrid.plans import diagnostics, restoration

G = ", ".join(C.GRAIN)
CLEAN_COLS = ["FAC_JOB_ID", "INCIDENT_ID", "STRCTUR_NO", "CIRCT_ID", "CLUE_CD", "OCCURN_CD", "EQUIP_STN_NO", "DOWNSTREAM_CUST_QTY"]


def _clean_live(spark, folder):
    return clean.outage_rows(joins.device_locations(t.device(spark, folder), t.location(spark, folder)))


def _described(spark, folder):
    return joins.with_descriptions(
        _clean_live(spark, folder), t.clue_map(spark, folder), t.occurrence_map(spark, folder), t.cause_map(spark, folder)
    )


def _ads(spark, folder):
    return restoration.outage_table(
        t.device(spark, folder), t.location(spark, folder), t.clue_map(spark, folder), t.occurrence_map(spark, folder), t.cause_map(spark, folder)
    )


# ---------------------------------------------------------------- filters and gates
@query("outage_clean_filter", sql("facility", f"SELECT {', '.join(CLEAN_COLS)} FROM facility WHERE {CLEAN}"))
def outage_clean_filter(spark, folder):
    return clean.outage_rows(t.facility(spark, folder)).select(*CLEAN_COLS)


_STAGES = [
    "TRUE",
    "DOWNSTREAM_CUST_QTY > 0",
    "EQUIP_STN_NO IS NOT NULL AND EQUIP_STN_NO <> '<NCC>'",
    "CIRCT_ID <> 0 AND STRCTUR_NO IS NOT NULL AND DNI_EQUIP_TYPE IS NOT NULL",
    "CLUE_CD LIKE '0%' AND CLUE_CD NOT LIKE '00%' AND CLUE_CD NOT IN ('01', '09OD')",
    f"(OCCURN_CD IS NULL OR OCCURN_CD NOT IN ({', '.join(map(str, C.EXCLUDED_OCCURRENCES))}))",
]


@query(
    "stage_row_counts",
    sql("facility", " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS stage_no, '{name}' AS stage, count(*) AS rows_left FROM facility WHERE {' AND '.join(_STAGES[: i + 1])}"
        for i, name in enumerate(["input", *clean.OUTAGE_STAGES])
    )),
)
def stage_row_counts(spark, folder):
    return clean.stage_counts(t.facility(spark, folder))


@query("still_out", sql("location", "SELECT INCIDENT_ID, LOCATION_ID FROM location WHERE ENERGIZED_DATETIME IS NULL OR CAST(ENERGIZED_DATETIME AS DATE) = DATE '1900-01-01'"))
def still_out(spark, folder):
    return clean.still_out(t.location(spark, folder)).select("INCIDENT_ID", "LOCATION_ID")


_ALL_FACILITY = "STRCTUR_NO EQUIP_STN_NO KVA_VAL SUBST_ID CLUE_CD OCCURN_CD ENERGIZED_DATETIME".split()


@query("drop_any_null", sql("facility", f"SELECT FAC_JOB_ID, {', '.join(_ALL_FACILITY[:-1])} FROM facility WHERE {' AND '.join(c + ' IS NOT NULL' for c in _ALL_FACILITY)}"))
def drop_any_null(spark, folder):
    return clean.drop_any_null(t.facility(spark, folder)).select("FAC_JOB_ID", *_ALL_FACILITY[:-1])


_ETR = "round_even(round_even((epoch(ETR_DATETIME) - epoch(CREATION_DATETIME)) / 60::DOUBLE, 4) / 60::DOUBLE, 0)"
_TTR = "round_even(round_even((epoch(ENERGIZED_DATETIME) - epoch(CREATION_DATETIME)) / 60::DOUBLE, 4), 0)"


@query("negative_to_null", sql("facility", f"SELECT FAC_JOB_ID, CASE WHEN {_ETR} >= 0 THEN {_ETR} END AS OMS_ETR FROM facility"))
def negative_to_null(spark, folder):
    rows = t.facility(spark, folder)
    hours = times.promised_hours(F.col("CREATION_DATETIME"), F.col("ETR_DATETIME"))
    return clean.negative_to_null(rows.select("FAC_JOB_ID", hours.alias("OMS_ETR")), "OMS_ETR")


@query("duration_minutes", sql("facility", f"SELECT FAC_JOB_ID, {_TTR} AS TTR, {_ETR} + 0 AS OMS_ETR FROM facility"))
def duration_minutes(spark, folder):
    created = F.col("CREATION_DATETIME")
    return t.facility(spark, folder).select(
        "FAC_JOB_ID",
        times.restoration_minutes(created, F.col("ENERGIZED_DATETIME")).alias("TTR"),
        (times.promised_hours(created, F.col("ETR_DATETIME")) + 0).alias("OMS_ETR"),
    )


# ---------------------------------------------------------------- joins
@query(
    "device_location_join",
    sql("joined", f"SELECT INCIDENT_ID, LOCATION_ID, INCIDENT_DEVICE_ID, MAJ_OTG_ID, CITY_NAM, OCCURN_CD, CAUSE_CD, {stamp('ENERGIZED_DATETIME')} AS ENERGIZED_DATETIME FROM joined"),
)
def device_location_join(spark, folder):
    joined = joins.device_locations(t.device(spark, folder), t.location(spark, folder))
    return joined.select("INCIDENT_ID", "LOCATION_ID", "INCIDENT_DEVICE_ID", *joins.LOCATION_FIELDS)


@query("code_star_join", sql("described", "SELECT INCIDENT_ID, INCIDENT_DEVICE_ID, CLUE_DESC, CAUSE_DESC, OCCURN_DESC FROM described"))
def code_star_join(spark, folder):
    return _described(spark, folder).select("INCIDENT_ID", "INCIDENT_DEVICE_ID", "CLUE_DESC", "CAUSE_DESC", "OCCURN_DESC")


@query(
    "not_yet_predicted",
    sql("outage_events", "SELECT OUTAGE_ID, event_type FROM outage_events o WHERE NOT EXISTS "
        "(SELECT 1 FROM orders p WHERE CAST(p.o_orderkey AS VARCHAR) = o.OUTAGE_ID AND p.o_orderstatus = 'F')"),
)
def not_yet_predicted(spark, folder):
    predicted = t.load(spark, folder, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("string").alias("OUTAGE_ID"))
    return joins.not_yet_predicted(t.outage_events(spark, folder), predicted).select("OUTAGE_ID", "event_type")


_SIDES = {
    "a": "SELECT CAST(o_orderdate AS DATE) AS Date, o_orderpriority AS tag, count(*) AS orders_a FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL",
    "b": "SELECT CAST(o_orderdate AS DATE) AS Date, o_orderpriority AS tag, count(*) AS orders_b FROM orders WHERE o_orderstatus <> 'F' GROUP BY ALL",
}


@query("full_outer_all_common", sql("", "SELECT CAST(Date AS VARCHAR) AS Date, tag, orders_a, orders_b FROM a FULL JOIN b USING (Date, tag)", _SIDES))
def full_outer_all_common(spark, folder):
    orders = t.load(spark, folder, "orders")

    def side(rows, name):
        keys = [F.to_date("o_orderdate").alias("Date"), F.col("o_orderpriority").alias("tag")]
        return orders.where(rows).groupBy(*keys).agg(F.count("*").alias(name))

    finished = F.col("o_orderstatus") == "F"
    return joins.full_outer_on_common(side(finished, "orders_a"), side(~finished, "orders_b"))


# ---------------------------------------------------------------- aggregates
_LIVE_GRAIN = (
    f"{G}, CALL_QTY, CUST_QTY, KVA_VAL, DOWNSTREAM_KVA_VAL, INCIDENT_DEVICE_ID, {stamp('CREATION_DATETIME')} AS CREATION_DATETIME, "
    f"SUBST_ID, LOCATION_ID, {stamp('ENERGIZED_DATETIME')} AS ENERGIZED_DATETIME, OUTAGE_ID"
)


@query("outage_grain_agg", sql("live_grain", f"SELECT {_LIVE_GRAIN} FROM live_grain"))
def outage_grain_agg(spark, folder):
    return aggregate.outage_grain(_clean_live(spark, folder))


@query(
    "facility_grain_agg",
    sql("facility_grain", f"SELECT {G}, CALL_QTY, CUST_QTY, KVA_VAL, DOWNSTREAM_KVA_VAL, {stamp('CREATION_DATETIME')} AS CREATION_DATETIME, "
        f"{stamp('ENERGIZED_DATETIME')} AS ENERGIZED_DATETIME, SUBST_ID, MAJ_OTG_ID, {stamp('ETR_DATETIME')} AS ETR_DATETIME, OUTAGE_ID FROM facility_grain"),
)
def facility_grain_agg(spark, folder):
    return diagnostics.facility_outages(t.facility(spark, folder))


@query("outage_flags_agg", sql("live_flags", "SELECT * FROM live_flags"))
def outage_flags_agg(spark, folder):
    masked = joins.with_flag_masks(
        _clean_live(spark, folder), t.clue_map(spark, folder), t.occurrence_map(spark, folder), t.cause_map(spark, folder)
    )
    return aggregate.outage_flags(masked)


@query("city_resolution", sql("cities", "SELECT * FROM cities"))
def city_resolution(spark, folder):
    return aggregate.outage_cities(_clean_live(spark, folder))


ADS_COLS = ["OUTAGE_ID", *C.GRAIN, "CALL_QTY", "CUST_QTY", "KVA_VAL", "SUBST_ID", "LOCATION_ID", "CITY_NAM", "DAY_FLAG", *C.KEYWORD_FLAGS, *C.PRIORITY_FLAGS]


@query(
    "outage_ads",
    sql("live_grain live_flags cities", f"SELECT {', '.join(c for c in ADS_COLS if c != 'DAY_FLAG')}, "
        "CAST(CASE WHEN hour(CREATION_DATETIME) BETWEEN 6 AND 17 THEN 1 ELSE 0 END AS BIGINT) AS DAY_FLAG, "
        "round(sin(hour(CREATION_DATETIME) * 2 * pi() / 24), 8) + 0 AS Hour_Sin, round(cos(hour(CREATION_DATETIME) * 2 * pi() / 24), 8) + 0 AS Hour_Cos "
        f"FROM live_grain JOIN live_flags USING ({G}) JOIN cities USING ({G})"),
)
def outage_ads(spark, folder):
    return _ads(spark, folder).select(*ADS_COLS, *[(F.round(c, 8) + 0).alias(c) for c in ("Hour_Sin", "Hour_Cos")])


@query("outage_id", sql("clean_facility", f"SELECT FAC_JOB_ID, CAST(INCIDENT_ID AS VARCHAR) || STRCTUR_NO || CIRCT_ID || DNI_EQUIP_TYPE AS OUTAGE_ID FROM clean_facility"))
def outage_id(spark, folder):
    return clean.outage_rows(t.facility(spark, folder)).select("FAC_JOB_ID", flags.outage_label().alias("OUTAGE_ID"))


_FLAG_OF = dict(zip(C.DAILY_COUNTERS.values(), ["view", "click", "purchase", "signup", "error"]))
_COUNTS = ", ".join(f"CAST(sum(CASE WHEN event_type = '{_FLAG_OF[f]}' THEN 1 ELSE 0 END) AS BIGINT) AS {n}" for n, f in C.DAILY_COUNTERS.items())


@query("daily_clue_counts", sql("", f"SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS Date, {_COUNTS} FROM events GROUP BY ALL"))
def daily_clue_counts(spark, folder):
    return aggregate.daily_counters(t.event_flags(spark, folder))


@query("running_clue_counts", sql("", f"SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS Date, {_COUNTS} FROM events GROUP BY ALL"))
def running_clue_counts(spark, folder):
    """Two batches (morning and afternoon starts) merged into one running table."""
    rows = t.event_flags(spark, folder)
    morning = F.hour("CREATION_DATETIME") < 12
    state = aggregate.daily_counters(rows.where(morning))
    return aggregate.merge_counters(state, aggregate.daily_counters(rows.where(~morning)))


@query("distinct_incidents", sql("", "SELECT count(DISTINCT l_orderkey) AS distinct_ids FROM lineitem"))
def distinct_incidents(spark, folder):
    return aggregate.distinct_count(t.device(spark, folder), "INCIDENT_ID")


_ACTUALS = "SELECT CAST(CAST(CREATION_DATETIME AS DATE) AS VARCHAR) AS Date, CAST(sum(CUST_QTY) AS BIGINT) AS CUST_QTY, count(OUTAGE_ID) AS Outages_recorded FROM timed WHERE TTR > 30 GROUP BY 1"


@query("daily_actuals", sql("timed", _ACTUALS))
def daily_actuals(spark, folder):
    return aggregate.daily_actuals(diagnostics.facility_outages(t.facility(spark, folder)))


_STATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "column_stats",
    sql("", " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS min, max({c}) AS max FROM lineitem" for c in _STATS
    )),
)
def column_stats(spark, folder):
    stats = aggregate.column_statistics(t.load(spark, folder, "lineitem"), _STATS)
    return stats.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


_PROFILED = ["STRCTUR_NO", "EQUIP_STN_NO", "KVA_VAL", "SUBST_ID", "CLUE_CD", "PRIORITY_VAL", "CREATION_DATETIME"]


@query(
    "null_profile",
    sql("device", " UNION ALL ".join(f"SELECT '{c}' AS feature, count(*) - count({c}) AS nulls, CAST(count(*) > count({c}) AS BIGINT) AS has_nulls FROM device" for c in _PROFILED)),
)
def null_profile(spark, folder):
    return aggregate.null_profile(t.device(spark, folder), _PROFILED)


@query(
    "grain_violations",
    sql("device", "SELECT INCIDENT_ID, LOCATION_ID, count(*) AS rows_per_key FROM device GROUP BY ALL HAVING count(*) > 1"),
)
def grain_violations(spark, folder):
    return aggregate.grain_violations(t.device(spark, folder), ["INCIDENT_ID", "LOCATION_ID"])


@query(
    "duplicate_summary",
    sql("device", "SELECT count(*) AS rows_total, count(DISTINCT (INCIDENT_ID, LOCATION_ID)) AS rows_distinct FROM device"),
)
def duplicate_summary(spark, folder):
    return aggregate.duplicate_summary(t.device(spark, folder), ["INCIDENT_ID", "LOCATION_ID"])


# ---------------------------------------------------------------- flags
@query(
    "keyword_flags",
    sql("described", f"SELECT INCIDENT_DEVICE_ID, INCIDENT_ID, {', '.join(f'{e} AS {n}' for n, e in list(all_flag_sql().items())[:47])} FROM described"),
)
def keyword_flags(spark, folder):
    """Flags are found once per code and travel to the rows as packed numbers."""
    masked = joins.with_flag_masks(
        _clean_live(spark, folder), t.clue_map(spark, folder), t.occurrence_map(spark, folder), t.cause_map(spark, folder)
    )
    masked = masked.select("INCIDENT_DEVICE_ID", "INCIDENT_ID", *aggregate.KEYWORD_MASKS)
    return flags.unpack(masked, aggregate.KEYWORD_MASKS)


@query(
    "priority_onehot",
    sql("device", f"SELECT INCIDENT_ID, INCIDENT_DEVICE_ID, {', '.join(f'{e} AS {n}' for n, e in list(all_flag_sql().items())[47:])} FROM device"),
)
def priority_onehot(spark, folder):
    found = flags.priority_flags("PRIORITY_VAL")
    return t.device(spark, folder).select("INCIDENT_ID", "INCIDENT_DEVICE_ID", *[c.alias(n) for n, c in found.items()])


_EVENT_FLAGS = list(C.DAILY_COUNTERS.values())
_TEXT = {f: f"CASE WHEN event_type = '{_FLAG_OF[f]}' THEN 'True' WHEN event_type IS NOT NULL THEN 'False' END" for f in _EVENT_FLAGS}


@query("flag_to_text", sql("", f"SELECT CAST(event_id AS VARCHAR) AS OUTAGE_ID, {', '.join(f'{e} AS {f}' for f, e in _TEXT.items())} FROM events"))
def flag_to_text(spark, folder):
    return flags.flags_to_text(t.event_flags(spark, folder), _EVENT_FLAGS).drop("CREATION_DATETIME")


_IND = {f"{f}_False": f"CAST(CASE WHEN {f} = 0 THEN 1 ELSE 0 END AS BIGINT)" for f in C.INDICATORS_FALSE}
_IND |= {f"{f}_True": f"CAST(CASE WHEN {f} = 1 THEN 1 ELSE 0 END AS BIGINT)" for f in C.INDICATORS_TRUE if f != "DAY_FLAG"}
_IND["DAY_FLAG_True"] = "CAST(CASE WHEN hour(CREATION_DATETIME) BETWEEN 6 AND 17 THEN 1 ELSE 0 END AS BIGINT)"
_IND["CITY_NAM_NO_CITY"] = "CAST(CASE WHEN CITY_NAM = 'NO_CITY' THEN 1 ELSE 0 END AS BIGINT)"


@query(
    "model_indicators",
    sql("live_grain live_flags cities", f"SELECT {G}, {', '.join(f'{e} AS {n}' for n, e in _IND.items())} FROM live_grain JOIN live_flags USING ({G}) JOIN cities USING ({G})"),
)
def model_indicators(spark, folder):
    worded = flags.flags_to_text(_ads(spark, folder))
    return flags.model_indicators(worded).select(*C.GRAIN, *_IND)


# ---------------------------------------------------------------- latest, sets
_VERSIONS = """
  SELECT user_id, event_type, CAST(date_trunc('second', ts) AS TIMESTAMP) AS ts, event_id FROM events"""


@query(
    "upsert_latest",
    sql("", f"SELECT user_id, event_type, {stamp('ts')} AS ts, event_id FROM v QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY (event_id % 2) DESC, event_id DESC) = 1", {"v": _VERSIONS}),
)
def upsert_latest(spark, folder):
    """Even ids are the history, odd ids the batch; both hold many versions of a key."""
    rows = t.load(spark, folder, "events").select("user_id", "event_type", F.date_trunc("second", F.col("ts").cast("timestamp")).alias("ts"), "event_id")
    odd = F.col("event_id") % 2 == 1
    return latest.upsert(rows.where(~odd), rows.where(odd), ["user_id", "event_type"], ["event_id"])


@query("distinct_rows", sql("", "SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey, l_linenumber::BIGINT AS l_linenumber FROM lineitem"))
def distinct_rows(spark, folder):
    return t.load(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_suppkey", "l_linenumber").distinct()


@query("distinct_dates", sql("", "SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS Date FROM orders"))
def distinct_dates(spark, folder):
    return t.load(spark, folder, "orders").select(F.to_date("o_orderdate").alias("Date")).distinct()


@query(
    "union_by_name",
    sql("", "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier"),
)
def union_by_name(spark, folder):
    customers = t.load(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    suppliers = t.load(spark, folder, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return latest.union_all(customers, suppliers)


@query("top1_latest", sql("", f"SELECT event_id, {stamp('ts')} AS ts, event_type FROM events ORDER BY events.ts DESC, event_id DESC LIMIT 1"))
def top1_latest(spark, folder):
    top = latest.top_one(t.load(spark, folder, "events"), [F.col("ts").desc(), F.col("event_id").desc()])
    return top.select("event_id", "ts", "event_type")


# ---------------------------------------------------------------- actual against predicted
def predictions(spark, folder):
    """Stored predictions: outages of two device kinds, with a duration from their id."""
    outages = diagnostics.facility_outages(t.facility(spark, folder)).where("DNI_EQUIP_TYPE <> 'R'")
    return outages.select(
        "OUTAGE_ID", *C.GRAIN,
        times.slash_stamp(F.col("CREATION_DATETIME")).alias("Creation_Time"),
        times.slash_stamp(F.col("CREATION_DATETIME")).alias("Estimated_Restoration_Time"),
        (F.col("INCIDENT_ID") * 13 % 2000).cast("double").alias("ETR"),
        F.when(F.col("INCIDENT_ID") % 9 != 0, "Thunderstorms").alias("Weather_Profile"),
        F.lit("2024-01-31 00:00").alias("Last_Updated"),
    )


@query(
    "restoration_diagnostic",
    sql("timed", f"""SELECT t.OUTAGE_ID, {', '.join('t.' + k for k in C.GRAIN)}, {stamp('CREATION_DATETIME')} AS CREATION_DATETIME,
      {stamp('ENERGIZED_DATETIME')} AS ENERGIZED_DATETIME, CAST(TTR AS BIGINT) AS TTR, strftime(CREATION_DATETIME, '%Y/%m/%d %H:%M:%S') AS Creation_Time,
      CAST((t.INCIDENT_ID * 13) % 2000 AS BIGINT) AS ETR, {stamp('ETR_DATETIME')} AS ETR_DATETIME, CASE WHEN OMS_ETR >= 0 THEN OMS_ETR END AS OMS_ETR
      FROM (SELECT * FROM timed QUALIFY row_number() OVER (PARTITION BY OUTAGE_ID ORDER BY {', '.join(k + ' DESC' for k in C.GRAIN)}) = 1) t
      WHERE TTR > 30 AND ENERGIZED_DATETIME IS NOT NULL AND EXISTS (
        SELECT 1 FROM timed p WHERE p.OUTAGE_ID = t.OUTAGE_ID AND p.DNI_EQUIP_TYPE <> 'R' AND p.INCIDENT_ID % 9 <> 0)"""),
)
def restoration_diagnostic(spark, folder):
    result = diagnostics.restoration_diagnostic(t.facility(spark, folder), predictions(spark, folder))
    return result.drop("Estimated_Restoration_Time", "Weather_Profile", "Last_Updated")


@query(
    "storm_actual_vs_predicted",
    sql("timed preparations", f"SELECT a.Date, a.CUST_QTY, a.Outages_recorded, p.Number_of_days_ahead, p.Number_of_outages, p.Customer_quantity "
        f"FROM a JOIN preparations p ON a.Date = CAST(p.Date AS VARCHAR)", {"a": _ACTUALS}),
)
def storm_actual_vs_predicted(spark, folder):
    return diagnostics.day_comparison(t.facility(spark, folder), t.preparations(spark, folder))

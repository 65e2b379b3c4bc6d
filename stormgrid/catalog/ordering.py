"""Queries: ranks, trailing counts, forward fill, the curated live outages."""

from __future__ import annotations

from pyspark.sql import functions as F

from stormgrid import constants as C
from stormgrid.catalog import tables as t
from stormgrid.catalog.expressions import PLANE, geodesic
from stormgrid.catalog.oracle import haversine, sql, stamp, wind
from stormgrid.catalog.registry import query
from stormgrid.catalog.weather import PROFILE_SQL
from stormgrid.functions import flags, geo, times
from stormgrid.models import forecasts
from stormgrid.operators import aggregate, clean, joins, latest, ordered, trailing
from stormgrid.plans import diagnostics, restoration
from stormgrid.session import materialize, work_path
from stormgrid.sources import sinks, snapshots


@query("rank_subsequent", sql("outage_events", "SELECT OUTAGE_ID, dense_rank() OVER (PARTITION BY CAST(CREATION_DATETIME AS DATE) ORDER BY CREATION_DATETIME) AS RANK_SUBSEQUENT_OUTAGES FROM outage_events"))
def rank_subsequent(spark, folder):
    ranked = ordered.rank_within_day(t.outage_events(spark, folder), "CREATION_DATETIME", "RANK_SUBSEQUENT_OUTAGES")
    return ranked.select("OUTAGE_ID", "RANK_SUBSEQUENT_OUTAGES")


@query("exact_median", sql("", "SELECT median(l_extendedprice) AS median FROM lineitem"))
def exact_median(spark, folder):
    return ordered.exact_median(t.load(spark, folder, "lineitem"), "l_extendedprice")


def live_and_history(spark, folder):
    """Live: three event types. History: three types, the shared one 90 seconds later."""
    events = t.outage_events(spark, folder).select("OUTAGE_ID", "CREATION_DATETIME", "event_type")
    live = events.where(F.col("event_type").isin("purchase", "signup", "error")).drop("event_type")
    history = events.where(F.col("event_type").isin("purchase", "view", "click"))
    moved = F.when(F.col("event_type") == "purchase", F.col("CREATION_DATETIME") + F.expr("INTERVAL 90 SECONDS"))
    return live, history.select("OUTAGE_ID", F.coalesce(moved, "CREATION_DATETIME").alias("CREATION_DATETIME"))


TRAILING = ", ".join(f"count(e.s) FILTER (WHERE e.s >= p.s - {3600 * k}) AS Outages_in_last_{k}hr" for k in range(1, 11))


@query(
    "trailing_hour_counts",
    sql("", f"SELECT p.OUTAGE_ID, {stamp('make_timestamp(p.s * 1000000)')} AS CREATION_DATETIME, {TRAILING} FROM p LEFT JOIN e ON e.s < p.s AND e.s >= p.s - 36000 GROUP BY 1, 2",
        {"p": "SELECT CAST(event_id AS VARCHAR) AS OUTAGE_ID, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events WHERE event_type IN ('purchase', 'signup', 'error')",
         "e": "SELECT CAST(floor(epoch(ts)) AS BIGINT) + CASE WHEN event_type = 'purchase' THEN 90 ELSE 0 END AS s FROM events"}),
)
def trailing_hour_counts(spark, folder):
    live, history = live_and_history(spark, folder)
    return trailing.trailing_counts(live, trailing.known_outages(live, history))


def filled(name: str, order: str) -> str:
    return f"last_value({name} IGNORE NULLS) OVER (ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@query(
    "ffill_coordinates",
    sql("location", f"SELECT INCIDENT_ID, LOCATION_ID, round({filled('LAT', 'INCIDENT_ID, LOCATION_ID')}, 8) AS LAT, round({filled('LONG', 'INCIDENT_ID, LOCATION_ID')}, 8) AS LONG FROM plane", PLANE),
)
def ffill_coordinates(spark, folder):
    placed = geo.with_state_plane_degrees(t.location(spark, folder), "GEO_X_COORD", "GEO_Y_COORD")
    rows = ordered.forward_fill(placed.select("INCIDENT_ID", "LOCATION_ID", "LAT", "LONG"), ["LAT", "LONG"], ["INCIDENT_ID", "LOCATION_ID"])
    return rows.withColumns({c: F.round(c, 8) for c in ("LAT", "LONG")})


_GAPS = ["CITY_NAM", "OCCURN_CD", "ENERGIZED_DATETIME", "GEO_X_COORD"]
_ORDER = ["MAJ_OTG_ID", "INCIDENT_ID", "LOCATION_ID"]


@query(
    "ffill_all",
    sql("location", f"""SELECT {', '.join(_ORDER)}, coalesce({filled('CITY_NAM', ', '.join(_ORDER))}, 'NO_CITY') AS CITY_NAM, {filled('OCCURN_CD', ', '.join(_ORDER))} AS OCCURN_CD,
      {stamp(filled('ENERGIZED_DATETIME', ', '.join(_ORDER)))} AS ENERGIZED_DATETIME, {filled('GEO_X_COORD', ', '.join(_ORDER))} AS GEO_X_COORD FROM location"""),
)
def ffill_all(spark, folder):
    rows = ordered.forward_fill(t.location(spark, folder).select(*_ORDER, *_GAPS), _GAPS, _ORDER)
    return rows.withColumn("CITY_NAM", F.coalesce("CITY_NAM", F.lit(C.NO_CITY)))


# ---------------------------------------------------------------- located and curated outages
def live_feeds(spark, folder):
    return t.device(spark, folder), t.location(spark, folder), t.clue_map(spark, folder), t.occurrence_map(spark, folder), t.cause_map(spark, folder)


def live_table(spark, folder):
    return restoration.outage_table(*live_feeds(spark, folder))


_ZONE = "CASE WHEN LAT < 39.7684::DOUBLE THEN CASE WHEN LONG < -86.1581::DOUBLE THEN 'ZONE1' ELSE 'ZONE2' END ELSE CASE WHEN LONG < -86.1581::DOUBLE THEN 'ZONE4' ELSE 'ZONE3' END END"
_G = ", ".join(C.GRAIN)
_PLACED = PLANE | {
    "placed": f"SELECT g.*, p.LAT, p.LONG, {_ZONE.replace('LAT', 'p.LAT').replace('LONG', 'p.LONG')} AS ZONE FROM live_grain g LEFT JOIN plane p ON g.INCIDENT_ID = p.INCIDENT_ID AND g.LOCATION_ID = p.LOCATION_ID"
}


@query("outage_geo", sql("live_grain", "SELECT OUTAGE_ID, LOCATION_ID, round(LAT, 8) AS LAT, round(LONG, 8) AS LONG, ZONE FROM placed", _PLACED))
def outage_geo(spark, folder):
    placed = joins.with_coordinates(live_table(spark, folder), t.location(spark, folder))
    return placed.select("OUTAGE_ID", "LOCATION_ID", F.round("LAT", 8).alias("LAT"), F.round("LONG", 8).alias("LONG"), "ZONE")


FEATURES = ["tempAvg", "tempMax", "windDirAvg", "precip"]
_FLAGS = list(C.DAILY_COUNTERS.values())
_TEXTED = [*_FLAGS, "TREE_CAUSE_FLG", "ST_OCCURN_FLG"]
_BY_TIME = f"CREATION_DATETIME, {_G}"
_CURATED = _PLACED | {
    "ranked": "SELECT *, dense_rank() OVER (PARTITION BY CAST(CREATION_DATETIME AS DATE) ORDER BY CREATION_DATETIME) AS RANK_SUBSEQUENT_OUTAGES FROM placed",
    "spread": f"SELECT * EXCLUDE (LAT, LONG), {filled('LAT', _G + ', LOCATION_ID')} AS LAT, {filled('LONG', _G + ', LOCATION_ID')} AS LONG FROM ranked",
    "open_rows": "SELECT * FROM spread WHERE ENERGIZED_DATETIME IS NULL",
    "marked": f"SELECT o.*, m.idx FROM open_rows o CROSS JOIN markers m QUALIFY row_number() OVER (PARTITION BY OUTAGE_ID ORDER BY {haversine('LAT', 'LONG', 'mlat', 'mlon')}, m.idx) = 1",
    "pairs": "SELECT OUTAGE_ID, LAT, LONG, idx, name, dlat, dlon FROM open_rows CROSS JOIN depots",
    **geodesic("pairs", "LAT", "LONG", "dlat", "dlon"),
    "depot": "SELECT OUTAGE_ID, name FROM geo QUALIFY row_number() OVER (PARTITION BY OUTAGE_ID ORDER BY miles, idx) = 1",
    "located": f"""SELECT o.*, 'Marker ' || o.idx AS Marker_Location, d.name AS Dispatch_Location, {', '.join('w.' + f for f in FEATURES)},
      {wind('w.windDirAvg')} AS WIND_DIRECTION, CAST(CASE WHEN isodow(CREATION_DATETIME) >= 6 THEN 1 ELSE 0 END AS BIGINT) AS weekend_flag,
      dense_rank() OVER (ORDER BY CUST_QTY DESC) AS Priority_Customer_Qty,
      CASE WHEN hour(CREATION_DATETIME) BETWEEN 6 AND 17 THEN 'True' ELSE 'False' END AS DAY_FLAG
      FROM marked o JOIN depot d USING (OUTAGE_ID)
      LEFT JOIN latest_day w ON CAST(CREATION_DATETIME AS DATE) = CAST(w."timestamp" AS DATE) AND w.Location = 'IPL_Marker' || o.idx""",
    "fresh": f"SELECT l.*, c.CITY_NAM, {', '.join('f.' + f for f in _TEXTED)} FROM located l JOIN cities c USING ({_G}) JOIN live_flags f USING ({_G}) WHERE DNI_EQUIP_TYPE <> 'R'",
    "counted": f"SELECT CAST(CREATION_DATETIME AS DATE) AS d, {', '.join(f'CAST(sum({f}) AS BIGINT) AS {n}' for n, f in C.DAILY_COUNTERS.items())} FROM fresh GROUP BY 1",
    "known": """SELECT CAST(epoch(CREATION_DATETIME) AS BIGINT) AS s FROM fresh UNION ALL SELECT CAST(epoch(CREATION_DATETIME) AS BIGINT) FROM live_grain WHERE DNI_EQUIP_TYPE = 'R'""",
    "hours_before": f"SELECT p.OUTAGE_ID, {TRAILING} FROM (SELECT OUTAGE_ID, CAST(epoch(CREATION_DATETIME) AS BIGINT) AS s FROM fresh) p LEFT JOIN known e ON e.s < p.s AND e.s >= p.s - 36000 GROUP BY 1",
}
CURATED_COLS = [
    "OUTAGE_ID", "CUST_QTY", "LOCATION_ID", "ZONE", "RANK_SUBSEQUENT_OUTAGES", "Marker_Location", "Dispatch_Location", *FEATURES,
    "WIND_DIRECTION", "weekend_flag", "Priority_Customer_Qty", "CITY_NAM", "DAY_FLAG", *C.DAILY_COUNTERS,
]
_FILLED_SQL = {
    "SUBST_ID": filled("SUBST_ID", _BY_TIME),
    "KVA_VAL": "DOWNSTREAM_KVA_VAL",
    "DOWNSTREAM_CUST_QTY": "CUST_QTY",
    **{f: f"CASE WHEN {f} = 1 THEN 'True' ELSE 'False' END" for f in _TEXTED},
    **{f"Outages_in_last_{k}hr": f"Outages_in_last_{k}hr" for k in range(1, 11)},
}
_FILL = ["WIND_DIRECTION", *FEATURES]


_CURATED["once"] = (
    f"SELECT {', '.join(filled(c, _BY_TIME) + ' AS ' + c if c in _FILL else c for c in CURATED_COLS)}, {', '.join(f'{e} AS {n}' for n, e in _FILLED_SQL.items())} "
    "FROM fresh LEFT JOIN counted ON CAST(CREATION_DATETIME AS DATE) = d JOIN hours_before USING (OUTAGE_ID)"
)


def predicted_outages(outages):
    """Outages of one device kind count as predicted already."""
    return outages.where("DNI_EQUIP_TYPE = 'R'").select("OUTAGE_ID", times.slash_stamp(F.col("CREATION_DATETIME")).alias("Creation_Time"))


@query(
    "live_outage_dataset",
    sql("live_grain live_flags cities latest_day markers depots",
        f"SELECT {', '.join(filled(c, 'OUTAGE_ID') + ' AS ' + c if c in [*_FILL, 'SUBST_ID'] else c for c in [*CURATED_COLS, *_FILLED_SQL])} FROM once", _CURATED),
)
def live_outage_dataset(spark, folder):
    """Raw feeds to the curated table the restoration model scores."""
    return curated_live(spark, folder).select(*CURATED_COLS, *_FILLED_SQL)


def curated_live(spark, folder, run_ts=None):
    """The outages are read by several steps, so they are stored once."""
    outages = restoration.stored_outages(*live_feeds(spark, folder))
    located = restoration.located_outages(outages, t.location(spark, folder), run_ts, clean.without_power())
    weathered = restoration.weather_outages(located, t.forecast_day(spark, folder), FEATURES, outages)
    return restoration.curated_outages(weathered, predicted_outages(outages))[0]


RUN_TS = "2024-01-31 12:00:00"
MODEL_INPUTS = [
    "CALL_QTY", "CUST_QTY", "DOWNSTREAM_KVA_VAL", "Hour_Sin", "Hour_Cos", "weekend_flag", "RANK_SUBSEQUENT_OUTAGES", "Priority_Customer_Qty",
    "Priority_Dist_Customer_Qty", *FEATURES, *[f"Outages_in_last_{k}hr" for k in range(1, C.TRAILING_HOURS + 1)],
    *[f"{name}_False" for name in C.INDICATORS_FALSE], *[f"{name}_True" for name in C.INDICATORS_TRUE], "CITY_NAM_NO_CITY",
]


@query(
    "published_predictions",
    sql("live_grain live_flags cities latest_day markers depots storm_profiles",
        f"""SELECT place, OUTAGE_ID, INCIDENT_ID, STRCTUR_NO, CIRCT_ID, DNI_EQUIP_TYPE, strftime(CREATION_DATETIME, '%Y/%m/%d %H:%M:%S') AS Creation_Time,
          CASE WHEN clusters IS NOT NULL THEN {PROFILE_SQL} END AS Weather_Profile, '{RUN_TS[:16]}' AS Last_Updated, CAST({RUN_TS[:16].translate(str.maketrans('', '', '-: '))} AS BIGINT) AS INSERTION_TIME, CAST(1 AS BIGINT) AS timed
        FROM fresh f LEFT JOIN storm_profiles b ON CAST(f.CREATION_DATETIME AS DATE) = CAST(b."timestamp" AS DATE) AND f.Marker_Location = b.Location
        CROSS JOIN (VALUES ('history'), ('history'), ('live')) AS p(place)""", _CURATED),
)
def published_predictions(spark, folder):
    """Two runs from the raw feeds to both published tables; the forest learns from the history's durations."""
    run_ts = F.lit(RUN_TS).cast("timestamp")
    curated = materialize(curated_live(spark, folder, run_ts), codec="zstd")
    actual = aggregate.with_restoration_minutes(diagnostics.facility_outages(t.facility(spark, folder))).select("OUTAGE_ID", "TTR")
    model = forecasts.fit_restoration(flags.model_indicators(curated).join(actual, "OUTAGE_ID"), MODEL_INPUTS, trees=5, depth=4)
    root = work_path(spark, "predictions")
    for run in ("first", "second", "second"):  # the repeated run changes nothing
        restoration.publish_predictions(curated, model, t.storm_profiles(spark, folder), run_ts, root, run)
    both = latest.union_all(*[snapshots.read(spark, root, place).withColumn("place", F.lit(place)) for place in (sinks.HISTORY, sinks.LIVE)])
    return both.select(
        "place", "OUTAGE_ID", "INCIDENT_ID", "STRCTUR_NO", "CIRCT_ID", "DNI_EQUIP_TYPE", "Creation_Time", "Weather_Profile", "Last_Updated", "INSERTION_TIME",
        F.col("Estimated_Restoration_Time").isNotNull().cast("int").alias("timed"),
    )

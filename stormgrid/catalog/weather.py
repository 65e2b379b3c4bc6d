"""Queries: forecast scans, weather joins, roll-ups, the daily tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stormgrid import constants as C
from stormgrid.catalog import tables as t
from stormgrid.catalog.oracle import ladder, sql, stamp, text, wind
from stormgrid.catalog.registry import query
from stormgrid.functions import times, weather
from stormgrid.operators import aggregate, joins, latest, reshape
from stormgrid.plans import daily_summary, weather_view
from stormgrid.session import work_path
from stormgrid.sources import sinks, warehouse

TODAY = "2024-01-15"
NOW = "2024-01-15 08:00:00"


@query(
    "forecast_day_scan",
    sql("forecast_day", f"""SELECT Location, {stamp('Job_Update_Time')} AS Job_Update_Time, tempAvg, windSpdMax, Latitude, Longitude
      FROM forecast_day WHERE Location LIKE 'IPL%' AND "timestamp" = TIMESTAMP '{TODAY} 05:00:00'"""),
)
def forecast_day_scan(spark, folder):
    rows = warehouse.forecast_day(t.forecast_day(spark, folder), TODAY)
    return rows.select("Location", "Job_Update_Time", "tempAvg", "windSpdMax", "Latitude", "Longitude")


@query(
    "forecast_hour_window",
    sql("forecast_hour", f"""SELECT {stamp('Job_Update_Time')} AS Job_Update_Time, {stamp('"timestamp"')} AS "timestamp",
      CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS Date1, {stamp('timestampInit')} AS timestampInit, temp, windSpd, snowfallProb, precipProb, Location
      FROM forecast_hour WHERE Location LIKE '%IPL%' AND CAST("timestamp" AS DATE) BETWEEN DATE '{TODAY}' AND DATE '{TODAY}' + 2"""),
)
def forecast_hour_window(spark, folder):
    return warehouse.forecast_hours(t.forecast_hour(spark, folder), TODAY)


_TODAY_ROWS = f"""SELECT * FROM forecast_day WHERE "timestamp" >= TIMESTAMP '{TODAY}' AND "timestamp" < TIMESTAMP '{TODAY}' + INTERVAL 1 DAY
  AND Location LIKE '%IPL%' AND Job_Update_Time = (SELECT max(Job_Update_Time) FROM forecast_day
  WHERE "timestamp" >= TIMESTAMP '{TODAY}' AND "timestamp" < TIMESTAMP '{TODAY}' + INTERVAL 1 DAY AND Location LIKE '%IPL%')"""


@query("latest_load_rows", sql("forecast_day", f"SELECT Location, {stamp('Job_Update_Time')} AS Job_Update_Time, tempAvg, precipProb FROM x", {"x": _TODAY_ROWS}))
def latest_load_rows(spark, folder):
    rows = warehouse.todays_forecast(t.forecast_day(spark, folder), TODAY)
    return rows.select("Location", "Job_Update_Time", "tempAvg", "precipProb")


@query(
    "latest_forecast_dedup",
    sql("latest_day", f"""SELECT {stamp('"timestamp"')} AS "timestamp", Location, {stamp('Job_Update_Time')} AS Job_Update_Time, tempAvg, tempMax FROM latest_day"""),
)
def latest_forecast_dedup(spark, folder):
    newest = latest.latest_forecasts(t.forecast_day(spark, folder))
    return newest.select("timestamp", "Location", "Job_Update_Time", "tempAvg", "tempMax")


@query(
    "weather_for_outage_dates",
    sql("forecast_day", f"""SELECT CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS Date, Location, {stamp('Job_Update_Time')} AS Job_Update_Time, windDirAvg
      FROM forecast_day WHERE CAST("timestamp" AS DATE) IN (SELECT CAST(ts AS DATE) FROM events WHERE event_type = 'error' AND value > 60)"""),
)
def weather_for_outage_dates(spark, folder):
    outages = t.outage_events(spark, folder).where("event_type = 'error' AND value > 60")
    return joins.weather_for_dates(t.forecast_day(spark, folder), outages).select("Date", "Location", "Job_Update_Time", "windDirAvg")


_LABEL = ladder(f"date_diff('day', DATE '{TODAY}', CAST(\"timestamp\" AS DATE))", [(f"{{0}} = {n}", text(v)) for n, v in C.DAY_LABELS.items()])
_SLICE = f"""SELECT {_LABEL} AS day_label, trim(regexp_replace(replace(Location, 'IPL_', ''), '([0-9]+(\\.[0-9]+)?)', ' \\1 ', 'g')) AS Location, tempAvg, precip FROM latest_day WHERE {_LABEL} IS NOT NULL"""


@query("weather_day_slices", sql("latest_day", _SLICE))
def weather_day_slices(spark, folder):
    """Written as one folder per day label and read back."""
    rows = latest.latest_forecasts(t.forecast_day(spark, folder))
    rows = rows.withColumn("Location", weather.spaced_marker(F.col("Location"))).select("timestamp", "Location", "tempAvg", "precip")
    path = work_path(spark, "day-slices")
    sinks.write_day_slices(rows, path, F.lit(TODAY).cast("date"))
    return spark.read.parquet(path).select("day_label", "Location", "tempAvg", "precip")


@query(
    "weather_sorted",
    sql("forecast_hour", f"""SELECT {stamp("(\"timestamp\" AT TIME ZONE 'UTC' AT TIME ZONE 'US/Eastern')")} AS "timestamp", Location, temp,
      CAST(CAST(("timestamp" AT TIME ZONE 'UTC' AT TIME ZONE 'US/Eastern') AS DATE) AS VARCHAR) AS Date FROM forecast_hour
      QUALIFY row_number() OVER (PARTITION BY forecast_hour."timestamp", Location ORDER BY Job_Update_Time DESC) = 1 ORDER BY 1 DESC, 2 DESC"""),
)
def weather_sorted(spark, folder):
    view = weather_view.sorted_view(weather_view.hourly_weather(t.forecast_hour(spark, folder)))
    return view.select("timestamp", "Location", "temp", "Date")


@query(
    "next_hours_filter",
    sql("forecast_hour", f"""SELECT DISTINCT f.name AS Filter_ID, {stamp('local')} AS "timestamp" FROM
      (SELECT DISTINCT "timestamp" AT TIME ZONE 'UTC' AT TIME ZONE 'US/Eastern' AS local FROM forecast_hour) w,
      (VALUES ('Next 6 Hours', 6), ('Next 12 Hours', 12), ('Next 24 Hours', 24)) AS f(name, h)
      WHERE local > TIMESTAMP '{NOW}' AND local <= TIMESTAMP '{NOW}' + f.h * INTERVAL 1 HOUR"""),
)
def next_hours_filter(spark, folder):
    hourly = weather_view.hourly_weather(t.forecast_hour(spark, folder))
    return weather_view.next_hours(hourly, F.lit(NOW).cast("timestamp"))


_RATIOS = ", ".join(
    [f"{n}Max - {n}Min AS {n}Range" for n in C.RANGE_FEATURES]
    + [f"CASE WHEN {n}Min <> 0 THEN {n}Max / {n}Min END AS {n}Ratio" for n in C.RATIO_FEATURES]
)
_RATIO_NAMES = [f"{n}Range" for n in C.RANGE_FEATURES] + [f"{n}Ratio" for n in C.RATIO_FEATURES]


@query("weather_range_ratio", sql("forecast_day", f"""SELECT {stamp('"timestamp"')} AS "timestamp", Location, {stamp('Job_Update_Time')} AS Job_Update_Time, {_RATIOS} FROM forecast_day"""))
def weather_range_ratio(spark, folder):
    return weather.range_and_ratio(t.forecast_day(spark, folder)).select("timestamp", "Location", "Job_Update_Time", *_RATIO_NAMES)


@query("wind_direction", sql("forecast_day", f"""SELECT {stamp('"timestamp"')} AS "timestamp", Location, windDirAvg, {wind('windDirAvg')} AS WIND_DIRECTION FROM forecast_day"""))
def wind_direction(spark, folder):
    return t.forecast_day(spark, folder).select("timestamp", "Location", "windDirAvg", weather.wind_sector(F.col("windDirAvg")).alias("WIND_DIRECTION"))


@query(
    "marker_key_normalise",
    sql("", """SELECT event_id, 'Marker' || (user_id % 20 + 1) AS joined_key,
      'Marker ' || (user_id % 20 + 1) AS spaced_key, 'Marker' || (user_id % 20 + 1) AS outage_key FROM events"""),
)
def marker_key_normalise(spark, folder):
    number = (F.col("user_id") % 20 + 1).cast("string")
    location = F.concat(F.lit(f"{C.LOCATION_PREFIX}_Marker"), number)
    return t.load(spark, folder, "events").select(
        "event_id",
        weather.marker_key(location).alias("joined_key"),
        weather.spaced_marker(location).alias("spaced_key"),
        weather.outage_marker_key(F.concat(F.lit("Marker "), number)).alias("outage_key"),
    )


def _marked_events(spark, folder):
    events = t.outage_events(spark, folder)
    return events.withColumn("Marker_Location", F.concat(F.lit("Marker "), (F.col("user_id") % 23 + 1).cast("string")))


_USED = ["tempAvg", "tempMax", "windDirAvg", "precip"]


@query(
    "outage_weather_join",
    sql("outage_events latest_day", f"""SELECT OUTAGE_ID, 'Marker ' || (user_id % 23 + 1) AS Marker_Location, {', '.join(_USED)}, {_RATIOS},
      {wind('windDirAvg')} AS WIND_DIRECTION, CAST(CASE WHEN isodow(CREATION_DATETIME) >= 6 THEN 1 ELSE 0 END AS BIGINT) AS weekend_flag
      FROM outage_events LEFT JOIN latest_day ON CAST(CREATION_DATETIME AS DATE) = CAST("timestamp" AS DATE)
        AND 'Marker' || (user_id % 23 + 1) = substr(Location, 5)"""),
)
def outage_weather_join(spark, folder):
    newest = latest.latest_forecasts(t.forecast_day(spark, folder))
    joined = joins.with_weather(_marked_events(spark, folder), newest, [*_USED])
    return joined.select("OUTAGE_ID", "Marker_Location", *_USED, *_RATIO_NAMES, "WIND_DIRECTION", "weekend_flag")


PROFILE_SQL = ladder("clusters", [(f"{{0}} = '{k}'", text(v)) for k, v in C.PROFILES.items()], "''")


@query(
    "outage_profile_join",
    sql("outage_events storm_profiles", f"""SELECT OUTAGE_ID, CASE WHEN clusters IS NOT NULL THEN {PROFILE_SQL} END AS Cluster_ID
      FROM outage_events LEFT JOIN storm_profiles ON CAST(CREATION_DATETIME AS DATE) = "timestamp" AND Location = 'Marker ' || (user_id % 23 + 1)"""),
)
def outage_profile_join(spark, folder):
    return joins.with_profile(_marked_events(spark, folder), t.storm_profiles(spark, folder)).select("OUTAGE_ID", "Cluster_ID")


_NAMES = "[" + ", ".join(text(v) for v in C.PROFILES.values()) + "]"


@query(
    "profile_label",
    sql("storm_profiles", f"""SELECT CAST("timestamp" AS VARCHAR) AS "timestamp", Location, {PROFILE_SQL} AS profile,
      ({_NAMES})[CAST(substr(clusters, 8) AS INTEGER)] AS profile_by_index FROM storm_profiles"""),
)
def profile_label(spark, folder):
    return t.storm_profiles(spark, folder).select(
        "timestamp", "Location",
        weather.profile_text(F.col("clusters")).alias("profile"),
        weather.profile_text_by_index(F.substr("clusters", F.lit(8)).cast("int")).alias("profile_by_index"),
    )


_PROBS = "[" + ", ".join(f"((event_id * {s} + user_id) % 101 / 101::DOUBLE)" for s in (3, 5, 7, 11, 13, 17)) + "]"


@query(
    "second_best_class",
    sql("", f"""SELECT event_id, CAST(i AS BIGINT) AS profile_2, p[i] AS prob_2, ({_NAMES})[i] AS profile_desc2 FROM (
      SELECT event_id, p, list_sort(list_transform(range(1, 7), lambda k: (-p[k], k)))[2][2] AS i FROM (SELECT event_id, {_PROBS} AS p FROM events))"""),
)
def second_best_class(spark, folder):
    second = t.class_probabilities(spark, folder).withColumn("s", weather.second_best(F.col("probabilities")))
    return second.select(
        "event_id", F.col("s.index").alias("profile_2"), F.col("s.prob").alias("prob_2"), weather.profile_text_by_index(F.col("s.index")).alias("profile_desc2")
    )


def _rolled(feature: str) -> str:
    stat = "max" if feature in C.ROLLUP_MAX or feature.endswith("Max") else "min" if feature.endswith("Min") else "avg"
    return f"round(avg({feature}), 6) AS {feature}" if stat == "avg" else f"round({stat}({feature}), 6) AS {feature}"


@query(
    "weather_day_rollup",
    sql("latest_day", f"""SELECT CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS Date, {', '.join(_rolled(f) for f in C.CUSTOMER_MODEL_FEATURES + ['windDir80mAvg', 'windDir100mAvg', 'radSolarMin'])} FROM latest_day GROUP BY 1"""),
)
def weather_day_rollup(spark, folder):
    days = latest.latest_forecasts(t.forecast_day(spark, folder)).withColumn("Date", F.to_date("timestamp"))
    kept = [*C.CUSTOMER_MODEL_FEATURES, "windDir80mAvg", "windDir100mAvg", "radSolarMin"]
    return aggregate.weather_day_rollup(days).select("Date", *[F.round(f, 6).alias(f) for f in kept])


_SUMMARY = """min(tempMin) AS temp_min, max(tempMax) AS temp_max, round(median(tempAvg), 6) AS temp_median, min(windSpdMin) AS wind_min,
  max(windSpdMax) AS wind_max, round(median(windSpdAvg), 6) AS wind_median, round(avg(precipProb), 6) AS precip_mean,
  round(avg(snowfallProb), 6) AS snow_mean, max(precipProb) AS precip_max, round(median(windDirAvg), 6) AS wind_direction_median"""


@query("weather_summary_stats", sql("forecast_day", f"SELECT {_SUMMARY} FROM x", {"x": _TODAY_ROWS}))
def weather_summary_stats(spark, folder):
    stats = aggregate.weather_summary(warehouse.todays_forecast(t.forecast_day(spark, folder), TODAY))
    rounded = ["temp_median", "wind_median", "precip_mean", "snow_mean", "wind_direction_median"]
    return stats.withColumns({c: F.round(c, 6) for c in rounded})


@query(
    "weather_extreme_locations",
    sql("forecast_day", """SELECT (SELECT n_name FROM y ORDER BY tempMin, Location LIMIT 1) AS min_temp_place,
      (SELECT n_name FROM y ORDER BY windSpdMax DESC, Location LIMIT 1) AS max_wind_place,
      (SELECT n_name FROM y ORDER BY precipProb DESC, Location LIMIT 1) AS max_precip_place,
      (SELECT round_even(max(precipProb), 1) FROM y) AS max_precip""",
        {"x": _TODAY_ROWS, "y": "SELECT x.*, n_name FROM x LEFT JOIN nation ON Location = 'IPL_Marker' || n_nationkey"}),
)
def weather_extreme_locations(spark, folder):
    return daily_summary.highlights(t.forecast_day(spark, folder), t.landmarks(spark, folder), TODAY)


def _shown(value: str, unit: str = "") -> str:
    return f"printf('%.1f', round_even({value}, 1))" + (f" || ' {unit}'" if unit else "")


@query(
    "daily_weather_table",
    sql("forecast_day", f"""
      SELECT 'Temperature' AS Attribute, {_shown('temp_median', 'F')} AS Median, {_shown('temp_min', 'F')} AS Minimum, {_shown('temp_max', 'F')} AS Maximum, '-' AS Probability FROM z
      UNION ALL SELECT 'Windspeed', {_shown('wind_median', 'mi/hr')}, {_shown('wind_min', 'mi/hr')}, {_shown('wind_max', 'mi/hr')}, '-' FROM z
      UNION ALL SELECT 'Precipitation', '-', '-', '-', {_shown('precip_mean')} FROM z
      UNION ALL SELECT 'Snowfall', '-', '-', '-', {_shown('snow_mean')} FROM z
      UNION ALL SELECT 'Wind Direction', {wind('wind_direction_median')}, '-', '-', '-' FROM z""",
        {"x": _TODAY_ROWS, "z": f"SELECT {_SUMMARY} FROM x"}),
)
def daily_weather_table(spark, folder):
    return daily_summary.todays_weather_table(t.forecast_day(spark, folder), TODAY)


PIVOTED = ["tempAvg", "windSpdMax", "precip"]
_WIDE = ", ".join(f"max({f}) FILTER (WHERE Location = 'IPL_Marker{i}') AS MARKER{i}_{f}" for i in range(1, 21) for f in PIVOTED)


@query(
    "marker_pivot",
    sql("latest_day", f"""SELECT CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS Date, {_WIDE} FROM latest_day GROUP BY 1 HAVING bool_or(Location = 'IPL_Marker1')"""),
)
def marker_pivot(spark, folder):
    return reshape.marker_pivot(latest.latest_forecasts(t.forecast_day(spark, folder)), PIVOTED)


@query(
    "eastern_time",
    sql("", f"""SELECT event_id, strftime(ts AT TIME ZONE 'UTC' AT TIME ZONE 'US/Eastern', '%Y-%m-%d %H:%M:%S') AS local_time,
      CAST(CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'US/Eastern' AS DATE) AS VARCHAR) AS local_date FROM events"""),
)
def eastern_time(spark, folder):
    local = times.eastern(F.col("ts").cast("timestamp"))
    return t.load(spark, folder, "events").select("event_id", F.date_format(local, times.STAMP).alias("local_time"), F.to_date(local).alias("local_date"))

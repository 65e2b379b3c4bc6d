"""Queries: calendar, parsing, rules, bands, coordinates."""

from __future__ import annotations

from pyspark.sql import functions as F

from stormgrid import constants as C
from stormgrid.catalog import tables as t
from stormgrid.catalog.oracle import band, haversine, ladder, sql, stamp, text
from stormgrid.catalog.registry import query
from stormgrid.functions import geo, intervals, times
from stormgrid.operators import aggregate, joins, priority
from stormgrid.plans import diagnostics


@query(
    "time_features",
    sql("device", """SELECT INCIDENT_ID, INCIDENT_DEVICE_ID, CAST(CASE WHEN hour(CREATION_DATETIME) BETWEEN 6 AND 17 THEN 1 ELSE 0 END AS BIGINT) AS DAY_FLAG,
      round(sin(hour(CREATION_DATETIME) * 2 * pi() / 24), 8) + 0 AS Hour_Sin, round(cos(hour(CREATION_DATETIME) * 2 * pi() / 24), 8) + 0 AS Hour_Cos,
      CAST(CASE WHEN isodow(CREATION_DATETIME) >= 6 THEN 1 ELSE 0 END AS BIGINT) AS weekend_flag FROM device"""),
)
def time_features(spark, folder):
    created = F.col("CREATION_DATETIME")
    return t.device(spark, folder).select(
        "INCIDENT_ID", "INCIDENT_DEVICE_ID",
        times.day_flag(created).alias("DAY_FLAG"),
        (F.round(times.hour_sin(created), 8) + 0).alias("Hour_Sin"),
        (F.round(times.hour_cos(created), 8) + 0).alias("Hour_Cos"),
        times.weekend_flag(created).alias("weekend_flag"),
    )


@query(
    "safe_parse",
    sql("", f"""SELECT event_id, {stamp("TRY_CAST(CASE WHEN event_type = 'error' THEN 'n/a' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP)")} AS parsed_time,
      TRY_CAST(CASE WHEN event_type = 'view' THEN 'unknown' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS parsed_number FROM events"""),
)
def safe_parse(spark, folder):
    events = t.load(spark, folder, "events")
    time_text = F.when(F.col("event_type") == "error", "n/a").otherwise(F.date_format(F.col("ts").cast("timestamp"), times.STAMP))
    number_text = F.when(F.col("event_type") == "view", "unknown").otherwise(F.col("value").cast("string"))
    return events.select(
        "event_id", times.parse_timestamp(time_text).alias("parsed_time"), times.parse_number(number_text).alias("parsed_number")
    )


_D = "CAST(o_orderdate AS DATE)"


@query(
    "relative_dates",
    sql("", f"""SELECT o_orderkey, CAST({_D} + 1 AS VARCHAR) AS tomorrow, CAST({_D} + 2 AS VARCHAR) AS day_after, CAST({_D} - 1 AS VARCHAR) AS yesterday,
      CAST({_D} - 2 AS VARCHAR) AS day_before, strftime({_D}, '%Y-%m') AS year_month, strftime({_D} + 1, '%Y-%m') AS year_month_1,
      strftime({_D} + 2, '%Y-%m') AS year_month_2, strftime({_D}, '%Y%m%d') AS compact_day, strftime({_D}, '%Y-%m-%d') AS dashed_day,
      dayname({_D}) AS weekday_name FROM orders"""),
)
def relative_dates(spark, folder):
    day = F.to_date("o_orderdate")
    return t.load(spark, folder, "orders").select("o_orderkey", *[c.alias(n) for n, c in times.relative_days(day).items()])


_RULE = "CASE WHEN {0} <= 1440 THEN {0} + 45 WHEN {0} > 1440 THEN {0} + 360 END"


@query("etr_business_rule", sql("timed", f"SELECT OUTAGE_ID, TTR, {_RULE.format('TTR')} AS Predicted_TTR FROM timed"))
def etr_business_rule(spark, folder):
    timed = aggregate.with_restoration_minutes(diagnostics.facility_outages(t.facility(spark, folder)))
    return timed.select("OUTAGE_ID", "TTR", times.business_minutes(F.col("TTR")).alias("Predicted_TTR"))


@query(
    "etr_timestamp",
    sql("outage_events", """SELECT OUTAGE_ID, strftime(CREATION_DATETIME, '%Y/%m/%d %H:%M:%S') AS Creation_Time,
      strftime(make_timestamp(CAST(round_even((CAST(epoch(CREATION_DATETIME) AS BIGINT) + CAST(floor(CAST(round(value * 100) AS BIGINT) * 60 / 100::DOUBLE) AS BIGINT)) / 600::DOUBLE, 0) AS BIGINT) * 600000000), '%Y/%m/%d %H:%M:%S') AS Estimated_Restoration_Time,
      round_even(value, 0) AS ETR FROM outage_events"""),
)
def etr_timestamp(spark, folder):
    created = F.col("CREATION_DATETIME")
    return t.outage_events(spark, folder).select(
        "OUTAGE_ID",
        times.slash_stamp(created).alias("Creation_Time"),
        times.slash_stamp(times.restoration_time(created, F.col("value"))).alias("Estimated_Restoration_Time"),
        F.bround("value", 0).alias("ETR"),
    )


@query(
    "outage_interval",
    sql("", f"SELECT event_id, value AS forecast, {band('value', C.OUTAGE_BANDS, '-')} AS Outages_LL_95, {band('value', C.OUTAGE_BANDS, '+')} AS Outages_UL_95 FROM events"),
)
def outage_interval(spark, folder):
    low, high = intervals.outage_interval(F.col("value"))
    return t.load(spark, folder, "events").select("event_id", F.col("value").alias("forecast"), low.alias("Outages_LL_95"), high.alias("Outages_UL_95"))


@query(
    "customer_interval",
    sql("", f"""SELECT o_orderkey, forecast, {band('forecast', C.CUSTOMER_BANDS, '-')} AS Customers_LL_95, {band('forecast', C.CUSTOMER_BANDS, '+')} AS Customers_UL_95
      FROM (SELECT o_orderkey, o_totalprice / 20 AS forecast FROM orders)"""),
)
def customer_interval(spark, folder):
    rows = t.load(spark, folder, "orders").select("o_orderkey", (F.col("o_totalprice") / 20).alias("forecast"))
    low, high = intervals.customer_interval(F.col("forecast"))
    return rows.select("o_orderkey", "forecast", low.alias("Customers_LL_95"), high.alias("Customers_UL_95"))


_FORECASTS = {
    "a": "SELECT CAST(o_orderdate AS DATE) AS Date, count(*) * 1.25::DOUBLE AS n FROM orders GROUP BY 1",
    "b": "SELECT CAST(o_orderdate AS DATE) AS Date, CAST(CAST(sum(o_custkey) AS BIGINT) % 9000 AS DOUBLE) AS q FROM orders WHERE o_orderstatus = 'F' GROUP BY 1",
}
_AHEAD = "date_diff('day', DATE '1998-06-01', a.Date)"


@query(
    "forecast_collation",
    sql("", f"""SELECT CAST(a.Date AS VARCHAR) AS Date, {ladder(_AHEAD, [(f'{{0}} = {k}', text(v)) for k, v in C.HORIZON_LABELS.items()], f'CAST({_AHEAD} AS VARCHAR)')} AS Number_of_days_ahead,
      CAST(round_even(n, 0) AS BIGINT) AS Number_of_outages, q AS Customer_quantity, {band('q', C.CUSTOMER_BANDS, '-')} AS Customers_LL_95,
      {band('q', C.CUSTOMER_BANDS, '+')} AS Customers_UL_95, {band('n', C.OUTAGE_BANDS, '-')} AS Outages_LL_95, {band('n', C.OUTAGE_BANDS, '+')} AS Outages_UL_95
      FROM a LEFT JOIN b ON a.Date = b.Date""", _FORECASTS),
)
def forecast_collation(spark, folder):
    orders = t.load(spark, folder, "orders").withColumn("Date", F.to_date("o_orderdate"))
    n, q = F.col("predicted_Number_of_OUTAGES"), F.col("Predicted_Cust_Qty")
    outages = orders.groupBy("Date").agg((F.count("*") * 1.25).alias("predicted_Number_of_OUTAGES"))
    customers = orders.where("o_orderstatus = 'F'").groupBy("Date").agg((F.sum("o_custkey") % 9000).cast("double").alias("Predicted_Cust_Qty"))
    outages = outages.withColumns(dict(zip(["Outages_LL_95", "Outages_UL_95"], intervals.outage_interval(n))))
    customers = customers.withColumns(dict(zip(["Customers_LL_95", "Customers_UL_95"], intervals.customer_interval(q))))
    return joins.collate_forecasts(outages, customers, F.lit("1998-06-01").cast("date"))


# ---------------------------------------------------------------- coordinates
@query(
    "haversine_km",
    sql("event_coordinates", f"SELECT OUTAGE_ID, round({haversine('LAT', 'LONG', str(C.CITY_CENTER[0]) + '::DOUBLE', str(C.CITY_CENTER[1]) + '::DOUBLE')}, 6) AS km FROM event_coordinates"),
)
def haversine_km(spark, folder):
    km = geo.haversine_km(F.col("LAT"), F.col("LONG"), F.lit(C.CITY_CENTER[0]), F.lit(C.CITY_CENTER[1]))
    return t.event_coordinates(spark, folder).select("OUTAGE_ID", F.round(km, 6).alias("km"))


@query(
    "zone_quadrant",
    sql("event_coordinates", """SELECT OUTAGE_ID, CASE WHEN LAT < 39.7684::DOUBLE THEN CASE WHEN LONG < -86.1581::DOUBLE THEN 'ZONE1' ELSE 'ZONE2' END
      ELSE CASE WHEN LONG < -86.1581::DOUBLE THEN 'ZONE4' ELSE 'ZONE3' END END AS ZONE FROM event_coordinates"""),
)
def zone_quadrant(spark, folder):
    return t.event_coordinates(spark, folder).select("OUTAGE_ID", geo.zone(F.col("LAT"), F.col("LONG")).alias("ZONE"))


@query(
    "nearest_marker",
    sql("event_coordinates markers", f"""SELECT OUTAGE_ID, round(d, 6) AS Min_Distance, CASE WHEN d IS NOT NULL THEN 'Marker ' || idx END AS Marker_Location FROM (
      SELECT OUTAGE_ID, idx, {haversine('LAT', 'LONG', 'mlat', 'mlon')} AS d FROM event_coordinates CROSS JOIN markers
      QUALIFY row_number() OVER (PARTITION BY OUTAGE_ID ORDER BY d, idx) = 1)"""),
)
def nearest_marker(spark, folder):
    placed = joins.with_nearest_marker(t.event_coordinates(spark, folder))
    return placed.select("OUTAGE_ID", F.round("Min_Distance", 6).alias("Min_Distance"), "Marker_Location")


def _plane(x: str, y: str) -> dict[str, str]:
    """The projection as a chain of sub-queries."""
    return {
        "p1": f"SELECT *, ({y} * 0.3048::DOUBLE - 250000 + 4151863.7425::DOUBLE) / 6367236.89768::DOUBLE AS om, {x} * 0.3048::DOUBLE AS easting FROM location",
        "p2": """SELECT *, om + sin(om) * cos(om) * (0.005022893948::DOUBLE + 0.000029370625::DOUBLE * pow(cos(om), 2)
          + 0.000000235059::DOUBLE * pow(cos(om), 4) + 0.000000002181::DOUBLE * pow(cos(om), 6)) AS fo FROM p1""",
        "p3": """SELECT *, sin(fo) / cos(fo) AS tf, 0.00673949677548::DOUBLE * pow(cos(fo), 2) AS nf,
          (easting - 100000) / (0.9999666667::DOUBLE * 6378137 / sqrt(1 - 0.0066943800229034::DOUBLE * pow(sin(fo), 2))) AS q FROM p2""",
        "p4": """SELECT *, fo - 0.5::DOUBLE * tf * (1 + nf) * q * q * (1 + q * q * (
            -(5 + 3 * tf * tf + nf * (1 - 9 * tf * tf) - 4 * nf * nf) / 12
            + q * q * (61 + 90 * tf * tf + 45 * pow(tf, 4) + nf * (46 - 252 * tf * tf - 90 * pow(tf, 4))) / 360)) AS north,
          q * (1 + q * q * (-(1 + 2 * tf * tf + nf) / 6 + q * q * ((5 + 28 * tf * tf + 24 * pow(tf, 4) + nf * (6 + 8 * tf * tf)) / 120
            - q * q * (61 + 662 * tf * tf + 1320 * pow(tf, 4) + 720 * pow(tf, 6)) / 5040))) AS east FROM p3""",
        "plane": """SELECT *, north * 57.2957795131::DOUBLE AS LAT, -(1.4951653925::DOUBLE - east / cos(fo)) * 57.2957795131::DOUBLE AS LONG FROM p4""",
    }


PLANE = _plane("GEO_X_COORD", "GEO_Y_COORD")


@query("state_plane_to_latlon", sql("location", "SELECT INCIDENT_ID, LOCATION_ID, round(LAT, 8) AS LAT, round(LONG, 8) AS LONG FROM plane", PLANE))
def state_plane_to_latlon(spark, folder):
    placed = geo.with_state_plane_degrees(t.location(spark, folder), "GEO_X_COORD", "GEO_Y_COORD")
    return placed.select("INCIDENT_ID", "LOCATION_ID", F.round("LAT", 8).alias("LAT"), F.round("LONG", 8).alias("LONG"))


# Ellipsoidal distance in SQL: the fixed-point steps as chained sub-queries.
def geodesic(source: str, lat1: str, lon1: str, lat2: str, lon2: str, steps: int = 12) -> dict[str, str]:
    """Chain whose last table `geo` has the columns of `source` and `miles`."""
    f, a = "(1::DOUBLE / 298.257223563::DOUBLE)", "6378137::DOUBLE"
    chain = {
        "g0": f"SELECT *, atan((1 - {f}) * tan(radians({lat1}))) AS u1, atan((1 - {f}) * tan(radians({lat2}))) AS u2, radians({lon2}) - radians({lon1}) AS L, "
        f"radians({lon2}) - radians({lon1}) AS lam0 FROM {source}"
    }

    def terms(lam: str) -> list[str]:
        return [
            f"SELECT *, sqrt(pow(cos(u2) * sin({lam}), 2) + pow(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos({lam}), 2)) AS ss, sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos({lam}) AS cs",
            f"SELECT *, atan2(ss, cs) AS sg, CASE WHEN ss = 0 THEN 0 ELSE cos(u1) * cos(u2) * sin({lam}) / ss END AS sa",
            "SELECT *, 1 - sa * sa AS c2",
            "SELECT *, CASE WHEN c2 = 0 THEN 0 ELSE cs - 2 * sin(u1) * sin(u2) / c2 END AS m",
        ]

    for i in range(steps):
        before = f"g{i}"
        for j, step in enumerate(terms("lam0")):
            chain[f"g{i}_{j}"] = f"{step} FROM {before}"
            before = f"g{i}_{j}"
        k = f"({f} / 16 * c2 * (4 + {f} * (4 - 3 * c2)))"
        chain[f"g{i + 1}"] = (
            f"SELECT * EXCLUDE (ss, cs, sg, sa, c2, m) REPLACE (L + (1 - {k}) * {f} * sa * (sg + {k} * ss * (m + {k} * cs * (2 * m * m - 1))) AS lam0) FROM {before}"
        )
    before = f"g{steps}"
    for j, step in enumerate(terms("lam0")):
        chain[f"h_{j}"] = f"{step} FROM {before}"
        before = f"h_{j}"
    b = f"({a} * (1 - {f}))"
    chain["h5"] = f"SELECT *, c2 * ({a} * {a} - {b} * {b}) / ({b} * {b}) AS w FROM {before}"
    chain["h6"] = "SELECT *, 1 + w / 16384 * (4096 + w * (-768 + w * (320 - 175 * w))) AS ba, w / 1024 * (256 + w * (-128 + w * (74 - 47 * w))) AS bb FROM h5"
    chain["geo"] = (
        f"SELECT *, {b} * ba * (sg - bb * ss * (m + bb / 4 * (cs * (2 * m * m - 1) - bb / 6 * m * (4 * ss * ss - 3) * (4 * m * m - 3)))) / 1609.344::DOUBLE AS miles FROM h6"
    )
    return chain


@query("geodesic_miles", sql("event_coordinates", "SELECT OUTAGE_ID, round(miles, 6) AS miles FROM geo",
       geodesic("event_coordinates", "LAT", "LONG", "39.7684::DOUBLE", "(-86.1581::DOUBLE)")))
def geodesic_miles(spark, folder):
    miles = geo.geodesic_miles("LAT", "LONG", F.lit(C.CITY_CENTER[0]), F.lit(C.CITY_CENTER[1]))
    return t.event_coordinates(spark, folder).select("OUTAGE_ID", F.round(miles, 6).alias("miles"))


@query(
    "nearest_depot",
    sql("event_coordinates depots", """SELECT OUTAGE_ID, round(miles, 6) AS Depot_Miles, CASE WHEN miles IS NULL THEN 'NO_LOCATION' ELSE name END AS Dispatch_Location
      FROM geo QUALIFY row_number() OVER (PARTITION BY OUTAGE_ID ORDER BY miles, idx) = 1""",
        {"pairs": "SELECT * FROM event_coordinates CROSS JOIN depots"} | geodesic("pairs", "LAT", "LONG", "dlat", "dlon")),
)
def nearest_depot(spark, folder):
    placed = joins.with_nearest_depot(t.event_coordinates(spark, folder))
    return placed.select("OUTAGE_ID", F.round("Depot_Miles", 6).alias("Depot_Miles"), "Dispatch_Location")


_CENTER = {
    "live": "SELECT *, LAT / n AS clat, LONG / n AS clon FROM event_coordinates, (SELECT count(DISTINCT OUTAGE_ID) AS n FROM event_coordinates)",
}
_RANKED = "SELECT OUTAGE_ID, CASE WHEN v IS NOT NULL THEN count(v) OVER (ORDER BY v RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS Priority_Dist_Customer_Qty FROM "


@query("priority_by_distance", sql("event_coordinates", _RANKED + "(SELECT OUTAGE_ID, miles / CUST_QTY AS v FROM geo)",
       _CENTER | geodesic("live", "LAT", "LONG", "clat", "clon")))
def priority_by_distance(spark, folder):
    return priority.by_distance(t.event_coordinates(spark, folder)).select("OUTAGE_ID", "Priority_Dist_Customer_Qty")


@query("priority_by_great_circle", sql("event_coordinates", _RANKED + f"(SELECT OUTAGE_ID, {haversine('LAT', 'LONG', 'clat', 'clon')} / CUST_QTY AS v FROM live)", _CENTER))
def priority_by_great_circle(spark, folder):
    return priority.by_distance(t.event_coordinates(spark, folder), method="haversine").select("OUTAGE_ID", "Priority_Dist_Customer_Qty")


@query("priority_by_customers", sql("event_coordinates", "SELECT OUTAGE_ID, CUST_QTY, dense_rank() OVER (ORDER BY CUST_QTY DESC) AS Priority_Customer_Qty FROM event_coordinates"))
def priority_by_customers(spark, folder):
    return priority.by_customers(t.event_coordinates(spark, folder)).select("OUTAGE_ID", "CUST_QTY", "Priority_Customer_Qty")

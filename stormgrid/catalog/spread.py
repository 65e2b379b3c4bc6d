"""Queries: quantiles, nearest points, pruned joins and checked reads that hold at any size."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormgrid import constants as C
from stormgrid.catalog import tables as t
from stormgrid.catalog.oracle import sql, stamp
from stormgrid.catalog.registry import query
from stormgrid.models import forecasts
from stormgrid.operators import joins, latest, nearest, ordered
from stormgrid.plans import profiles
from stormgrid.session import work_path
from stormgrid.sources import files, warehouse


@query("grouped_median", sql("", "SELECT l_returnflag, median(l_extendedprice) AS median FROM lineitem GROUP BY ALL"))
def grouped_median(spark, folder):
    """Three groups of all rows, the largest with half of them."""
    return ordered.grouped_median(t.load(spark, folder, "lineitem"), "l_returnflag", "l_extendedprice")


@query(
    "grouped_quantiles",
    sql("", """SELECT o_orderstatus, round(quantile_cont(CAST(o_totalprice AS DOUBLE), 0.05), 6) AS low, round(quantile_cont(CAST(o_totalprice AS DOUBLE), 0.5), 6) AS middle,
      round(quantile_cont(CAST(o_totalprice AS DOUBLE), 0.95), 6) AS high FROM orders GROUP BY ALL"""),
)
def grouped_quantiles(spark, folder):
    found = ordered.grouped_quantiles(t.load(spark, folder, "orders"), "o_orderstatus", "o_totalprice", {"low": 0.05, "middle": 0.5, "high": 0.95})
    return found.select("o_orderstatus", *[F.round(c, 6).alias(c) for c in ("low", "middle", "high")])


_ANGLE = """pow(sin(radians(p.lat - q.LAT) / 2), 2) + cos(radians(q.LAT)) * cos(radians(p.lat)) * pow(sin(radians(p.lon - q.LONG) / 2), 2)"""


@query(
    "nearest_customer",
    sql("", f"""SELECT o_orderkey, arg_min(p.id, {_ANGLE}) AS Nearest, round(2 * {C.EARTH_RADIUS_KM}::DOUBLE * asin(sqrt(min({_ANGLE}))), 5) AS Nearest_Km FROM q, p GROUP BY o_orderkey
      UNION ALL SELECT o_orderkey, NULL, NULL FROM orders WHERE o_orderkey % 41 = 0""",
        {"p": "SELECT c_custkey AS id, 20 + (c_custkey * 7919 % 100003) / 2500.0::DOUBLE AS lat, -120 + (c_custkey * 104729 % 100019) / 1000.0::DOUBLE AS lon FROM customer",
         "q": "SELECT o_orderkey, 18 + (o_orderkey * 611953 % 100043) / 2300.0::DOUBLE AS LAT, -121 + (o_orderkey * 15485863 % 100049) / 980.0::DOUBLE AS LONG FROM orders WHERE o_orderkey % 41 <> 0"}),
)
def nearest_customer(spark, folder):
    """Every order's nearest customer, both strewn over a continent by their keys; the SQL compares all pairs."""
    c, o = F.col("c_custkey"), F.col("o_orderkey")
    points = t.load(spark, folder, "customer").select(c.alias("id"), (20 + (c * 7919 % 100003) / 2500.0).alias("lat"), (-120 + (c * 104729 % 100019) / 1000.0).alias("lon"))
    known = o % 41 != 0
    orders = t.load(spark, folder, "orders").select(
        "o_orderkey", F.when(known, 18 + (o * 611953 % 100043) / 2300.0).alias("LAT"), F.when(known, -121 + (o * 15485863 % 100049) / 980.0).alias("LONG")
    )
    return nearest.with_nearest(orders, points, size=0.5).select("o_orderkey", "Nearest", F.round("Nearest_Km", 5).alias("Nearest_Km"))


@query(
    "weather_stored_by_date",
    sql("outage_events latest_day", f"""SELECT OUTAGE_ID, {stamp('Job_Update_Time')} AS Job_Update_Time, tempAvg FROM outage_events LEFT JOIN latest_day
      ON CAST(CREATION_DATETIME AS DATE) = CAST("timestamp" AS DATE) AND 'Marker' || (user_id % 23 + 1) = substr(Location, 5) WHERE event_type = 'error' AND value > 60"""),
)
def weather_stored_by_date(spark, folder):
    """Forecasts stored by date, of which the join opens the dates of its outages only."""
    path = work_path(spark, "weather")
    warehouse.store_by_date(t.forecast_day(spark, folder), path)
    outages = t.outage_events(spark, folder).where("event_type = 'error' AND value > 60")
    marked = outages.withColumn("Marker_Location", F.concat(F.lit("Marker "), (F.col("user_id") % 23 + 1).cast("string")))
    relevant = joins.weather_for_dates(spark.read.parquet(path), outages)
    return joins.with_weather(marked, latest.latest_forecasts(relevant), ["Job_Update_Time", *_NEEDED]).select("OUTAGE_ID", "Job_Update_Time", "tempAvg")


_NEEDED = ["tempAvg"]


@query(
    "feed_rejects",
    sql("", """SELECT 'good' AS kind, count(*) AS rows, CAST(sum(c_custkey) AS BIGINT) AS keys FROM customer WHERE c_custkey % 10 > 2
      UNION ALL SELECT 'row', count(*), NULL FROM customer WHERE c_custkey % 10 IN (1, 2) UNION ALL SELECT 'header', count(*), NULL FROM customer WHERE c_custkey % 10 = 0"""),
)
def feed_rejects(spark, folder):
    """Customers as files: some rows with a word for a number, one folder of files with their columns shifted."""
    rows, path = t.load(spark, folder, "customer"), work_path(spark, "feed")
    kind = F.col("c_custkey") % 10
    key, nation = F.when(kind == 1, "none").otherwise(F.col("c_custkey").cast("string")), F.when(kind == 2, "many").otherwise(F.col("c_nationkey").cast("string"))
    rows.where(kind > 0).select(key.alias("c_custkey"), nation.alias("c_nationkey"), F.lit("x").alias("note")).write.option("header", True).csv(path)
    rows.where(kind == 0).select("c_nationkey", "c_custkey", F.lit("x").alias("note")).write.mode("append").option("header", True).csv(path)
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_nationkey", T.LongType()), T.StructField("note", T.StringType())])
    good, rejects = files.read_checked(spark, path, schema)
    counted = good.agg(F.lit("good").alias("kind"), F.count("*").alias("rows"), F.sum("c_custkey").alias("keys"))
    return counted.unionByName(rejects.groupBy(F.col("reason").alias("kind")).agg(F.count("*").alias("rows"), F.lit(None).cast("bigint").alias("keys")))


@query(
    "day_profiles",
    sql("latest_day", """SELECT CAST("timestamp" AS DATE)::VARCHAR AS "timestamp", trim(regexp_replace(replace(Location, 'IPL_', ''), '([0-9]+(\\.[0-9]+)?)', ' \\1 ', 'g')) AS Location, 1::BIGINT AS labelled, 1.0::DOUBLE AS whole
      FROM latest_day WHERE CAST("timestamp" AS DATE) = DATE '2024-01-15'"""),
)
def day_profiles(spark, folder):
    """Today's profile of every marker by a classifier of the days before: labelled, with probabilities that add up."""
    daily, today = t.forecast_day(spark, folder), F.lit("2024-01-15").cast("date")
    labels = t.storm_profiles(spark, folder).select(F.col("timestamp").alias("Date"), "Location", "clusters")
    past = profiles.profile_inputs(daily).where(F.col("Date") < today)
    model = forecasts.fit_profiles(past.join(labels, ["Date", "Location"]), C.WEATHER_FEATURES, trees=10, depth=4)
    found = profiles.day_profiles(model, daily, today)
    total = sum(F.col(f"prob_{name}") for name in C.PROFILES)
    return found.select("timestamp", "Location", F.col("profile").isin(list(C.PROFILES.values())).cast("bigint").alias("labelled"), F.round(total, 6).alias("whole"))

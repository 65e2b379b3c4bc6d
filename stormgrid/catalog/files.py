"""Queries: file round trips, feed listings, gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from stormgrid.catalog import tables as t
from stormgrid.catalog.oracle import sql, stamp
from stormgrid.catalog.registry import query
from stormgrid.session import work_path
from stormgrid.sources import files, sinks


@query("scan_csv_roundtrip", sql("", f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {stamp('o_orderdate')} AS o_orderdate, o_orderpriority FROM orders"))
def scan_csv_roundtrip(spark, folder):
    orders = t.load(spark, folder, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    path = work_path(spark, "csv")
    sinks.write_csv(orders, path)
    return files.read_csv(spark, path, orders.schema)


@query(
    "partitioned_backup_write",
    sql("", """SELECT event_id, strftime(local, '%Y-%m') AS ym, strftime(local, '%Y-%m-%d') AS d, strftime(local, '%Y%m%d%H%M') AS stamp
      FROM (SELECT event_id, date_trunc('day', ts) AT TIME ZONE 'UTC' AT TIME ZONE 'US/Eastern' AS local FROM events)"""),
)
def partitioned_backup_write(spark, folder):
    rows = t.load(spark, folder, "events").select("event_id", F.date_trunc("day", F.col("ts").cast("timestamp")).alias("run_ts"))
    path = work_path(spark, "backup")
    sinks.backup(rows, path, "run_ts")
    back = spark.read.option("recursiveFileLookup", False).schema("event_id bigint, ym string, d string, stamp string").parquet(path)
    return back.select("event_id", "ym", "d", "stamp")


@query("latest_file_per_feed", sql("current_files", "SELECT CAST(day AS VARCHAR) AS day, feed, path FROM current_files"))
def latest_file_per_feed(spark, folder):
    return files.latest_files(t.manifest(spark, folder), keys=("day",))


@query(
    "new_files_gate",
    sql("current_files", """SELECT CAST(c.day AS VARCHAR) AS day, count(*) AS feeds, count(*) FILTER (WHERE c.file = l.file) AS unchanged,
      CAST(count(*) FILTER (WHERE c.file = l.file) = 0 AS BIGINT) AS is_new
      FROM named c LEFT JOIN named l ON l.day + 1 = c.day AND l.feed = c.feed GROUP BY c.day""",
        {"named": "SELECT day, feed, parse_filename(path) AS file FROM current_files WHERE feed <> 'history'"}),
)
def new_files_gate(spark, folder):
    """Each day's files against those of the day before, by file name."""
    current = files.latest_files(t.manifest(spark, folder), keys=("day",))
    named = current.withColumn("path", F.substring_index("path", "/", -1))
    before = named.withColumn("day", F.date_add("day", 1))
    return files.freshness_gate(named, before, keys=("day",))

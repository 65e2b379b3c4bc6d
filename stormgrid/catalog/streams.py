"""Queries: the streaming jobs, run to the end of the available files."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormgrid import constants as C
from stormgrid.catalog import tables as t
from stormgrid.catalog.oracle import sql, stamp
from stormgrid.catalog.ordering import TRAILING
from stormgrid.catalog.registry import query
from stormgrid.catalog.relational import _COUNTS, _FLAG_OF
from stormgrid.session import work_path
from stormgrid.streaming import jobs


def _stream(spark, folder, name):
    schema = t.load(spark, folder, name).schema
    return jobs.read_feed(spark, folder, schema, f"{name}.parquet", "parquet")


def _late_events(spark, folder):
    """All events as three folders whose days are dealt out in turn, the last ones first: batches come out of date order.

    Each folder is written in parallel; files are picked up in the order of their
    times, a third of them in a batch.
    """
    feed, rows = work_path(spark, "feed"), t.load(spark, folder, "events")
    turn = F.coalesce(F.pmod(F.unix_date(F.to_date("ts")), F.lit(3)), F.lit(0))
    for part in (2, 0, 1):
        rows.where(turn == part).write.parquet(f"{feed}/turn-{part}")
    files = spark.read.parquet(f"{feed}/*").inputFiles()
    return jobs.read_feed(spark, f"{feed}/*", rows.schema, "*.parquet", "parquet", files_per_batch=-(-len(files) // 3))


def _event_stream(spark, folder):
    created = F.date_trunc("second", F.col("ts").cast("timestamp")).alias("CREATION_DATETIME")
    return _late_events(spark, folder).select(F.col("event_id").cast("string").alias("OUTAGE_ID"), created, "event_type")


@query("stream_new_files", sql("", "SELECT c_custkey, c_name, 'customer.parquet' AS source_file FROM customer"))
def stream_new_files(spark, folder):
    """A second run finds no new file and adds nothing."""
    out, progress = work_path(spark, "picked"), work_path(spark, "picked-progress")
    for _ in range(2):
        jobs.pick_up_new_files(_stream(spark, folder, "customer"), out, progress)
    return spark.read.parquet(out).select("c_custkey", "c_name", "source_file")


@query("stream_daily_counts", sql("", f"SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS Date, {_COUNTS} FROM events GROUP BY ALL"))
def stream_daily_counts(spark, folder):
    out = work_path(spark, "counts")
    flagged = _event_stream(spark, folder).withColumns({f: (F.col("event_type") == kind).cast("int") for f, kind in _FLAG_OF.items()})
    jobs.daily_counts(flagged, out, work_path(spark, "counts-progress"))
    return jobs.newest_rows(spark, out, ["Date"])


@query(
    "stream_not_yet_predicted",
    sql("outage_events", "SELECT OUTAGE_ID, event_type FROM outage_events o WHERE NOT EXISTS "
        "(SELECT 1 FROM orders p WHERE CAST(p.o_orderkey AS VARCHAR) = o.OUTAGE_ID AND p.o_orderstatus = 'F')"),
)
def stream_not_yet_predicted(spark, folder):
    predicted = t.load(spark, folder, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("string").alias("OUTAGE_ID"))
    out = work_path(spark, "fresh")
    jobs.not_yet_predicted(_event_stream(spark, folder), predicted, out, work_path(spark, "fresh-progress"))
    return spark.read.parquet(out).select("OUTAGE_ID", "event_type")


@query(
    "stream_upsert",
    sql("", f"SELECT user_id, event_type, event_id, {stamp('date_trunc(' + repr('second') + ', ts)')} AS ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1"),
)
def stream_upsert(spark, folder):
    out = work_path(spark, "upserts")
    rows = _late_events(spark, folder).select("user_id", "event_type", "event_id", F.date_trunc("second", F.col("ts").cast("timestamp")).alias("ts"))
    jobs.upsert_batches(rows, out, work_path(spark, "upserts-progress"), ["user_id", "event_type"], ["event_id"])
    return jobs.newest_rows(spark, out, ["user_id", "event_type"], ["event_id"])


@query(
    "stream_trailing_counts",
    sql("", f"SELECT p.OUTAGE_ID, {TRAILING} FROM p LEFT JOIN e ON e.s < p.s AND e.s >= p.s - 36000 GROUP BY 1",
        {"p": "SELECT CAST(event_id AS VARCHAR) AS OUTAGE_ID, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events WHERE event_type IN ('signup', 'error', 'purchase')",
         "e": "SELECT CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events"}),
)
def stream_trailing_counts(spark, folder):
    out = work_path(spark, "trailing")
    live = _event_stream(spark, folder).where(F.col("event_type").isin("signup", "error", "purchase"))
    history = t.outage_events(spark, folder).where(F.col("event_type").isin("view", "click"))
    jobs.trailing_count_batches(live.drop("event_type"), history, out, work_path(spark, "trailing-progress"))
    return jobs.trailing_table(spark, out, T.StructField("OUTAGE_ID", T.StringType())).select("OUTAGE_ID", *[f"Outages_in_last_{k}hr" for k in range(1, C.TRAILING_HOURS + 1)])

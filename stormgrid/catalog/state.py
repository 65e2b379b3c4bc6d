"""Queries: tables that one run hands to the next, and what the summary shows of them."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormgrid import constants as C
from stormgrid.catalog import tables as t
from stormgrid.catalog.oracle import sql
from stormgrid.catalog.registry import query
from stormgrid.catalog.relational import _COUNTS
from stormgrid.operators import aggregate, clean
from stormgrid.plans import daily_summary, diagnostics, restoration
from stormgrid.session import work_path
from stormgrid.sources import files


@query("counters_carried", sql("", f"SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS Date, {_COUNTS} FROM events GROUP BY ALL"))
def counters_carried(spark, folder):
    """Counters of one run stored, read by the next and added to its own."""
    rows, path = t.event_flags(spark, folder), work_path(spark, "counters")
    earlier = F.col("OUTAGE_ID").cast("bigint") % 3 == 0
    aggregate.daily_counters(rows.where(earlier)).write.parquet(path)
    return aggregate.merge_counters(spark.read.parquet(path), aggregate.daily_counters(rows.where(~earlier)))


_GRAIN_OF = "o_orderkey AS INCIDENT_ID, 'S' || (o_orderkey % 97) AS STRCTUR_NO, o_custkey AS CIRCT_ID, o_orderstatus AS DNI_EQUIP_TYPE"


def _outages(spark, folder):
    return t.load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("INCIDENT_ID"), F.concat(F.lit("S"), (F.col("o_orderkey") % 97).cast("string")).alias("STRCTUR_NO"),
        F.col("o_custkey").alias("CIRCT_ID"), F.col("o_orderstatus").alias("DNI_EQUIP_TYPE"),
    )


@query(
    "curated_history",
    sql("", f"SELECT {_GRAIN_OF}, CASE WHEN o_orderkey % 2 = 0 THEN 'batch' ELSE 'history' END AS Weather_Zone FROM orders"),
)
def curated_history(spark, folder):
    """History of odd orders and every fourth; the batch brings the even ones and replaces what it shares."""
    outages = _outages(spark, folder)
    history = outages.where("INCIDENT_ID % 2 = 1 OR INCIDENT_ID % 4 = 0").withColumn("Weather.Zone", F.lit("history"))
    batch = outages.where("INCIDENT_ID % 2 = 0").withColumn("Weather_Zone", F.lit("batch"))
    return restoration.updated_history(history, batch)


@query(
    "diagnostics_upsert",
    sql("", "SELECT CAST(o_orderkey AS VARCHAR) AS OUTAGE_ID, CAST(CASE WHEN o_orderkey % 3 = 0 THEN o_custkey + 5 ELSE o_custkey END AS DOUBLE) AS TTR, CAST(o_custkey % 100 AS DOUBLE) AS ETR, NULL::DOUBLE AS OMS_ETR FROM orders"),
)
def diagnostics_upsert(spark, folder):
    """Stored diagnostics, some twice, with new entries for every third outage."""
    base = t.load(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("OUTAGE_ID"), F.col("o_custkey").alias("TTR"), (F.col("o_custkey") % 100).alias("ETR"), F.lit(None).cast("double").alias("OMS_ETR")
    )
    third = F.col("OUTAGE_ID").cast("bigint") % 3 == 0
    return diagnostics.update_diagnostics(base.unionByName(base.where(third)), base.where(third).withColumn("TTR", F.col("TTR") + 5))


_DAYS = "SELECT CAST(o_orderdate AS DATE) AS Date, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS c FROM orders GROUP BY ALL"


@query(
    "forecast_bounds",
    sql("", """SELECT CAST(n AS VARCHAR) AS Outages_LL_95, CAST(n * 3 AS VARCHAR) AS Outages_UL_95, CAST(c AS VARCHAR) AS Customers_LL_95, format('{:,}', c * 2) AS Customers_UL_95
      FROM days WHERE Date = DATE '1995-03-15'""", {"days": _DAYS}),
)
def forecast_bounds(spark, folder):
    days = t.load(spark, folder, "orders").groupBy(F.to_date("o_orderdate").alias("Date")).agg(F.count("*").alias("n"), F.sum("o_custkey").alias("c"))
    ahead = F.explode(F.array(*[F.lit(label) for label in C.HORIZON_LABELS.values()]))
    stored = days.select(
        "Date", ahead.alias("Number_of_days_ahead"), F.col("n").alias("Outages_LL_95"), (F.col("n") * 3).alias("Outages_UL_95"), F.col("c").alias("Customers_LL_95"), (F.col("c") * 2).alias("Customers_UL_95")
    )
    return daily_summary.forecast_bounds(stored, "1995-03-15")


@query("latin1_history_read", sql("", "SELECT c_custkey, replace(c_name, 'Customer', 'Énergie à') AS c_name FROM customer"))
def latin1_history_read(spark, folder):
    """A Latin-1 file with an index column left in it, read back without the column."""
    rows = t.load(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("Unnamed: 0"), "c_custkey", F.regexp_replace("c_name", "Customer", "Énergie à").alias("c_name"))
    path = work_path(spark, "latin")
    rows.write.option("header", True).option("encoding", files.LATIN).csv(path)
    schema = T.StructType([T.StructField("Unnamed: 0", T.StringType()), T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType())])
    return clean.drop_junk_columns(files.read_facility(spark, path, schema))

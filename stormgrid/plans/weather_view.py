"""Hourly weather table in local time, and its filter on the coming hours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgrid import constants as C
from stormgrid.functions import times
from stormgrid.operators.latest import latest_forecasts


def hourly_weather(forecasts: DataFrame) -> DataFrame:
    """Newest load per hour and location, with local time and date."""
    local = latest_forecasts(forecasts).withColumn("timestamp", times.eastern(F.col("timestamp")))
    return local.withColumn("Date", F.to_date("timestamp")).drop("Date1")


def sorted_view(weather: DataFrame) -> DataFrame:
    ordered = weather.orderBy(F.col("timestamp").desc(), F.col("Location").desc())
    return ordered.withColumn("timestamp", F.date_format("timestamp", times.STAMP))


def next_hours(weather: DataFrame, now: Column) -> DataFrame:
    """Distinct local times in the next 6, 12 and 24 hours; one row per filter and time.

    Times are made distinct before they meet the three filters.
    """
    moments = weather.select("timestamp").where(
        (F.col("timestamp") > now) & (F.col("timestamp") <= now + F.make_dt_interval(F.lit(0), F.lit(max(h for _, h in C.HOUR_FILTERS))))
    ).distinct()
    ahead = F.unix_timestamp("timestamp") - F.unix_timestamp(now)
    fitting = F.filter(
        F.array(*[F.struct(F.lit(name).alias("name"), F.lit(hours * 3600).alias("span")) for name, hours in C.HOUR_FILTERS]),
        lambda f: ahead <= f["span"],
    )
    return moments.select(F.explode(fitting).alias("f"), F.date_format("timestamp", times.STAMP).alias("timestamp")).select(
        F.col("f.name").alias("Filter_ID"), "timestamp"
    )

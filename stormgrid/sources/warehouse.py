"""Predicates over warehouse tables; all of them reach a partitioned scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgrid import constants as C
from stormgrid.operators.latest import rows_of_latest_load


def forecast_day(forecasts: DataFrame, day: str, prefix: str = C.LOCATION_PREFIX) -> DataFrame:
    """Daily forecast rows of one day at the reporting hour."""
    moment = F.lit(f"{day} {C.FORECAST_CLOCK}").cast("timestamp")
    return forecasts.where(F.col("Location").startswith(prefix) & (F.col("timestamp") == moment))


def forecast_hours(forecasts: DataFrame, today: str, days: int = 2, prefix: str = C.LOCATION_PREFIX) -> DataFrame:
    """Hourly forecast from today to `days` days ahead, with the date.

    The window is stated on the stored timestamp, which the scan can skip by,
    rather than on the derived date.
    """
    start = F.lit(today).cast("timestamp")
    stop = F.date_add(F.lit(today).cast("date"), days + 1).cast("timestamp")
    inside = forecasts.where(
        F.col("Location").contains(prefix) & (F.col("timestamp") >= start) & (F.col("timestamp") < stop)
    )
    return inside.select(
        "Job_Update_Time", "timestamp", F.to_date("timestamp").alias("Date1"), "timestampInit",
        "temp", "windSpd", "snowfallProb", "precipProb", "Location",
    )


def day_window(today: str, prefix: str = C.LOCATION_PREFIX) -> Column:
    start = F.lit(today).cast("timestamp")
    stop = F.date_add(F.lit(today).cast("date"), 1).cast("timestamp")
    return F.col("Location").contains(prefix) & (F.col("timestamp") >= start) & (F.col("timestamp") < stop)


def todays_forecast(forecasts: DataFrame, today: str, prefix: str = C.LOCATION_PREFIX) -> DataFrame:
    """Today's forecast rows of the most recent load."""
    return rows_of_latest_load(forecasts, day_window(today, prefix))


def preparedness_row(preparations: DataFrame, today: str, horizon: str = C.HORIZON_LABELS[1]) -> DataFrame:
    return preparations.where((F.col("Date") == F.lit(today).cast("date")) & (F.col("Number_of_days_ahead") == horizon))


def store_by_date(df: DataFrame, path: str, ts: str = "timestamp") -> None:
    """Weather rows in one folder per `Date`, which joins on the date are pruned to."""
    dated = df.withColumn("Date", F.to_date(ts))
    dated.hint("rebalance", "Date").write.mode("append").partitionBy("Date").parquet(path)

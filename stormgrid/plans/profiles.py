"""Weather profiles of past and coming days."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormgrid import constants as C
from stormgrid.functions import times, weather
from stormgrid.models import forecasts
from stormgrid.operators import latest

KEPT = ["Date", "forecast_type", "latitude", "longitude", "Location"]


def profile_inputs(daily: DataFrame) -> DataFrame:
    """Newest load per day and marker, with the column names the classifier expects."""
    rows = latest.latest_forecasts(daily).withColumns(
        {"Date": F.to_date("timestamp"), "Location": weather.spaced_marker(F.col("Location"))}
    )
    return rows.withColumnsRenamed({"Latitude": "latitude", "Longitude": "longitude"})


def forecast_profiles(model: PipelineModel, daily: DataFrame, today) -> DataFrame:
    """Profiles of tomorrow and the day after."""
    rows = profile_inputs(daily).withColumn("forecast_type", times.horizon_label(F.col("Date"), today))
    coming = rows.where(F.col("forecast_type").isin(list(C.HORIZON_LABELS.values()))).na.drop("any")
    return forecasts.classify_profiles(model, coming, KEPT).drop("clusters")


def day_profiles(model: PipelineModel, daily: DataFrame, day) -> DataFrame:
    """Profiles of one day, in the form the outage join reads."""
    rows = profile_inputs(daily).where(F.col("Date") == day)
    return forecasts.classify_profiles(model, rows, ["Date", "latitude", "longitude", "Location"]).withColumnRenamed("Date", "timestamp")

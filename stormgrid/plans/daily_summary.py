"""The daily summary as tables: five weather rows, highlights, forecast bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgrid.functions import weather
from stormgrid.operators import aggregate, joins
from stormgrid.sources import warehouse


def _one(value: str) -> Column:
    return F.format_string("%.1f", F.bround(value, 1))


def _with_unit(value: str, unit: str) -> Column:
    return F.concat(_one(value), F.lit(f" {unit}"))


def weather_table(forecasts: DataFrame) -> DataFrame:
    """Temperature, wind speed, precipitation, snowfall and wind direction of the given rows."""
    stats = aggregate.weather_summary(forecasts)
    none = F.lit("-")
    rows = [
        ("Temperature", _with_unit("temp_median", "F"), _with_unit("temp_min", "F"), _with_unit("temp_max", "F"), none),
        ("Windspeed", _with_unit("wind_median", "mi/hr"), _with_unit("wind_min", "mi/hr"), _with_unit("wind_max", "mi/hr"), none),
        ("Precipitation", none, none, none, _one("precip_mean")),
        ("Snowfall", none, none, none, _one("snow_mean")),
        ("Wind Direction", weather.wind_sector(F.col("wind_direction_median")), none, none, none),
    ]
    names = ["Attribute", "Median", "Minimum", "Maximum", "Probability"]
    cells = [
        F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(n) for n, v in zip(names, row)]) for row in rows
    ]
    return stats.select(F.inline(F.array(*cells)))


def todays_weather_table(forecasts: DataFrame, today: str) -> DataFrame:
    return weather_table(warehouse.todays_forecast(forecasts, today))


def highlights(forecasts: DataFrame, landmarks: DataFrame, today: str) -> DataFrame:
    """Coldest, windiest and rainiest place today, with the rain probability."""
    placed = joins.with_landmarks(warehouse.todays_forecast(forecasts, today), landmarks)
    rain = placed.agg(F.bround(F.max("precipProb"), 1).alias("max_precip"))
    return aggregate.weather_extremes(placed).crossJoin(F.broadcast(rain))  # one row each


def forecast_bounds(preparations: DataFrame, today: str) -> DataFrame:
    """Bounds of today's one-day-ahead forecast, as shown: whole numbers, thousands separated."""
    row = warehouse.preparedness_row(preparations, today)
    return row.select(
        F.format_string("%d", F.bround(F.col("Outages_LL_95").cast("double"), 0).cast("bigint")).alias("Outages_LL_95"),
        F.format_string("%d", F.bround(F.col("Outages_UL_95").cast("double"), 0).cast("bigint")).alias("Outages_UL_95"),
        F.format_string("%d", F.bround(F.col("Customers_LL_95").cast("double"), 0).cast("bigint")).alias("Customers_LL_95"),
        F.format_number(F.bround(F.col("Customers_UL_95").cast("double"), 0), 0).alias("Customers_UL_95"),
    )

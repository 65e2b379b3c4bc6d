"""Outages and customers to expect per day, from forecast weather."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stormgrid import constants as C
from stormgrid.models import components, forecasts
from stormgrid.operators import aggregate, joins, latest, reshape
from stormgrid.session import materialize


def wide_days(weather: DataFrame, features: list[str] = C.WEATHER_FEATURES, complete_only: bool = True) -> DataFrame:
    """Model rows (one per day, so never more than the calendar), stored because fitting reads them repeatedly."""
    return materialize(reshape.marker_vectors(latest.latest_forecasts(weather), features, complete_only=complete_only), "no day of weather for all markers")


def incomplete_as_null(days: DataFrame, features: list[str]) -> DataFrame:
    """Days on which a marker lacks a value lack that value altogether: the other markers do not stand for the day."""
    whole = Window.partitionBy("Date")
    return days.withColumns({f: F.when(F.min(F.col(f).isNotNull()).over(whole), F.col(f)) for f in features})


def customer_days(weather: DataFrame, complete_only: bool = True) -> DataFrame:
    """The day roll-up reduced to the inputs of the customer model.

    Fitting takes the complete markers of a day. Scoring (`complete_only` off) gives a
    day a forecast only if every marker has the inputs.
    """
    days = latest.latest_forecasts(weather).withColumn("Date", F.to_date("timestamp"))
    rolled = aggregate.weather_day_rollup(days.dropna(subset=C.ROLLUP_FEATURES) if complete_only else incomplete_as_null(days, C.ROLLUP_FEATURES))
    return materialize(rolled.select("Date", *C.CUSTOMER_MODEL_FEATURES), "no day of weather")


def expected_days(history: DataFrame, actuals: DataFrame, forecast: DataFrame, today, features: list[str] = C.WEATHER_FEATURES) -> DataFrame:
    """Both forecasts with their bands, trained on past weather and day totals."""
    past = wide_days(history, features)
    model = components.fit_components(past, reshape.vector_names(features))
    totals = materialize(actuals.withColumnRenamed("Outages_recorded", "OUTAGES"), "no day totals")
    scored = model.scores(past).join(totals.select("Date", "OUTAGES"), "Date")
    names = [f"PC{i + 1}" for i in range(len(model.signs))]
    count_model = forecasts.choose_outage_inputs(scored, names)
    customer_model = forecasts.choose_customer_hinges(customer_days(history).join(totals.select("Date", "CUST_QTY"), "Date"))
    outages = forecasts.forecast_outages(count_model, model.scores(wide_days(forecast, features, complete_only=False)))
    customers = forecasts.forecast_customers(customer_model, customer_days(forecast, complete_only=False))
    return joins.collate_forecasts(outages, customers, today)

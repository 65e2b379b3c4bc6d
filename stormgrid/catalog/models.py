"""Queries: standardising, components and the trained forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from stormgrid import constants as C
from stormgrid.catalog import tables as t
from stormgrid.catalog.oracle import sql
from stormgrid.catalog.ordering import live_table
from stormgrid.catalog.registry import query
from stormgrid.functions import times
from stormgrid.models import components, forecasts
from stormgrid.operators import aggregate, reshape
from stormgrid.plans import diagnostics, preparedness, profiles, restoration

_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    "zscore",
    sql("", f"SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, {', '.join(f'round(({c} - m_{c}) / s_{c}, 6) + 0 AS {c}' for c in _COLS)} FROM lineitem, s",
        {"s": f"SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}' for c in _COLS)} FROM lineitem"}),
)
def zscore(spark, folder):
    rows = t.load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", *_COLS)
    return components.zscores(rows, _COLS).withColumns({c: F.round(c, 6) + 0 for c in _COLS})


def _day_totals(spark, folder):
    """Outages and customers per day of the live feed."""
    outages = live_table(spark, folder).select("OUTAGE_ID", "CUST_QTY", F.to_date("CREATION_DATETIME").alias("Date"))
    return outages.groupBy("Date").agg(F.count("*").alias("Outages_recorded"), aggregate.total("CUST_QTY").cast("bigint").alias("CUST_QTY"))


@query("pca_scores")
def pca_scores(spark, folder):
    wide = preparedness.wide_days(t.forecast_day(spark, folder))
    return components.fit_components(wide, reshape.vector_names()).scores(wide)


@query("pca_variance")
def pca_variance(spark, folder):
    wide = preparedness.wide_days(t.forecast_day(spark, folder))
    return components.fit_components(wide, reshape.vector_names()).variance(spark)


RESTORATION_INPUTS = ["CALL_QTY", "CUST_QTY", "DOWNSTREAM_KVA_VAL", "DAY_FLAG", "Hour_Sin", "Hour_Cos", "weekend_flag"]


@query("etr_random_forest")
def etr_random_forest(spark, folder):
    """Trained on the durations of the history; published form."""
    created = F.col("CREATION_DATETIME")
    outages = aggregate.with_restoration_minutes(diagnostics.facility_outages(t.facility(spark, folder))).withColumns(
        {"DAY_FLAG": times.day_flag(created), "Hour_Sin": times.hour_sin(created), "Hour_Cos": times.hour_cos(created),
         "weekend_flag": times.weekend_flag(created), "Marker_Location": F.lit("Marker 1")}
    )
    model = forecasts.fit_restoration(outages, RESTORATION_INPUTS, trees=20, depth=6)
    return restoration.restoration_output(model.predict(outages, "Predicted_TTR"), t.storm_profiles(spark, folder))


@query("outage_count_model")
def outage_count_model(spark, folder):
    wide = preparedness.wide_days(t.forecast_day(spark, folder))
    scores = components.fit_components(wide, reshape.vector_names()).scores(wide)
    training = scores.join(_day_totals(spark, folder).withColumnRenamed("Outages_recorded", "OUTAGES"), "Date")
    model = forecasts.fit_outage_count(training, [f"PC{i}" for i in range(1, 8)])
    return forecasts.forecast_outages(model, scores)


@query("customer_model")
def customer_model(spark, folder):
    days = preparedness.customer_days(t.forecast_day(spark, folder))
    model = forecasts.fit_customers(days.join(_day_totals(spark, folder).select("Date", "CUST_QTY"), "Date"))
    return forecasts.forecast_customers(model, days)


@query("expected_days")
def expected_days(spark, folder):
    daily = t.forecast_day(spark, folder)
    return preparedness.expected_days(daily, _day_totals(spark, folder), daily, F.lit("2024-01-15").cast("date"))


@query("profile_classifier")
def profile_classifier(spark, folder):
    """Trained on the labelled days, scored for the two days after."""
    rows = profiles.profile_inputs(t.forecast_day(spark, folder))
    labels = t.storm_profiles(spark, folder).select(F.col("timestamp").alias("Date"), "Location", "clusters")
    model = forecasts.fit_profiles(rows.join(labels, ["Date", "Location"]), C.WEATHER_FEATURES, trees=20, depth=5)
    return profiles.forecast_profiles(model, t.forecast_day(spark, folder), F.lit("2024-01-15").cast("date"))

"""Actual against predicted: per outage and per day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormgrid import constants as C
from stormgrid.functions import times
from stormgrid.operators import aggregate, clean
from stormgrid.operators.latest import keep_newest, keep_oldest, upsert

ACTUAL = ["OUTAGE_ID", *C.GRAIN, "CREATION_DATETIME", "ENERGIZED_DATETIME", "TTR"]


def facility_outages(facility: DataFrame) -> DataFrame:
    return aggregate.facility_grain(clean.outage_rows(facility))


def with_durations(outages: DataFrame) -> DataFrame:
    timed = aggregate.with_restoration_minutes(outages)
    promised = times.promised_hours(F.col("CREATION_DATETIME"), F.col("ETR_DATETIME"))
    return clean.negative_to_null(timed.withColumn("OMS_ETR", promised), "OMS_ETR")


def restoration_diagnostic(facility: DataFrame, predictions: DataFrame) -> DataFrame:
    """Outages with both an actual and a predicted duration.

    The promised time rides along with the actuals, so nothing has to be joined back.
    """
    actual = keep_newest(with_durations(facility_outages(facility)), ["OUTAGE_ID"], C.GRAIN)
    actual = actual.select(*ACTUAL, "ETR_DATETIME", "OMS_ETR").where(F.col("TTR") > C.MIN_DIAGNOSTIC_TTR)
    own = [c for c in predictions.columns if c == "OUTAGE_ID" or c not in actual.columns]
    first = keep_oldest(predictions, ["OUTAGE_ID"], ["Last_Updated"]).dropna().select(*own)
    # All prediction columns must be present, so the left join with drop-null is an inner join.
    merged = actual.join(first, "OUTAGE_ID").dropna(subset=ACTUAL)
    return merged.withColumns({"TTR": F.col("TTR").cast("bigint"), "ETR": F.col("ETR").cast("bigint")})


def update_diagnostics(history: DataFrame, batch: DataFrame) -> DataFrame:
    """Diagnostic history with the newest entry per outage and uniform number types."""
    merged = upsert(history.distinct(), batch, ["OUTAGE_ID"])
    return merged.withColumns({c: F.col(c).cast("double") for c in ("TTR", "ETR", "OMS_ETR")})


def day_comparison(facility: DataFrame, preparations: DataFrame) -> DataFrame:
    """Day totals beside the stored forecasts of the same day (one row per horizon)."""
    return aggregate.daily_actuals(facility_outages(facility)).join(preparations.distinct(), "Date")

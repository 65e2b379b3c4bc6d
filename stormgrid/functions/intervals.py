"""95 % bands whose width depends on the size of the forecast."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stormgrid import constants as C
from stormgrid.functions.choose import first_match


def residual_deviation(forecast: Column, bands: list[tuple]) -> Column:
    return first_match(
        (forecast.isNotNull() if upper is None else forecast <= upper, sigma) for upper, sigma in bands
    )


def interval(forecast: Column, bands: list[tuple]) -> tuple[Column, Column]:
    """Lower (never below zero) and upper bound, rounded half-even to whole numbers."""
    half = residual_deviation(forecast, bands) * F.lit(C.BAND_Z)
    # `when` keeps an unknown forecast unknown; greatest() alone would turn it into 0.
    lower = F.when(forecast.isNotNull(), F.greatest(F.lit(0.0), forecast - half))
    return F.bround(lower, 0).cast("int"), F.bround(forecast + half, 0).cast("int")


def outage_interval(forecast: Column) -> tuple[Column, Column]:
    return interval(forecast, C.OUTAGE_BANDS)


def customer_interval(forecast: Column) -> tuple[Column, Column]:
    return interval(forecast, C.CUSTOMER_BANDS)

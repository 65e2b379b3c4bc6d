"""Expressions over weather columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgrid import constants as C
from stormgrid.functions.choose import first_match


def wind_sector(degrees: Column) -> Column:
    """Named sector of a direction; below 1 and from 360 on there is none."""
    return first_match(((degrees >= low) & (degrees < high), name) for low, high, name in C.WIND_SECTORS)


def range_and_ratio(df: DataFrame) -> DataFrame:
    """Spread and ratio columns; a ratio over zero is null."""
    columns = {f"{n}Range": F.col(f"{n}Max") - F.col(f"{n}Min") for n in C.RANGE_FEATURES}
    columns |= {f"{n}Ratio": F.try_divide(f"{n}Max", f"{n}Min") for n in C.RATIO_FEATURES}
    return df.withColumns(columns)


def marker_key(location: Column) -> Column:
    """'XXX_Marker12' -> 'Marker12': the form both sides of the weather join share."""
    return F.translate(F.substr(location, F.lit(5)), " ", "")


def outage_marker_key(marker: Column) -> Column:
    """'Marker 12' -> 'Marker12'."""
    return F.translate(marker, " ", "")


def spaced_marker(location: Column, prefix: str = C.LOCATION_PREFIX) -> Column:
    """'XXX_Marker12' -> 'Marker 12'."""
    bare = F.replace(location, F.lit(f"{prefix}_"), F.lit(""))
    return F.trim(F.regexp_replace(bare, r"([0-9]+(\.[0-9]+)?)", " $1 "))


def profile_text(cluster: Column) -> Column:
    """Description of a weather profile; an unknown one has an empty text."""
    return first_match((cluster == name, text) for name, text in C.PROFILES.items()).otherwise("")


def profile_text_by_index(index: Column) -> Column:
    """Description by 1-based position."""
    return F.get(F.array(*[F.lit(text) for text in C.PROFILES.values()]), (index - 1).cast("int"))


def second_best(probabilities: Column) -> Column:
    """Struct (index, probability) of the second most probable class; the lower index wins a tie."""
    ranked = F.array_sort(
        F.transform(probabilities, lambda p, i: F.struct((-p).alias("order"), (i + 1).alias("index"), p.alias("prob")))
    )
    second = F.get(ranked, F.lit(1))
    return F.struct(second["index"].alias("index"), second["prob"].alias("prob"))

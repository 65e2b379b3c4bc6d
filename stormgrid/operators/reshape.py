"""Long to wide, and the input columns of the component model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormgrid import constants as C
from stormgrid.functions import weather


def marker_pivot(df: DataFrame, features: list[str] = C.WEATHER_FEATURES, markers: int = len(C.MARKERS)) -> DataFrame:
    """One row per day with a `MARKER{i}_{feature}` column for every marker and feature.

    The explicit list of markers spares the job that would otherwise look for the
    distinct ones. Days without the first marker are left out.
    """
    names = [f"MARKER{i}" for i in range(1, markers + 1)]
    long = df.select(
        F.to_date("timestamp").alias("Date"), F.upper(weather.marker_key(F.col("Location"))).alias("_marker"), *features
    )
    wide = long.groupBy("Date").pivot("_marker", names).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.first(f).alias(f) for f in features]
    )
    return wide.where(F.col("MARKER1__rows") > 0).select("Date", *[f"{m}_{f}" for m in names for f in features])


def marker_vectors(df: DataFrame, features: list[str] = C.WEATHER_FEATURES, markers: int = len(C.MARKERS), complete_only: bool = True) -> DataFrame:
    """The same wide row as one array per day, marker after marker, for the model.

    Takes one row per day and marker, so a day gathers at most `markers` short arrays.
    A marker without a row counts as missing values. Days with any are left out, as
    fitting needs, unless `complete_only` is off: scoring then gives them null forecasts.
    """
    long = df.select(
        F.to_date("timestamp").alias("Date"),
        F.regexp_extract(F.upper(weather.marker_key(F.col("Location"))), r"^MARKER(\d+)$", 1).try_cast("int").alias("_marker"),
        F.array(*features).alias("_values"),
    ).where(F.col("_marker").between(1, markers))
    one = long.groupBy("Date", "_marker").agg(F.first("_values").alias("_values"))
    days = one.groupBy("Date").agg(F.map_from_entries(F.collect_list(F.struct("_marker", "_values"))).alias("_all"))
    nothing = F.array_repeat(F.lit(None).cast("double"), len(features))
    parts = F.transform(F.sequence(F.lit(1), F.lit(markers)), lambda i: F.coalesce(F.try_element_at("_all", i), nothing))
    wide = days.select("Date", F.flatten(parts).alias("features"))
    return wide.where(~F.exists("features", lambda v: v.isNull() | F.isnan(v))) if complete_only else wide


def vector_names(features: list[str] = C.WEATHER_FEATURES, markers: int = len(C.MARKERS)) -> list[str]:
    """Names of the positions of `marker_vectors`."""
    return [f"MARKER{i}_{f}" for i in range(1, markers + 1) for f in features]


def model_columns(df: DataFrame) -> list[str]:
    """Columns that take part in standardising and components."""
    left_out = set(C.COMPONENT_LABELS)
    return [c for c in df.columns if c not in left_out and not c.endswith(f"_{C.COMPONENT_SKIPPED_FEATURE}")]

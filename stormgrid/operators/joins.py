"""Joins of the outage tables.

No side is hinted for broadcast unless it is a literal or has a one-row-per-day
bound: dimension and weather tables are broadcast when their size, as measured
by the optimizer or at run time, is under the session's threshold, and otherwise
go through a shuffle join whose hot partitions adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormgrid import constants as C
from stormgrid.functions import flags, geo, times, weather

LOCATION_FIELDS = ["MAJ_OTG_ID", "CITY_NAM", "OCCURN_CD", "CAUSE_CD", "ENERGIZED_DATETIME"]


def device_locations(device: DataFrame, location: DataFrame) -> DataFrame:
    """Device rows with the attributes of their location; several location rows fan out."""
    keys = ["INCIDENT_ID", "LOCATION_ID"]
    return device.join(location.select(*keys, *LOCATION_FIELDS), keys, "left")


def with_descriptions(df: DataFrame, clues: DataFrame, occurrences: DataFrame, causes: DataFrame) -> DataFrame:
    """Texts of the three codes."""
    return (
        df.join(clues.select("CLUE_CD", "CLUE_DESC"), "CLUE_CD", "left")
        .join(occurrences.select("OCCURN_CD", "OCCURN_DESC"), "OCCURN_CD", "left")
        .join(causes.select("CAUSE_CD", "CAUSE_DESC"), "CAUSE_CD", "left")
    )


def with_flag_masks(df: DataFrame, clues: DataFrame, occurrences: DataFrame, causes: DataFrame) -> DataFrame:
    """Keyword flags of the three codes, packed into one number per code.

    Texts are searched once per code, on the code tables, instead of once per row.
    A code listed twice is merged first, so rows are never multiplied.
    """
    for codes, code, desc, table, mask in (
        (clues, "CLUE_CD", "CLUE_DESC", C.CLUE_KEYWORDS, "CLUE_MASK"),
        (occurrences, "OCCURN_CD", "OCCURN_DESC", C.OCCURRENCE_KEYWORDS, "OCCURN_MASK"),
        (causes, "CAUSE_CD", "CAUSE_DESC", C.CAUSE_KEYWORDS, "CAUSE_MASK"),
    ):
        packed = flags.pack(flags.keyword_conditions(desc, table))
        df = df.join(codes.groupBy(code).agg(F.bit_or(packed).alias(mask)), code, "left")
    return df


def with_coordinates(outages: DataFrame, location: DataFrame) -> DataFrame:
    """Degrees of the location's state-plane point, and the zone they fall in."""
    degrees = geo.with_state_plane_degrees(
        location.select("INCIDENT_ID", "LOCATION_ID", "GEO_X_COORD", "GEO_Y_COORD"), "GEO_X_COORD", "GEO_Y_COORD"
    )
    placed = outages.join(
        degrees.select("INCIDENT_ID", "LOCATION_ID", "LAT", "LONG"), ["INCIDENT_ID", "LOCATION_ID"], "left"
    )
    return placed.withColumn("ZONE", geo.zone(F.col("LAT"), F.col("LONG")))


def with_nearest_marker(df: DataFrame, markers: list[tuple[float, float]] = C.MARKERS) -> DataFrame:
    return df.withColumn("_near", geo.nearest_point("LAT", "LONG", markers)).withColumns(
        {
            "Min_Distance": geo.haversine_of(F.col("_near.a")),
            "Marker_Location": F.expr("IF(_near.a IS NOT NULL, concat('Marker ', _near.index), NULL)"),
        }
    ).drop("_near")


def with_nearest_depot(df: DataFrame, depots: list[tuple[str, float, float]] = C.DEPOTS) -> DataFrame:
    """Dispatch area by ellipsoidal distance, with the default for outages without coordinates."""
    nearest = geo.nearest_point_miles([(lat, lon) for _, lat, lon in depots])
    names = F.array(*[F.lit(name) for name, _, _ in depots])
    return df.withColumn("_near", nearest("LAT", "LONG")).withColumns(
        {
            "Depot_Miles": F.col("_near.miles"),
            "Dispatch_Location": F.coalesce(F.get(names, F.col("_near.index") - 1), F.lit(C.NO_LOCATION)),
        }
    ).drop("_near")


#: No feed reaches further back. Stated as a filter, it tells the optimizer that the
#: dates of the outages select among those of the weather, so that tables stored by
#: date (`warehouse.store_by_date`) are pruned to the dates that occur.
FIRST_DATE = "1900-01-01"


def by_date(forecasts: DataFrame) -> DataFrame:
    """Weather with its `Date`: the stored partition column, or else the date of the timestamp."""
    return forecasts if "Date" in forecasts.columns else forecasts.withColumn("Date", F.to_date("timestamp"))


def dates_of(outages: DataFrame) -> DataFrame:
    """Outages with the date they began on (`_day`), without those that have none."""
    day = F.to_date("CREATION_DATETIME")
    return outages.withColumn("_day", day).where(day >= F.lit(FIRST_DATE).cast("date"))


def weather_for_dates(forecasts: DataFrame, outages: DataFrame) -> DataFrame:
    """Forecast rows of the dates on which outages began: a semi join on the distinct dates."""
    days = dates_of(outages).select(F.col("_day").alias("Date")).distinct()
    return by_date(forecasts).join(days, "Date", "left_semi")


def with_weather(outages: DataFrame, forecasts: DataFrame, features: list[str]) -> DataFrame:
    """Weather of the outage's marker and day, with the derived ranges and classes."""
    relevant = weather_for_dates(forecasts, outages) if "Date" in forecasts.columns else by_date(forecasts)
    enriched = weather.range_and_ratio(
        relevant.withColumns({"_day": F.col("Date"), "_marker": weather.marker_key(F.col("Location"))})
    )
    derived = [f"{n}Range" for n in C.RANGE_FEATURES] + [f"{n}Ratio" for n in C.RATIO_FEATURES]
    dated = outages.withColumns(
        {"_day": F.to_date("CREATION_DATETIME"), "_marker": weather.outage_marker_key(F.col("Marker_Location"))}
    )
    joined = dated.join(enriched.select("_day", "_marker", *features, *derived), ["_day", "_marker"], "left")
    if "windDirAvg" in features:
        joined = joined.withColumn("WIND_DIRECTION", weather.wind_sector(F.col("windDirAvg")))
    return joined.withColumn("weekend_flag", times.weekend_flag(F.col("CREATION_DATETIME"))).drop("_day", "_marker")


def with_profile(outages: DataFrame, profiles: DataFrame) -> DataFrame:
    """Weather profile text of the outage's marker and day."""
    relevant = weather_for_dates(profiles, outages) if "Date" in profiles.columns else by_date(profiles)
    labels = relevant.select(
        F.col("Date").alias("_day"),
        weather.outage_marker_key(F.col("Location")).alias("_marker"),
        weather.profile_text(F.col("clusters")).alias("Cluster_ID"),
    )
    dated = outages.withColumns(
        {"_day": F.to_date("CREATION_DATETIME"), "_marker": weather.outage_marker_key(F.col("Marker_Location"))}
    )
    return dated.join(labels, ["_day", "_marker"], "left").drop("_day", "_marker")


def not_yet_predicted(outages: DataFrame, predictions: DataFrame, key: str = "OUTAGE_ID") -> DataFrame:
    """Outages whose id (spaces taken out) has no prediction."""
    done = predictions.select(F.col(key)).distinct()
    return outages.withColumn(key, flags.strip_spaces(F.col(key).cast("string"))).join(done, key, "left_anti")


def with_landmarks(forecasts: DataFrame, landmarks: DataFrame) -> DataFrame:
    return forecasts.join(landmarks.select("Location", "Landmark"), "Location", "left")


def full_outer_on_common(left: DataFrame, right: DataFrame) -> DataFrame:
    """Full outer join on all columns both sides have; a missing key matches a missing key."""
    common = [c for c in left.columns if c in right.columns]
    l, r = left.alias("l"), right.alias("r")
    same = None
    for c in common:
        test = F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
        same = test if same is None else same & test
    keys = [F.coalesce(F.col(f"l.{c}"), F.col(f"r.{c}")).alias(c) for c in common]
    rest = [F.col(f"l.{c}") for c in left.columns if c not in common]
    rest += [F.col(f"r.{c}") for c in right.columns if c not in common]
    return l.join(r, same, "full").select(*keys, *rest)


def collate_forecasts(outages: DataFrame, customers: DataFrame, today) -> DataFrame:
    """Both day forecasts side by side, with the name of their horizon."""
    joined = outages.join(customers, "Date", "left")
    return joined.select(
        "Date",
        times.horizon_label(F.col("Date"), today).alias("Number_of_days_ahead"),
        F.bround("predicted_Number_of_OUTAGES", 0).cast("bigint").alias("Number_of_outages"),
        F.col("Predicted_Cust_Qty").alias("Customer_quantity"),
        "Customers_LL_95",
        "Customers_UL_95",
        "Outages_LL_95",
        "Outages_UL_95",
    )

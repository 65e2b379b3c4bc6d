"""Keyed aggregations. Each is one shuffle with map-side partial aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgrid import constants as C
from stormgrid.functions import flags, times


def total(column: str | Column) -> Column:
    """Sum that is 0, not null, when every value is missing."""
    return F.coalesce(F.sum(column), F.lit(0))


def _grain(df: DataFrame):
    return df.dropna(subset=C.GRAIN).groupBy(*C.GRAIN)


def numeric_aggregates() -> list[Column]:
    """Aggregates of the live feed at the outage grain."""
    return [
        total("CALL_QTY").cast("bigint").alias("CALL_QTY"),
        total("DOWNSTREAM_CUST_QTY").cast("bigint").alias("CUST_QTY"),
        F.max("KVA_VAL").alias("KVA_VAL"),
        F.max("DOWNSTREAM_KVA_VAL").alias("DOWNSTREAM_KVA_VAL"),
        F.max("INCIDENT_DEVICE_ID").alias("INCIDENT_DEVICE_ID"),
        F.min("CREATION_DATETIME").alias("CREATION_DATETIME"),
        F.min("SUBST_ID").alias("SUBST_ID"),
        F.max("LOCATION_ID").alias("LOCATION_ID"),
        F.max("ENERGIZED_DATETIME").alias("ENERGIZED_DATETIME"),
    ]


def city_aggregate(order: str = "INCIDENT_DEVICE_ID") -> Column:
    """City of the group: the first known one by the given order, else the default."""
    city = flags.normal_city(F.col("CITY_NAM"))
    first = F.min(F.when(city != C.NO_CITY, F.struct(F.col(order), city.alias("city"))))["city"]
    return F.coalesce(first, F.lit(C.NO_CITY)).alias("CITY_NAM")


KEYWORD_MASKS = {
    "CLUE_MASK": list(C.CLUE_KEYWORDS),
    "CAUSE_MASK": list(C.CAUSE_KEYWORDS),
    "OCCURN_MASK": list(C.OCCURRENCE_KEYWORDS),
}
MASKS = KEYWORD_MASKS | {"PRIORITY_MASK": C.PRIORITY_FLAGS}


def flag_aggregates() -> list[Column]:
    """Bits set on any row of the group: four numbers travel instead of 51 flags."""
    priority = flags.pack(flags.priority_conditions("PRIORITY_VAL"))
    packed = [F.bit_or(name).alias(name) for name in KEYWORD_MASKS]
    return [*packed, F.bit_or(priority).alias("PRIORITY_MASK")]


def unpacked(df: DataFrame) -> DataFrame:
    """Flags as 0/1 columns; a table that has them as columns already is left as it is."""
    return flags.unpack(df, MASKS) if set(MASKS) <= set(df.columns) else df


def outage_grain(df: DataFrame) -> DataFrame:
    """Live feed: quantities and extremes per outage."""
    return with_labels(_grain(df).agg(*numeric_aggregates()))


def facility_grain(df: DataFrame) -> DataFrame:
    """Daily history: quantities, extremes and the promised time per outage."""
    return with_labels(
        _grain(df).agg(
            total("CALL_QTY").cast("bigint").alias("CALL_QTY"),
            total("DOWNSTREAM_CUST_QTY").cast("bigint").alias("CUST_QTY"),
            F.max("KVA_VAL").alias("KVA_VAL"),
            F.max("DOWNSTREAM_KVA_VAL").alias("DOWNSTREAM_KVA_VAL"),
            F.min("CREATION_DATETIME").alias("CREATION_DATETIME"),
            F.max("ENERGIZED_DATETIME").alias("ENERGIZED_DATETIME"),
            F.min("SUBST_ID").alias("SUBST_ID"),
            F.max("MAJ_OTG_ID").alias("MAJ_OTG_ID"),
            F.max("ETR_DATETIME").alias("ETR_DATETIME"),
        )
    )


def outage_flags(df: DataFrame) -> DataFrame:
    """Any-of flags per outage, from rows with packed flags."""
    return flags.unpack(_grain(df).agg(*flag_aggregates()), MASKS)


def outage_cities(df: DataFrame) -> DataFrame:
    return _grain(df).agg(city_aggregate())


def outage_table(df: DataFrame, packed: bool = False) -> DataFrame:
    """Quantities, flags and city per outage in a single aggregation (one shuffle).

    `packed` flags stay four numbers, for steps that move rows before they need them
    (`unpacked` gives the columns).
    """
    table = with_labels(_grain(df).agg(*numeric_aggregates(), *flag_aggregates(), city_aggregate()))
    table = table if packed else unpacked(table)
    created = F.col("CREATION_DATETIME")
    return table.withColumns(
        {"DAY_FLAG": times.day_flag(created), "Hour_Sin": times.hour_sin(created), "Hour_Cos": times.hour_cos(created)}
    )


def with_labels(df: DataFrame) -> DataFrame:
    whole = df.withColumns({"INCIDENT_ID": F.col("INCIDENT_ID").cast("bigint"), "CIRCT_ID": F.col("CIRCT_ID").cast("bigint")})
    return whole.withColumn("OUTAGE_ID", flags.outage_label())


def daily_counters(df: DataFrame) -> DataFrame:
    """Sums of the tracked flags per creation date."""
    dated = df.withColumn("Date", F.to_date("CREATION_DATETIME")).dropna(subset=["Date"])
    return dated.groupBy("Date").agg(*[total(flag).cast("bigint").alias(name) for name, flag in C.DAILY_COUNTERS.items()])


def merge_counters(state: DataFrame, batch: DataFrame) -> DataFrame:
    """Adds a batch of daily counters to the running ones."""
    both = state.unionByName(batch, allowMissingColumns=True)
    return both.groupBy("Date").agg(*[total(name).cast("bigint").alias(name) for name in C.DAILY_COUNTERS])


def distinct_count(df: DataFrame, column: str, approximate: bool = False, error: float = 0.01) -> DataFrame:
    """Distinct ids. The exact form first shuffles the distinct values, so no task holds them all."""
    if approximate:
        return df.agg(F.approx_count_distinct(column, error).alias("distinct_ids"))
    return df.agg(F.count_distinct(column).alias("distinct_ids"))


def with_restoration_minutes(df: DataFrame) -> DataFrame:
    return df.withColumn("TTR", times.restoration_minutes(F.col("CREATION_DATETIME"), F.col("ENERGIZED_DATETIME")))


def daily_actuals(outages: DataFrame) -> DataFrame:
    """Customers and outages per day, of outages longer than the minimum."""
    long_enough = with_restoration_minutes(outages).where(F.col("TTR") > C.MIN_DIAGNOSTIC_TTR)
    dated = long_enough.withColumn("Date", F.to_date("CREATION_DATETIME"))
    return dated.groupBy("Date").agg(
        total("CUST_QTY").cast("bigint").alias("CUST_QTY"), F.count("OUTAGE_ID").alias("Outages_recorded")
    )


def rollup_function(feature: str):
    if feature in C.ROLLUP_MAX or feature.endswith("Max"):
        return F.max
    return F.min if feature.endswith("Min") else F.avg


def weather_day_rollup(df: DataFrame, key: str = "Date", features: list[str] = C.ROLLUP_FEATURES) -> DataFrame:
    """All markers of a day in one row; the statistic follows from the feature name."""
    return df.groupBy(key).agg(*[rollup_function(f)(f).alias(f) for f in features])


def weather_summary(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Extremes, means and medians over all locations of a day.

    The exact median buffers distinct values with their counts; for more rows than a
    day of markers choose the approximate one.
    """
    median = (lambda c: F.percentile_approx(c, 0.5, 10000).cast("double")) if approximate else F.median
    return df.agg(
        F.min("tempMin").alias("temp_min"),
        F.max("tempMax").alias("temp_max"),
        median("tempAvg").alias("temp_median"),
        F.min("windSpdMin").alias("wind_min"),
        F.max("windSpdMax").alias("wind_max"),
        median("windSpdAvg").alias("wind_median"),
        F.avg("precipProb").alias("precip_mean"),
        F.avg("snowfallProb").alias("snow_mean"),
        F.max("precipProb").alias("precip_max"),
        median("windDirAvg").alias("wind_direction_median"),
    )


def weather_extremes(df: DataFrame, label: str = "Landmark", key: str = "Location") -> DataFrame:
    """Place of the lowest temperature, strongest wind and likeliest rain; first key wins a tie."""
    def place(measure: Column, known: Column):
        ranked = F.struct(measure.alias("measure"), F.col(key).alias("key"), F.col(label).alias("label"))
        return F.min(F.when(known, ranked))["label"]

    return df.agg(
        place(F.col("tempMin"), F.col("tempMin").isNotNull()).alias("min_temp_place"),
        place(-F.col("windSpdMax"), F.col("windSpdMax").isNotNull()).alias("max_wind_place"),
        place(-F.col("precipProb"), F.col("precipProb").isNotNull()).alias("max_precip_place"),
    )


def column_statistics(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation and extremes: one row per column, one pass."""
    stats = df.agg(
        *[
            F.struct(
                F.lit(name).alias("feature"), F.count(name).alias("n"), F.avg(name).alias("mean"),
                F.stddev_samp(name).alias("std"), F.min(name).cast("double").alias("min"), F.max(name).cast("double").alias("max"),
            ).alias(name)
            for name in columns
        ]
    )
    return stats.select(F.inline(F.array(*columns)))


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing values per column, one pass."""
    columns = columns or df.columns
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    pairs = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("nulls")) for n in columns])
    return counts.select(F.inline(pairs)).withColumn("has_nulls", (F.col("nulls") > 0).cast("bigint"))


def grain_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows_per_key")).where("rows_per_key > 1")


def duplicate_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows before and after dropping duplicate keys."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(total("n").cast("bigint").alias("rows_total"), F.count("*").alias("rows_distinct"))

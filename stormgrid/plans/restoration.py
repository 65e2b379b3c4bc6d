"""Live outages from the raw feeds to published restoration times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgrid import constants as C
from stormgrid.functions import flags, times
from stormgrid.operators import aggregate, clean, joins, priority
from stormgrid.operators.latest import keep_newest, latest_forecasts
from stormgrid.operators.ordered import ROW, attach_by_value, day_ranks, forward_fill, gap_values, numbered, with_gap_values
from stormgrid.operators.trailing import known_outages, trailing_counts
from stormgrid.models.forecasts import Regression
from stormgrid.session import dealt_by_part_of_keys, stored_steps
from stormgrid.sources import sinks

PUBLISHED = [
    "OUTAGE_ID", "INCIDENT_ID", "STRCTUR_NO", "CIRCT_ID", "DNI_EQUIP_TYPE", "Creation_Time",
    "Estimated_Restoration_Time", "ETR", "Weather_Profile",
]


def outage_table(device: DataFrame, location: DataFrame, clues: DataFrame, occurrences: DataFrame, causes: DataFrame, packed: bool = False) -> DataFrame:
    """Cleaned feeds, one row per outage with quantities, flags (as columns, or `packed`) and city."""
    rows = clean.outage_rows(joins.device_locations(device, location))
    return aggregate.outage_table(joins.with_flag_masks(rows, clues, occurrences, causes), packed)


def stored_outages(device: DataFrame, location: DataFrame, clues: DataFrame, occurrences: DataFrame, causes: DataFrame) -> DataFrame:
    """The outage table with packed flags, stored and `numbered`.

    Both feeds are dealt out by incident, which is part of the join's keys and of the
    outage's: rows move once, not again by location and by outage.
    """
    with dealt_by_part_of_keys(device.sparkSession):
        table = outage_table(device.repartition("INCIDENT_ID"), location.repartition("INCIDENT_ID"), clues, occurrences, causes, packed=True)
        return numbered(table, "no outage to place")


def located_outages(outages: DataFrame, location: DataFrame, run_ts: Column | None = None, wanted: Column | None = None) -> DataFrame:
    """Adds zone, rank within the day, filled coordinates, weather marker and dispatch area.

    All outages count for ranks and fills; only the `wanted` ones (all by default) are
    returned. The outages are read more than once, so they are stored first, unless
    they are `numbered` already. Coordinates and ranks are found beside the stored rows,
    which move only to be joined with them.
    """
    stored = outages if ROW in outages.columns else numbered(outages, "no outage to place")
    wanted = F.lit(True) if wanted is None else wanted
    order = [*C.GRAIN, "LOCATION_ID"]
    points = joins.with_coordinates(stored.select(ROW, *order, wanted.alias("_wanted")), location)
    filled = forward_fill(points, ["LAT", "LONG"], order, keep=[ROW, "LAT", "LONG", "ZONE", "_wanted"]).where("_wanted").drop("_wanted")
    chosen = stored.where(wanted)
    times_of = chosen.select(ROW, "CREATION_DATETIME")
    ranks = attach_by_value(times_of, day_ranks(stored, "CREATION_DATETIME"), "CREATION_DATETIME").select(ROW, F.col("_dense").alias("RANK_SUBSEQUENT_OUTAGES"))
    placed = chosen.join(filled, ROW).join(ranks, ROW).drop(ROW)
    if run_ts is not None:
        placed = placed.withColumn("INSERTION_TIME", times.insertion_stamp(run_ts))
    return joins.with_nearest_depot(joins.with_nearest_marker(placed))


def weather_outages(outages: DataFrame, forecasts: DataFrame, features: list[str] = C.WEATHER_FEATURES, dated: DataFrame | None = None) -> DataFrame:
    """Weather of each outage; the dates are those of `dated`, a stored table with the same or more of them, else of the outages."""
    relevant = joins.weather_for_dates(forecasts, outages if dated is None else dated).drop("Date")
    return joins.with_weather(outages, latest_forecasts(relevant), features)


def curated_outages(outages: DataFrame, predictions: DataFrame, counters: DataFrame | None = None, today: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Open, not yet predicted outages with queue positions, counters and trailing counts.

    Returns them with the running daily counters, which the caller stores for the next run.
    Open and fresh outages are each read by several operators, so they are stored once, with
    a number for every row. Ranks, fills and counts move that number and the columns they
    work on; the whole rows move when what was found is joined to them. Flags that came
    packed stay so until then.
    """
    open_outages = numbered(clean.still_out(outages), "all outages have power again")
    queued = priority.by_distance(priority.by_customers(open_outages.select(ROW, "OUTAGE_ID", "CUST_QTY", "LAT", "LONG")))
    waiting = joins.not_yet_predicted(queued, predictions).drop("CUST_QTY", "LAT", "LONG")
    fresh = numbered(open_outages.drop("OUTAGE_ID").join(waiting, ROW), "all outages are predicted already")
    batch = aggregate.daily_counters(aggregate.unpacked(fresh))
    running = batch if counters is None else aggregate.merge_counters(counters, batch)
    # One row per day.
    counted = fresh.withColumn("Date", F.to_date("CREATION_DATETIME")).join(F.broadcast(running), "Date", "left").drop("Date")
    worded = flags.flags_to_text(counted, [name for name in C.TEXT_FLAGS if name in counted.columns])
    # Flags, sums and the city are never missing.
    whole = {ROW, *aggregate.MASKS, *C.GRAIN, "OUTAGE_ID", "INSERTION_TIME", "CREATION_DATETIME", "CALL_QTY", "CUST_QTY", *(name for mask in aggregate.MASKS.values() for name in mask)}
    gaps = [c for c in worded.columns if c not in whole]
    filled = with_gap_values(worded, gap_values(worded, gaps, ["CREATION_DATETIME", *C.GRAIN]))
    filled = filled.withColumn("CITY_NAM", F.coalesce("CITY_NAM", F.lit(C.NO_CITY)))
    recent = predictions.select("OUTAGE_ID", times.parse_timestamp(F.col("Creation_Time"), "yyyy/MM/dd HH:mm:ss").alias("CREATION_DATETIME"))
    if today is not None:
        recent = recent.where(F.col("CREATION_DATETIME") >= F.date_sub(F.lit(today).cast("date"), 2).cast("timestamp"))
    counts = trailing_counts(fresh, known_outages(fresh, recent), store=True).drop("CREATION_DATETIME")
    complete = clean.default_columns(filled)
    # The second pass, by id, reaches gaps at the beginning of the first one's order.
    complete = with_gap_values(complete, gap_values(complete, gaps, ["OUTAGE_ID"]))
    complete = complete.join(fresh.select(ROW, "OUTAGE_ID").join(counts, "OUTAGE_ID", "left").drop("OUTAGE_ID"), ROW).drop(ROW)
    return flags.flags_to_text(aggregate.unpacked(complete), [name for name in C.TEXT_FLAGS if name not in complete.columns]), running


def updated_history(history: DataFrame, batch: DataFrame) -> DataFrame:
    """Curated history with this batch's version of each outage."""
    tagged = clean.underscore_names(history).withColumn("_v", F.lit(0)).unionByName(
        clean.underscore_names(batch).withColumn("_v", F.lit(1)), allowMissingColumns=True
    )
    return keep_newest(tagged, C.GRAIN, ["_v"]).drop("_v")


def restoration_output(scored: DataFrame, profiles: DataFrame, prediction: str = "Predicted_TTR") -> DataFrame:
    """Published columns from a predicted duration in minutes (before the working allowance)."""
    allowed = scored.withColumn(prediction, times.business_minutes(F.col(prediction)))
    labelled = joins.with_profile(allowed, profiles)
    created = F.col("CREATION_DATETIME")
    # Outages of a live run carry the moment they came in.
    inserted = [c for c in ("INSERTION_TIME",) if c in scored.columns]
    return labelled.select(
        "OUTAGE_ID", "INCIDENT_ID", "STRCTUR_NO", "CIRCT_ID", "DNI_EQUIP_TYPE",
        times.slash_stamp(created).alias("Creation_Time"),
        times.slash_stamp(times.restoration_time(created, F.col(prediction))).alias("Estimated_Restoration_Time"),
        F.bround(prediction, 0).alias("ETR"),
        F.col("Cluster_ID").alias("Weather_Profile"), *inserted,
    )


def stamped(output: DataFrame, run_ts: Column) -> DataFrame:
    return output.withColumn("Last_Updated", F.date_format(run_ts, "yyyy-MM-dd HH:mm"))


def publish_predictions(curated: DataFrame, model: Regression, profiles: DataFrame, run_ts: Column, root: str, token: str) -> None:
    """Curated outages to published restoration times: scored, stamped, appended to the history and put in place of the live table at once.

    An outage that lacks an input of the model is published without a time. Steps
    stored on the way are removed when both tables are written.
    """
    with stored_steps(curated.sparkSession):
        scored = model.predict(flags.model_indicators(curated), "Predicted_TTR")
        sinks.publish(stamped(restoration_output(scored, profiles), run_ts), root, token)

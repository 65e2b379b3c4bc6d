"""Events in the trailing 1..n hours before each outage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stormgrid import constants as C
from stormgrid.functions import times
from stormgrid.operators.latest import pick_one, union_all
from stormgrid.operators.ordered import attach_by_value
from stormgrid.session import materialize

DAY = 86_400


def known_outages(live: DataFrame, history: DataFrame, key: str = "OUTAGE_ID", ts: str = "CREATION_DATETIME") -> DataFrame:
    """Live and already predicted outages, one row per id; the historical time wins."""
    tagged = union_all(
        live.select(key, ts, F.lit(0).alias("_v")), history.select(key, ts, F.lit(1).alias("_v"))
    )
    return pick_one(tagged, [key], [F.col("_v").desc(), F.col(ts).desc_nulls_last()]).drop("_v")


def trailing_counts(
    probes: DataFrame,
    events: DataFrame,
    key: str = "OUTAGE_ID",
    ts: str = "CREATION_DATETIME",
    hours: int = C.TRAILING_HOURS,
    store: bool = False,
) -> DataFrame:
    """`Outages_in_last_{k}hr` per probe: events at most k hours and at least a second earlier.

    Times are reduced to one row per second before any window runs, so a day holds at
    most 86 400 seconds, their questions, and the hours carried over from the day
    before, however many outages a storm brings. The counts go back to the probes by
    second.
    """
    second = times.epoch(F.col(ts)).alias("_sec")
    first_seen = probes.groupBy(key).agg(F.min(ts).alias(ts)).select(key, ts, second)
    probe_seconds = first_seen.where("_sec IS NOT NULL").groupBy("_sec").agg(F.count("*").alias("_probes"), F.lit(0).cast("bigint").alias("_events"))
    event_seconds = (
        events.select(second).where("_sec IS NOT NULL").groupBy("_sec").agg(F.lit(0).cast("bigint").alias("_probes"), F.count("*").alias("_events"))
    )
    seconds = probe_seconds.unionByName(event_seconds).groupBy("_sec").agg(F.sum("_probes").alias("_n"), F.sum("_events").alias("_events"))

    def day(sec):
        return F.floor(sec / DAY)

    span = hours * 3600
    # Running totals answer every question: events in (t - k h, t) = total(t - 1) - total(t - k h - 1).
    # Sliding frames would add up each of their rows again for every second.
    totals = seconds.where("_events > 0").select(
        F.explode(F.sequence(day(F.col("_sec")), day(F.col("_sec") + span))).alias("_day"), F.col("_sec").alias("_at"), "_events"
    )
    moments = [F.struct(F.lit(k).alias("k"), (F.col("_sec") - (3600 * k + 1)).alias("at")) for k in range(hours + 1)]
    asked = seconds.where("_n > 0").select(day(F.col("_sec")).alias("_day"), "_sec", "_n", F.explode(F.array(*moments)).alias("_q"))
    points = asked.select("_day", F.col("_q.at").alias("_at"), "_sec", "_n", F.col("_q.k").alias("_k"))
    running = totals.unionByName(points, allowMissingColumns=True).withColumn(
        "_total", F.coalesce(F.sum("_events").over(Window.partitionBy("_day").orderBy("_at")), F.lit(0))
    )
    # Still partitioned by day, so this grouping needs no further shuffle.
    gathered = running.where("_sec IS NOT NULL").groupBy("_day", "_sec").agg(
        F.max("_n").alias("_n"), *[F.max(F.when(F.col("_k") == k, F.col("_total"))).alias(f"_t{k}") for k in range(hours + 1)]
    )
    counts = [(F.col("_t0") - F.col(f"_t{k}")).alias(f"Outages_in_last_{k}hr") for k in range(1, hours + 1)]
    answers = gathered.select("_sec", "_n", *counts)
    return attach_by_value(first_seen, materialize(answers, codec="zstd") if store else answers, "_sec").drop("_sec")

"""Calendar, duration and horizon expressions. 'Now' is always a parameter."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from stormgrid import constants as C
from stormgrid.functions.choose import first_match
from stormgrid.functions.flags import as_bit

STAMP = "yyyy-MM-dd HH:mm:ss"


def epoch(ts: Column) -> Column:
    """Whole seconds since 1970 (fractions dropped)."""
    return F.unix_timestamp(ts.cast("timestamp"))


def from_epoch(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def parse_timestamp(text: Column, pattern: str | None = None) -> Column:
    """Null instead of an error for text that is no time."""
    return F.try_to_timestamp(text, F.lit(pattern)) if pattern else F.try_to_timestamp(text)


def parse_number(text: Column) -> Column:
    return text.try_cast("double")


def day_flag(ts: Column) -> Column:
    hour = F.hour(ts)
    return as_bit((hour >= 6) & (hour < 18))


def hour_sin(ts: Column) -> Column:
    return F.sin(F.hour(ts) * F.lit(2.0 * math.pi / 24))


def hour_cos(ts: Column) -> Column:
    return F.cos(F.hour(ts) * F.lit(2.0 * math.pi / 24))


def weekend_flag(ts: Column) -> Column:
    return as_bit(F.weekday(ts) >= 5)


def minutes_between(start: Column, end: Column) -> Column:
    """Duration in minutes, rounded to 4 places."""
    return F.bround((epoch(end) - epoch(start)) / F.lit(60.0), 4)


def restoration_minutes(start: Column, end: Column) -> Column:
    return F.bround(minutes_between(start, end), 0)


def promised_hours(start: Column, promised: Column) -> Column:
    return F.bround(minutes_between(start, promised) / F.lit(60.0), 0)


def business_minutes(ttr: Column) -> Column:
    """Working allowance on a predicted duration: short and long outages differ."""
    return F.when(ttr <= C.LONG_OUTAGE_MINUTES, ttr + C.SHORT_OUTAGE_ADDITION).when(
        ttr > C.LONG_OUTAGE_MINUTES, ttr + C.LONG_OUTAGE_ADDITION
    )


def restoration_time(start: Column, ttr: Column) -> Column:
    """Start plus minutes, cut to the second, rounded half-even to 10 minutes."""
    micros = F.bround(ttr * F.lit(60_000_000.0), 0).cast("bigint")
    seconds = F.floor((epoch(start) * F.lit(1_000_000).cast("bigint") + micros) / F.lit(1_000_000)).cast("bigint")
    return from_epoch((F.bround(seconds / F.lit(600.0), 0) * 600).cast("bigint"))


def slash_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy/MM/dd HH:mm:ss")


def insertion_stamp(run_ts: Column) -> Column:
    return F.date_format(run_ts, "yyyyMMddHHmm").cast("bigint")


def eastern(ts: Column, zone: str = C.EASTERN) -> Column:
    return F.from_utc_timestamp(ts, zone)


def days_ahead(day: Column, today: Column) -> Column:
    return F.datediff(day, today)


def horizon_label(day: Column, today: Column) -> Column:
    ahead = days_ahead(day, today)
    named = first_match((ahead == number, text) for number, text in C.HORIZON_LABELS.items())
    return named.otherwise(ahead.cast("string"))


def day_label(day: Column, today: Column) -> Column:
    """Name of a day within two days of today, null for any other."""
    ahead = days_ahead(day, today)
    return first_match((ahead == number, text) for number, text in C.DAY_LABELS.items())


def relative_days(today: Column) -> dict[str, Column]:
    """The neighbouring days and their texts that file names and queries use."""
    tomorrow, day_after = F.date_add(today, 1), F.date_add(today, 2)
    yesterday, day_before = F.date_sub(today, 1), F.date_sub(today, 2)
    return {
        "tomorrow": tomorrow,
        "day_after": day_after,
        "yesterday": yesterday,
        "day_before": day_before,
        "year_month": F.date_format(today, "yyyy-MM"),
        "year_month_1": F.date_format(tomorrow, "yyyy-MM"),
        "year_month_2": F.date_format(day_after, "yyyy-MM"),
        "compact_day": F.date_format(today, "yyyyMMdd"),
        "dashed_day": F.date_format(today, "yyyy-MM-dd"),
        "weekday_name": F.date_format(today, "EEEE"),
    }

"""Writes: append, replace, single file, dated backup, one folder per day label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormgrid.functions import times
from stormgrid.session import materialize
from stormgrid.sources import snapshots


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace(df: DataFrame, path: str) -> None:
    """Overwrites; the input must not read from the same path."""
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header. One file only on request and for small results: it is one task."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)


def backup(df: DataFrame, path: str, moment: str) -> None:
    """Appends under `ym=…/d=…/stamp=…` folders of the local (eastern) run time."""
    local = times.eastern(F.col(moment))
    stamped = df.withColumns(
        {
            "ym": F.date_format(local, "yyyy-MM"),
            "d": F.date_format(local, "yyyy-MM-dd"),
            "stamp": F.date_format(local, "yyyyMMddHHmm"),
        }
    )
    stamped.write.mode("append").partitionBy("ym", "d", "stamp").parquet(path)


def day_slices(df: DataFrame, today) -> DataFrame:
    """Rows within two days of today, labelled with the name of their day."""
    return df.withColumn("day_label", times.day_label(F.to_date("timestamp"), today)).where(F.col("day_label").isNotNull())


def write_day_slices(df: DataFrame, path: str, today) -> None:
    day_slices(df, today).write.mode("overwrite").partitionBy("day_label").parquet(path)


#: Tables of a published result.
HISTORY, LIVE = "history", "live"


def publish(df: DataFrame, root: str, token: str) -> None:
    """One result into two tables below `root`: appended to the history, put in place of the live one, both or neither.

    The result is stored first, so its plan runs once and both tables get the same rows.
    A run that repeats with the same token changes nothing.
    """
    with snapshots.Transaction(df.sparkSession, root, token) as run:
        if not run.done:
            stored = materialize(df, "nothing to publish", "zstd")
            run.append(HISTORY, stored)
            run.replace(LIVE, stored)

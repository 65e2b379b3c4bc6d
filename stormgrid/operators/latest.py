"""One row per key: newest, oldest, upsert, running history.

`row_number() = 1` plans as a group limit on both sides of the shuffle, so each
map task sends at most one row per key: a key with a third of all rows is cheap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def keep_newest(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    return pick_one(df, keys, [F.col(c).desc_nulls_last() for c in by])


def keep_oldest(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    return pick_one(df, keys, [F.col(c).asc_nulls_last() for c in by])


def latest_forecasts(df: DataFrame, keys: tuple[str, ...] = ("timestamp", "Location")) -> DataFrame:
    """Each forecast from its newest load."""
    return keep_newest(df, list(keys), ["Job_Update_Time"])


def union_all(*frames: DataFrame) -> DataFrame:
    """Appends by column name; a column some inputs lack is null there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def upsert(history: DataFrame, batch: DataFrame, keys: list[str], tie_break: list[str] | None = None) -> DataFrame:
    """History with the batch's rows added or put in place of those of the same key."""
    tagged = union_all(history.withColumn("_v", F.lit(0)), batch.withColumn("_v", F.lit(1)))
    return keep_newest(tagged, keys, ["_v", *(tie_break or [])]).drop("_v")


def rows_of_latest_load(df: DataFrame, window: Column, load: str = "Job_Update_Time") -> DataFrame:
    """Rows inside the window that belong to its most recent load.

    The latest load is a one-row aggregate joined back, not a driver action.
    """
    inside = df.where(window)
    newest = inside.agg(F.max(load).alias("_newest"))
    return inside.join(F.broadcast(newest), F.col(load) == F.col("_newest")).drop("_newest")


def top_one(df: DataFrame, order: list[Column]) -> DataFrame:
    return df.orderBy(*order).limit(1)

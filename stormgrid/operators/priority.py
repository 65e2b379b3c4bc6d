"""Queue positions of the live outages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormgrid.functions import geo
from stormgrid.operators.ordered import dense_rank_of, max_rank_of
from stormgrid.session import materialize


def by_customers(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """1 for the outage with most customers."""
    return dense_rank_of(df, "CUST_QTY", "Priority_Customer_Qty", descending=True, partitions=partitions)


def with_center_distance(df: DataFrame, method: str = "geodesic", center: str = "scaled") -> DataFrame:
    """Distance to the live centre.

    `scaled` divides each outage's own coordinates by the number of live outages (the
    published formula); `mean` takes the mean of all coordinates instead.
    """
    if center == "mean":
        middle = df.agg(F.avg("LAT").alias("_c_lat"), F.avg("LONG").alias("_c_lon"))
    else:
        middle = df.agg(F.count_distinct("OUTAGE_ID").alias("_live"))
    placed = df.crossJoin(F.broadcast(middle))  # one row
    if center != "mean":
        placed = placed.withColumns({"_c_lat": F.col("LAT") / F.col("_live"), "_c_lon": F.col("LONG") / F.col("_live")})
    distance = {"geodesic": geo.geodesic_miles, "haversine": geo.haversine_km}[method]
    columns = [F.col(c) for c in ("LAT", "LONG", "_c_lat", "_c_lon")]
    return placed.withColumn("Center_Distance", distance(*columns)).drop("_c_lat", "_c_lon", "_live")


def by_distance(df: DataFrame, method: str = "geodesic", center: str = "scaled", partitions: int | None = None) -> DataFrame:
    """Ascending position of (distance to the centre / customers); ties share the highest.

    Outages are ranked and matched by the same stored value, so the distance runs once.
    Within about half a degree of the antipode of the centre the distance is null, and
    the outage has no rank.
    """
    weighted = materialize(with_center_distance(df, method, center).withColumn(
        "Dist_per_Customer", F.try_divide("Center_Distance", "CUST_QTY")
    ))
    return max_rank_of(weighted, "Dist_per_Customer", "Priority_Dist_Customer_Qty", partitions).drop("Center_Distance")

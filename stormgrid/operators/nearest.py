"""Nearest point of a table of any length, by cells of a grid.

Points and probes fall into cells of a grid in degrees. A probe is compared with
the points of its own and the eight cells around: an equality join on the cell.
Every point outside that block is at least a known distance away, so a probe whose
best point is no farther is done. The cells are cut so narrow that none holds more
than `CROWD` points (down to `LEAST` degrees), so the comparisons of a probe do not
grow with the table of points. Probes and points at one place count once.

The other probes descend from cells `GROWTH` times as wide at each level. Every cell
names one of its points; the nearest of those named bounds the distance, and cells
that are wholly farther are left out before their own cells are looked at. A probe
far from all points meets the cells of the points' near edge, not all points.

Points travel as lists, one for each block or first cell, and a comparison is a
step inside a row: pairs of places are no rows, and are neither sorted nor stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgrid.functions import geo
from stormgrid.operators.ordered import attach_by_value
from stormgrid.session import materialize

GROWTH = 4
WHOLE = 180.0
#: Points of a first cell, at most, unless it is `LEAST` degrees wide.
CROWD = 32
LEAST = 1e-5


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine of the central angle, which grows with the distance."""
    half_lat, half_lon = F.sin(F.radians(lat2 - lat1) / 2), F.sin(F.radians(lon2 - lon1) / 2)
    return half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon


def _cells(lat: Column, lon: Column, size: float) -> tuple[Column, Column, int]:
    """Row and column of a cell, and how many columns go round the globe; all columns are equally wide, `size` at least."""
    columns = max(1, int(360 // size))
    return F.floor((lat + 90) / size), F.pmod(F.floor((lon + 180) * (columns / 360)), F.lit(columns)), columns


def _outside(lat: Column, size: float) -> Column:
    """No point outside the block around a probe has a lesser haversine than this."""
    half = F.sin(F.radians(F.lit(min(size, 180.0))) / 2)
    # Within the block's rows, which reach two cells up and down, a point outside is a cell's width away in longitude.
    narrow = F.cos(F.radians(lat)) * F.cos(F.radians(F.least(F.abs(lat) + 2 * size, F.lit(90.0))))
    return half * half * F.greatest(narrow, F.lit(0.0))


def first_size(targets: DataFrame, size: float) -> float:
    """The width of the first cells: `size`, or less where more than `CROWD` points would share one."""
    while size > LEAST:
        row, column, _ = _cells(F.col("_lat"), F.col("_lon"), size)
        most = targets.groupBy(row.alias("_r"), column.alias("_c")).agg(F.count("*").alias("_n")).agg(F.max("_n")).first()[0] or 0
        if most <= CROWD:
            break
        size = max(size * (CROWD / 4 / most) ** 0.5, LEAST)
    return size


def _around(lat: Column, lon: Column, size: float) -> tuple[Column, Column]:
    """Rows and columns of the block around a place, to be exploded."""
    row, column, columns = _cells(lat, lon, size)
    # Near the end of the round the same column would be met twice.
    return F.explode(F.sequence(row - 1, row + 1)), F.explode(F.array_distinct(F.transform(F.sequence(column - 1, column + 1), lambda c: F.pmod(c, F.lit(columns)))))


def _farther(lat: Column, lon: Column, row: Column, column: Column, size: float) -> Column:
    """No point of a cell (rows and columns counted from -90 and -180) has a lesser haversine than this."""
    south, west = row * size - 90, column * size - 180
    up = F.greatest(south - lat, lat - (south + size), F.lit(0.0))
    # The gap beside the cell, the shorter way round.
    beside = F.least(F.pmod(west - lon, F.lit(360.0)), F.pmod(lon - (west + size), F.lit(360.0)))
    inside = F.pmod(lon - west, F.lit(360.0)) <= size
    narrow = F.cos(F.radians(lat)) * F.cos(F.radians(F.least(F.greatest(F.abs(south), F.abs(south + size)), F.lit(90.0))))
    a, b = F.sin(F.radians(up) / 2), F.when(inside | F.lit(size >= WHOLE), 0.0).otherwise(F.sin(F.radians(beside) / 2))
    # Less than the bound by more than the sums can be wrong.
    return (a * a + F.greatest(narrow, F.lit(0.0)) * b * b) * (1 - 1e-9) - 1e-15


def _descended(left: DataFrame, targets: DataFrame, size: float, lists: Column, nearest_of: Column) -> DataFrame:
    """The best point of every place, from the widest cells down to the lists of those `size` wide."""
    levels = 0
    while size * GROWTH**levels < WHOLE:
        levels += 1
    a, o = F.col("_place.a"), F.col("_place.o")
    own = {"_row": F.floor((F.col("_lat") + 90) / size), "_column": F.floor((F.col("_lon") + 180) / size)}
    first = materialize(targets.groupBy(*[c.alias(n) for n, c in own.items()]).agg(lists))
    # The widest cells are two rows of three columns at most.
    asked = left.withColumn("_row", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(1).cast("bigint")))).withColumn("_column", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(2).cast("bigint"))))
    for level in range(levels, -1, -1):
        wide, above = size * GROWTH**level, [F.floor(F.col(n) / GROWTH) for n in own]
        up = [F.floor(F.col(n) / GROWTH**level).alias(n) for n in own]
        cells = first.groupBy(*up).agg(F.first("_list")[0].alias("_named")).withColumns({"_r": above[0], "_c": above[1]})
        met = asked.join(cells, ["_row", "_column"] if level == levels else ["_r", "_c"])
        met = met.select("_place", "_row", "_column", haversine(a, o, F.col("_named._lat"), F.col("_named._lon")).alias("_named"), _farther(a, o, F.col("_row"), F.col("_column"), wide).alias("_from"))
        met = materialize(met)
        bound = met.groupBy("_place").agg(F.min("_named").alias("_bound"))
        near = met.join(bound, "_place").where(F.col("_from") <= F.col("_bound"))
        asked = near.select("_place", F.col("_row").alias("_r"), F.col("_column").alias("_c"))
    found = asked.join(first.withColumnsRenamed({"_row": "_r", "_column": "_c"}), ["_r", "_c"]).select("_place", nearest_of.alias("_b"))
    return left.join(found.groupBy("_place").agg(F.min("_b").alias("_best")), "_place", "left")


def with_nearest(df: DataFrame, points: DataFrame, lat: str = "LAT", lon: str = "LONG", point: tuple[str, str, str] = ("id", "lat", "lon"), size: float = 0.1) -> DataFrame:
    """All rows with `Nearest` (id of the nearest point, the least of equally near ones) and `Nearest_Km`.

    The first cells are `size` degrees wide, or narrower where points are dense. Rows
    without coordinates, or a table of points without any, give nulls.
    """
    name, p_lat, p_lon = point
    targets = points.where(F.col(p_lat).isNotNull() & F.col(p_lon).isNotNull()).groupBy(F.col(p_lat).alias("_lat"), F.col(p_lon).alias("_lon"))
    targets = materialize(targets.agg(F.min(F.struct(F.col(name).alias("id"))).alias("_point")))
    here = F.when(F.col(lat).isNotNull() & F.col(lon).isNotNull(), F.struct(F.col(lat).alias("a"), F.col(lon).alias("o")))
    keyed = df.withColumn("_place", here)
    places = materialize(keyed.where(F.col("_place").isNotNull()).groupBy("_place").agg(F.count("*").alias("_n")))
    size = first_size(targets, size)
    lists = F.collect_list(F.struct("_lat", "_lon", "_point.id")).alias("_list")
    a, o = F.col("_place.a"), F.col("_place.o")
    nearest_of = F.array_min(F.transform("_list", lambda p: F.struct(haversine(a, o, p["_lat"], p["_lon"]).alias("a"), p["id"].alias("id"))))
    rows, columns = _around(F.col("_lat"), F.col("_lon"), size)
    blocks = targets.withColumn("_r", rows).withColumn("_c", columns).groupBy("_r", "_c").agg(lists)
    row, column, _ = _cells(a, o, size)
    asked = places.withColumn("_r", row).withColumn("_c", column)
    met = materialize(asked.join(blocks, ["_r", "_c"], "left").select("_place", "_n", nearest_of.alias("_best")))
    done = F.coalesce(F.col("_best.a") <= _outside(a, size), F.lit(False))
    left = materialize(met.where(~done).select("_place", "_n"))
    nearest = met.where(done).unionByName(materialize(_descended(left, targets, size, lists, nearest_of)))
    lookup = nearest.select("_place", "_n", F.col("_best.id").alias("Nearest"), geo.haversine_of(F.col("_best.a")).alias("Nearest_Km"))
    return attach_by_value(keyed, lookup, "_place").drop("_place")

"""Coordinates and distances as built-in column expressions (and one Arrow kernel)."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormgrid import constants as C

# --- fixed values: state-plane projection -------------------------------------------
FOOT_M = 0.3048
FALSE_NORTHING, FALSE_EASTING = 250000.0, 100000.0
ORIGIN_ARC, RECTIFYING_RADIUS = 4151863.7425, 6367236.89768
FOOT_SERIES = [0.005022893948, 0.000029370625, 0.000000235059, 0.000000002181]
SECOND_ECC2, FIRST_ECC2 = 0.00673949677548, 0.0066943800229034
SCALE_FACTOR, SEMI_MAJOR = 0.9999666667, 6378137.0
CENTRAL_MERIDIAN, DEG_PER_RAD = 1.4951653925, 57.2957795131


def _horner(x: Column, coefficients: list) -> Column:
    """c0 + c1*x + c2*x^2 + ..."""
    total = F.lit(coefficients[-1]) if not isinstance(coefficients[-1], Column) else coefficients[-1]
    for value in reversed(coefficients[:-1]):
        total = value + x * total
    return total


def with_state_plane_degrees(df: DataFrame, x: str, y: str, lat: str = "LAT", lon: str = "LONG") -> DataFrame:
    """Adds degrees for transverse-Mercator feet (the inverse series, to the 7th power).

    The shared terms are named columns of chained projections, so that each is
    evaluated once per row.
    """
    staged = df.withColumn("_om", (F.col(y) * FOOT_M - FALSE_NORTHING + ORIGIN_ARC) / RECTIFYING_RADIUS)
    om = F.col("_om")
    cos2 = F.cos(om) * F.cos(om)
    staged = staged.withColumn("_phi", om + F.sin(om) * F.cos(om) * _horner(cos2, FOOT_SERIES))
    phi = F.col("_phi")
    sin2 = F.sin(phi) * F.sin(phi)
    staged = staged.withColumns(
        {
            "_t2": F.tan(phi) * F.tan(phi),
            "_n2": SECOND_ECC2 * F.cos(phi) * F.cos(phi),
            "_q": (F.col(x) * FOOT_M - FALSE_EASTING) * F.sqrt(1 - FIRST_ECC2 * sin2) / (SCALE_FACTOR * SEMI_MAJOR),
        }
    )
    t2, n2, q = F.col("_t2"), F.col("_n2"), F.col("_q")
    q2 = q * q
    lat2 = -F.tan(phi) * (1 + n2) / 2
    lat4 = -(5 + 3 * t2 + n2 * (1 - 9 * t2) - 4 * n2 * n2) / 12
    lat6 = (61 + 90 * t2 + 45 * t2 * t2 + n2 * (46 - 252 * t2 - 90 * t2 * t2)) / 360
    lon3 = -(1 + 2 * t2 + n2) / 6
    lon5 = (5 + 28 * t2 + 24 * t2 * t2 + n2 * (6 + 8 * t2)) / 120
    lon7 = -(61 + 662 * t2 + 1320 * t2 * t2 + 720 * t2 * t2 * t2) / 5040
    north = phi + lat2 * q2 * _horner(q2, [F.lit(1.0), lat4, lat6])
    east = q * _horner(q2, [F.lit(1.0), lon3, lon5, lon7])
    return staged.withColumns(
        {lat: north * DEG_PER_RAD, lon: -(CENTRAL_MERIDIAN - east / F.cos(phi)) * DEG_PER_RAD}
    ).drop("_om", "_phi", "_t2", "_n2", "_q")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle kilometres; null when any coordinate is."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    half_lat, half_lon = F.sin((p2 - p1) / 2), F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    return haversine_of(half_lat * half_lat + F.cos(p1) * F.cos(p2) * half_lon * half_lon)


def haversine_of(a: Column) -> Column:
    """Kilometres from the haversine of the central angle."""
    return 2 * C.EARTH_RADIUS_KM * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def zone(lat: Column, lon: Column) -> Column:
    """Quadrant around the city centre; an unknown coordinate counts as north or east."""
    south = F.coalesce(lat < C.CITY_CENTER[0], F.lit(False))
    west = F.coalesce(lon < C.CITY_CENTER[1], F.lit(False))
    return (
        F.when(south & west, "ZONE1").when(south, "ZONE2").when(west, "ZONE4").otherwise("ZONE3")
    )


def nearest_point(lat: str, lon: str, points: list[tuple[float, float]]) -> Column:
    """Struct (haversine of the angle, 1-based index) of the nearest of a fixed, short list of points.

    The list is a literal of the plan, so no row moves. Angles are compared by their
    haversine, which grows with the distance; a tie goes to the lowest index.
    """
    def candidate(i: int, p_lat: float, p_lon: float) -> str:
        half_lat = f"sin((radians({p_lat}D) - radians({lat})) / 2)"
        half_lon = f"sin((radians({p_lon}D) - radians({lon})) / 2)"
        a = f"{half_lat} * {half_lat} + cos(radians({lat})) * cos(radians({p_lat}D)) * {half_lon} * {half_lon}"
        return f"named_struct('a', {a}, 'index', {i})"

    return F.expr(f"least({', '.join(candidate(i, *p) for i, p in enumerate(points, start=1))})")


# ------------------------------------------------------------------ ellipsoidal miles
# The Arrow functions travel to the workers by value, so these need no installed package there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
WGS84_A, WGS84_F, METERS_PER_MILE = C.WGS84_A, C.WGS84_F, C.METERS_PER_MILE


def _vincenty_step(lam, L, u1, u2):
    """One fixed-point step of the inverse problem; returns the new lambda and the sphere terms."""
    f = WGS84_F
    s1, c1, s2, c2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    sin_s = np.hypot(c2 * np.sin(lam), c1 * s2 - s1 * c2 * np.cos(lam))
    cos_s = s1 * s2 + c1 * c2 * np.cos(lam)
    sigma = np.arctan2(sin_s, cos_s)
    sin_a = np.where(sin_s == 0, 0.0, c1 * c2 * np.sin(lam) / np.where(sin_s == 0, 1.0, sin_s))
    cos2_a = 1 - sin_a**2
    cos_2m = np.where(cos2_a == 0, 0.0, cos_s - 2 * s1 * s2 / np.where(cos2_a == 0, 1.0, cos2_a))
    k = f / 16 * cos2_a * (4 + f * (4 - 3 * cos2_a))
    series = sigma + k * sin_s * (cos_2m + k * cos_s * (2 * cos_2m**2 - 1))
    return L + (1 - k) * f * sin_a * series, (sigma, sin_s, cos_s, cos2_a, cos_2m)


def geodesic_miles_array(lat1, lon1, lat2, lon2, steps: int = 200) -> np.ndarray:
    """Miles on the WGS-84 ellipsoid for whole arrays of points.

    Null inputs give NaN. Pairs within about half a degree of exact antipodes,
    where the iteration has no fixed point, also give NaN.
    """
    lat1, lon1, lat2, lon2 = np.broadcast_arrays(*(np.asarray(v, dtype="float64") for v in (lat1, lon1, lat2, lon2)))
    f, a = WGS84_F, WGS84_A
    b = a * (1 - f)
    with np.errstate(invalid="ignore", divide="ignore"):
        u1, u2 = np.arctan((1 - f) * np.tan(np.radians(lat1))), np.arctan((1 - f) * np.tan(np.radians(lat2)))
        L = (np.radians(lon2 - lon1) + np.pi) % (2 * np.pi) - np.pi
        lam, settled = L.copy(), np.zeros(L.shape, dtype=bool)
        for _ in range(steps):
            new, _terms = _vincenty_step(lam, L, u1, u2)
            done = np.abs(new - lam) < 1e-12
            # A settled lane stands still, so a value never depends on the rest of its batch.
            lam = np.where(settled, lam, new)
            settled = settled | done
            if (settled | np.isnan(lam)).all():
                break
        _, (sigma, sin_s, cos_s, cos2_a, cos_2m) = _vincenty_step(lam, L, u1, u2)
        w = cos2_a * (a * a - b * b) / (b * b)
        big_a = 1 + w / 16384 * (4096 + w * (-768 + w * (320 - 175 * w)))
        big_b = w / 1024 * (256 + w * (-128 + w * (74 - 47 * w)))
        inner = cos_s * (2 * cos_2m**2 - 1) - big_b / 6 * cos_2m * (4 * sin_s**2 - 3) * (4 * cos_2m**2 - 3)
        shift = big_b * sin_s * (cos_2m + big_b / 4 * inner)
        miles = b * big_a * (sigma - shift) / METERS_PER_MILE
        return np.where(settled & (np.abs(lam) <= np.pi), miles, np.nan)


@F.pandas_udf(T.DoubleType())
def geodesic_miles(lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series) -> pd.Series:
    miles = geodesic_miles_array(lat1, lon1, lat2, lon2)
    return pd.Series(miles).astype("Float64").mask(np.isnan(miles), pd.NA)


def nearest_point_miles(points: list[tuple[float, float]]):
    """Arrow function (lat, long) -> struct (miles, 1-based index) over a fixed list of points."""

    @F.pandas_udf("miles double, index int")
    def nearest(lat: pd.Series, lon: pd.Series) -> pd.DataFrame:
        table = np.stack([geodesic_miles_array(lat, lon, p_lat, p_lon) for p_lat, p_lon in points])
        unknown = np.isnan(table).all(axis=0)
        index = np.argmin(np.where(np.isnan(table), np.inf, table), axis=0)
        miles = table[index, np.arange(table.shape[1])]
        return pd.DataFrame(
            {
                "miles": pd.Series(miles).astype("Float64").mask(unknown, pd.NA),
                "index": pd.Series(index + 1, dtype="Int32").mask(unknown, pd.NA),
            }
        )

    return nearest

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stormgrid import constants as C
from stormgrid.functions import geo
from stormgrid.operators import joins


@pytest.mark.parametrize(
    ("pair", "meters"),
    [
        # Published survey pair (Flinders Peak - Buninyong), WGS-84 ellipsoid figures.
        ((-37.951033417, 144.424867889, -37.652821139, 143.926495528), 54972.271),
        # One degree of latitude from the equator, and of longitude along it.
        ((0.0, 0.0, 1.0, 0.0), 110574.389),
        ((0.0, 0.0, 0.0, 1.0), 111319.491),
        ((40.0, -86.0, 40.0, -86.0), 0.0),
        # Quarter meridian.
        ((0.0, 0.0, 90.0, 0.0), 10001965.729),
    ],
)
def test_ellipsoidal_distance(pair, meters):
    assert geo.geodesic_miles_array(*pair) * C.METERS_PER_MILE == pytest.approx(meters, abs=0.02)


def test_ellipsoidal_distance_unknown_and_antipodal():
    got = geo.geodesic_miles_array([np.nan, 0.0, 10.0], [0.0, 0.0, 170.0], [0.0, 0.0, 10.0], [0.0, 179.9, -170.0])
    assert np.isnan(got[0]) and np.isnan(got[1]) and got[2] == pytest.approx(geo.geodesic_miles_array(10.0, 0.0, 10.0, 20.0))


def test_distances_on_rows(spark):
    df = spark.createDataFrame([(39.77, -86.16), (None, -86.0)], "LAT double, LONG double")
    one, two = F.lit(39.9), F.lit(-86.3)
    row = df.select(
        geo.haversine_km(F.col("LAT"), F.col("LONG"), one, two).alias("a"), geo.haversine_km(one, two, F.col("LAT"), F.col("LONG")).alias("b"),
        geo.geodesic_miles("LAT", "LONG", one, two).alias("m"),
    ).collect()
    assert row[0].a == pytest.approx(row[0].b) and row[0].m * 1.609344 == pytest.approx(row[0].a, rel=0.005)
    assert (row[1].a, row[1].m) == (None, None)


def test_zone_counts_unknown_as_north_east(spark):
    points = [(39.0, -87.0), (39.0, -85.0), (40.0, -85.0), (40.0, -87.0), (None, -87.0), (39.0, None), (None, None)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i int, la double, lo double").orderBy("i")
    assert [r[0] for r in df.select(geo.zone(F.col("la"), F.col("lo"))).collect()] == ["ZONE1", "ZONE2", "ZONE3", "ZONE4", "ZONE4", "ZONE2", "ZONE3"]


def _plane_reference(x, y):
    """The published series, one number at a time."""
    om = (y * 0.3048 - 250000 + 4151863.7425) / 6367236.89768
    c = math.cos(om) ** 2
    fo = om + math.sin(om) * math.cos(om) * (0.005022893948 + 0.000029370625 * c + 0.000000235059 * c**2 + 0.000000002181 * c**3)
    t, n = math.tan(fo), 0.00673949677548 * math.cos(fo) ** 2
    q = (x * 0.3048 - 100000) * math.sqrt(1 - 0.0066943800229034 * math.sin(fo) ** 2) / (0.9999666667 * 6378137)
    b4 = -(5 + 3 * t**2 + n * (1 - 9 * t**2) - 4 * n**2) / 12
    b6 = (61 + 90 * t**2 + 45 * t**4 + n * (46 - 252 * t**2 - 90 * t**4)) / 360
    lat = fo - 0.5 * t * (1 + n) * q**2 * (1 + q**2 * (b4 + b6 * q**2))
    b3, b5 = -(1 + 2 * t**2 + n) / 6, (5 + 28 * t**2 + 24 * t**4 + n * (6 + 8 * t**2)) / 120
    b7 = -(61 + 662 * t**2 + 1320 * t**4 + 720 * t**6) / 5040
    lon = 1.4951653925 - q * (1 + q**2 * (b3 + q**2 * (b5 + b7 * q**2))) / math.cos(fo)
    return lat * 57.2957795131, -lon * 57.2957795131


def test_state_plane(spark):
    points = [(190000.0, 1647000.0), (150000.0, 1600000.0), (250000.0, 1700000.0), (400000.0, 1500000.0)]
    df = spark.createDataFrame([*points, (None, 1.0)], "x double, y double")
    got = geo.with_state_plane_degrees(df, "x", "y").collect()
    for (x, y), row in zip(points, got):
        lat, lon = _plane_reference(x, y)
        assert row.LAT == pytest.approx(lat, abs=1e-9) and row.LONG == pytest.approx(lon, abs=1e-9)
    assert got[4].LONG is None


def test_nearest_marker_and_depot(spark):
    df = spark.createDataFrame([(1, 39.9613, -86.4034), (2, 39.7, -86.2), (3, None, -86.0)], "id int, LAT double, LONG double")
    got = joins.with_nearest_marker(df).orderBy("id").collect()
    assert (got[0].Marker_Location, got[0].Min_Distance) == ("Marker 1", 0.0)
    assert (got[2].Marker_Location, got[2].Min_Distance) == (None, None)
    depots = joins.with_nearest_depot(df).orderBy("id").collect()
    assert [r.Dispatch_Location for r in depots] == ["34th", "W.I.", "NO_LOCATION"]


def test_equal_distance_takes_the_lower_index(spark):
    df = spark.createDataFrame([(0.0, 0.0)], "LAT double, LONG double")
    got = joins.with_nearest_marker(df, [(5.0, 5.0), (0.0, 1.0), (0.0, -1.0)]).first()
    assert got.Marker_Location == "Marker 2"
    assert joins.with_nearest_depot(df, [("a", 0.0, 1.0), ("b", 0.0, -1.0)]).first().Dispatch_Location == "a"

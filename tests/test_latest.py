import datetime as dt

from pyspark.sql import functions as F

from stormgrid.operators import joins, latest
from stormgrid.plans import restoration


def test_newest_load_wins_and_limits_before_the_shuffle(spark, rows):
    df = spark.createDataFrame([("t", "m", 1, 10), ("t", "m", 3, 30), ("t", "m", None, 0), ("u", "m", 1, 5)], "timestamp string, Location string, Job_Update_Time int, v int")
    got = latest.latest_forecasts(df)
    assert rows(got, "timestamp", "v") == [("t", 30), ("u", 5)]
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_upsert_and_repeat(spark, rows):
    history = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    batch = spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int")
    once = latest.upsert(history, batch, ["k"])
    assert rows(once) == [("a", 1), ("b", 2), ("c", 2)]
    assert rows(latest.upsert(once, batch, ["k"])) == rows(once)


def test_history_of_curated_rows(spark, rows):
    schema = "INCIDENT_ID int, STRCTUR_NO string, CIRCT_ID int, DNI_EQUIP_TYPE string, `X.0` int"
    old = spark.createDataFrame([(1, "s", 1, "t", 0), (2, "s", 1, "t", 0)], schema)
    new = spark.createDataFrame([(2, "s", 1, "t", 9)], schema)
    assert rows(restoration.updated_history(old, new), "INCIDENT_ID", "X_0") == [(1, 0), (2, 9)]


def test_union_by_name_and_latest_load(spark, rows):
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([(2,)], "i int")
    assert rows(latest.union_all(a, b)) == [(1, "x"), (2, None)]
    loads = spark.createDataFrame([(1, 5), (2, 9), (3, 9), (4, 11)], "i int, Job_Update_Time int")
    assert rows(latest.rows_of_latest_load(loads, F.col("i") < 4), "i") == [(2,), (3,)]


def test_full_outer_on_all_common_columns(spark, rows):
    a = spark.createDataFrame([(1, None, "l1"), (2, "x", "l2")], "i int, s string, l string")
    b = spark.createDataFrame([(1, None, "r1"), (3, "x", "r3")], "i int, s string, r string")
    want = sorted([(1, None, "l1", "r1"), (2, "x", "l2", None), (3, "x", None, "r3")], key=repr)
    assert rows(joins.full_outer_on_common(a, b)) == want


def test_anti_join_strips_spaces(spark, rows):
    outages = spark.createDataFrame([("1 A",), ("2B",), (None,)], "OUTAGE_ID string")
    done = spark.createDataFrame([("1A",), ("1A",)], "OUTAGE_ID string")
    assert rows(joins.not_yet_predicted(outages, done)) == sorted([("2B",), (None,)], key=repr)


def test_weather_join_keys(spark):
    outages = spark.createDataFrame([(1, dt.datetime(2024, 1, 6, 3), "Marker 3"), (2, dt.datetime(2024, 1, 6, 3), None), (3, dt.datetime(2024, 1, 7), "Marker 3")],
                                    "id int, CREATION_DATETIME timestamp, Marker_Location string")
    names = ["temp", "windSpd", "sfcPres", "cldCvr", "relHum"]
    values = [v for _ in names for v in (4.0, 2.0)]
    schema = "timestamp timestamp, Location string, windDirAvg double, " + ", ".join(f"{n}Max double, {n}Min double" for n in names)
    weather = spark.createDataFrame([(dt.datetime(2024, 1, 6, 5), "IPL_Marker3", 50.0, *values)], schema)
    got = joins.with_weather(outages, weather, ["windDirAvg", "tempMax"]).orderBy("id").collect()
    assert [(r.tempMax, r.relHumRatio, r.WIND_DIRECTION, r.weekend_flag) for r in got] == [(4.0, 2.0, "N-E-E", 1), (None, None, None, 1), (None, None, None, 1)]
    profiles = spark.createDataFrame([(dt.date(2024, 1, 6), "Marker 3", "Cluster3")], "timestamp date, Location string, clusters string")
    assert [r.Cluster_ID for r in joins.with_profile(outages, profiles).orderBy("id").collect()] == ["Thunderstorms", None, None]

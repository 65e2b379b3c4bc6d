import datetime as dt
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormgrid import constants as C
from stormgrid.operators import joins, nearest, ordered
from stormgrid.plans import preparedness
from stormgrid.session import EmptyStep, materialize
from stormgrid.sources import files, warehouse
from stormgrid.streaming import jobs


def test_quantiles_of_one_large_group(spark):
    rng = random.Random(1)
    rows = [("big" if rng.random() < 0.9 else rng.choice(["a", "b", None]), None if rng.random() < 0.05 else rng.choice([rng.gauss(0, 1), 1.0, 2.0])) for _ in range(20_000)]
    rows += [("one", 3.0), ("none", None), ("two", 1.0), ("two", 2.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    got = {r.g: (r.low, r.median) for r in ordered.grouped_quantiles(df, "g", "v", {"low": 0.1, "median": 0.5}, partitions=5).collect()}
    for g in {r[0] for r in rows}:
        values = [v for k, v in rows if k == g and v is not None]
        want = (np.quantile(values, 0.1), statistics.median(values)) if values else (None, None)
        assert got[g] == pytest.approx(want) if values else got[g] == want, g
    # No task holds the large group: its different values lie on several runs.
    counts = df.groupBy("g", "v").count()
    assert ordered.runs(counts, [F.asc_nulls_first("g"), F.asc_nulls_first("v")], 5).where("g = 'big'").select("_run").distinct().count() >= 4
    assert {r.g: r.median for r in ordered.grouped_median(df, "g", "v").collect()}["two"] == 1.5
    assert ordered.grouped_median(df.limit(0), "g", "v").collect() == []


def _angles(lat1, lon1, lat2, lon2):
    p1, p2 = np.radians(lat1), np.radians(lat2)
    return np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(lon2 - lon1) / 2) ** 2


@pytest.mark.parametrize("kind", ["town", "globe"])
def test_nearest_of_many_points(spark, kind):
    rng = np.random.default_rng(7)
    if kind == "town":
        points = np.column_stack([rng.normal(39.8, 0.2, 10_000), rng.normal(-86.1, 0.2, 10_000)])
        probes = np.vstack([np.column_stack([rng.normal(39.8, 0.3, 400), rng.normal(-86.1, 0.3, 400)]), [[-33.0, 151.0], [90.0, 0.0]]])
    else:  # poles and the date line
        points = np.column_stack([rng.uniform(-90, 90, 500), rng.uniform(-180, 180, 500)])
        probes = np.vstack([np.column_stack([rng.uniform(-90, 90, 300), rng.uniform(-180, 180, 300)]), [[90.0, 10.0], [-90.0, 0.0], [0.0, 180.0], [0.0, -180.0], [89.9, 179.9]]])
    table = spark.createDataFrame([(i, float(a), float(o)) for i, (a, o) in enumerate(points)] + [(-1, None, 1.0)], "id int, lat double, lon double")
    rows = [(i, float(a), float(o)) for i, (a, o) in enumerate(probes)] + [(9000, None, 1.0), (9001, float(probes[0][0]), float(probes[0][1]))]
    df = spark.createDataFrame(rows, "n int, LAT double, LONG double").repartition(4)
    got = {r.n: r for r in nearest.with_nearest(df, table, size=0.05).collect()}
    assert len(got) == len(rows) and got[9000].Nearest is None and got[9001].Nearest == got[0].Nearest
    for i, (a, o) in enumerate(probes):
        angles = _angles(a, o, points[:, 0], points[:, 1])
        assert angles[got[i].Nearest] == pytest.approx(angles.min(), abs=1e-15), (i, a, o)
        assert got[i].Nearest_Km == pytest.approx(2 * C.EARTH_RADIUS_KM * np.arcsin(np.sqrt(angles.min())), abs=1e-6)
    assert nearest.with_nearest(df, table.limit(0), size=60.0).where("Nearest IS NOT NULL").count() == 0


def test_rings_join_on_cells(spark, monkeypatch):
    plans, real = [], nearest.materialize
    monkeypatch.setattr(nearest, "materialize", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df))
    df = spark.range(50).select((F.col("id") / 10).alias("LAT"), (F.col("id") / 7).alias("LONG"))
    nearest.with_nearest(df, df.select(F.monotonically_increasing_id().alias("id"), F.col("LAT").alias("lat"), F.col("LONG").alias("lon"))).collect()
    assert len(plans) > 1 and not any("Cartesian" in p or "NestedLoop" in p for p in plans)


def test_nearest_forms_no_rows_of_pairs(spark, monkeypatch):
    """Dense points: few share a first cell, and what is stored does not hold every pair."""
    rng, stored, real = np.random.default_rng(3), [], nearest.materialize
    monkeypatch.setattr(nearest, "materialize", lambda df: stored.append((real(df), df)) or stored[-1][0])
    near = rng.uniform(0, 0.4, (6000, 2)) + [40, -86]
    table = spark.createDataFrame([(i, float(a), float(o)) for i, (a, o) in enumerate(near)] + [(9000, *map(float, near[0])), (-3, *map(float, near[1]))], "id int, lat double, lon double")
    probes = [(i, float(a), float(o)) for i, (a, o) in enumerate(rng.uniform(-0.1, 0.5, (300, 2)) + [40, -86])] + [(1000, *map(float, near[0])), (1001, *map(float, near[1]))]
    for times in (1, 30):
        rows = [(k * 10_000 + n, a + k * 1e-4, o) for k in range(times) for n, a, o in probes]
        stored.clear()
        got = {r.n: r for r in nearest.with_nearest(spark.createDataFrame(rows, "n int, LAT double, LONG double"), table, size=0.5).collect()}
        assert got[1000].Nearest == 0 and got[1001].Nearest == -3
        for n, a, o in rows[:: times * 7]:
            angles = _angles(a, o, near[:, 0], near[:, 1])
            assert got[n].Nearest_Km == pytest.approx(2 * C.EARTH_RADIUS_KM * np.arcsin(np.sqrt(angles.min())), abs=1e-6)
        targets = stored[0][0]
        width = nearest.first_size(targets, 0.5)
        row, column, _ = nearest._cells(F.col("_lat"), F.col("_lon"), width)
        assert width < 0.1 and targets.groupBy(row, column).count().agg({"count": "max"}).first()[0] <= nearest.CROWD
        assert targets.count() == 6000 and all(frame.count() <= 20 * len(rows) + 6000 for frame, _ in stored[1:])


def test_weather_by_date_is_pruned(spark, tmp_path):
    start = dt.datetime(2024, 1, 1, 5)
    rows = [(start + dt.timedelta(days=d), f"IPL_Marker{m}", float(d * m), start) for d in range(30) for m in (1, 2)]
    path = str(tmp_path / "w")
    warehouse.store_by_date(spark.createDataFrame(rows, "timestamp timestamp, Location string, tempAvg double, Job_Update_Time timestamp"), path)
    outages = spark.createDataFrame([(1, start + dt.timedelta(days=3), "Marker 1"), (2, start + dt.timedelta(days=9), "Marker 2"), (3, None, "Marker 1")], "id int, CREATION_DATETIME timestamp, Marker_Location string")
    stored = spark.read.parquet(path)
    found = joins.weather_for_dates(stored, outages)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted((str(r.Date), r.Location) for r in found.collect()) == [(d, f"IPL_Marker{m}") for d in ("2024-01-04", "2024-01-10") for m in (1, 2)]
    plain = joins.weather_for_dates(stored.drop("Date"), outages)
    assert sorted(found.select("timestamp", "Location").collect()) == sorted(plain.select("timestamp", "Location").collect())


def test_files_with_broken_rows_and_shifted_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,n,note\n1,2,x\nbad,3,y\n4,5,z,more\n6,,\n")
    (tmp_path / "b.csv").write_text("n,id,note\n2,1,x\n")
    (tmp_path / "c.csv").write_text('"ID", "n","note"\n7,8,w\n')
    (tmp_path / "d.csv").write_text("id,n,note\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("note", T.StringType())])
    good, rejects = files.read_checked(spark, str(tmp_path / "*.csv"), schema)
    assert sorted(map(tuple, good.collect())) == [(1, 2, "x"), (6, None, None), (7, 8, "w")]
    assert sorted((r.file[-5:], r.reason, r.row) for r in rejects.collect()) == [("a.csv", "row", "4,5,z,more"), ("a.csv", "row", "bad,3,y"), ("b.csv", "header", "2,1,x")]


def _jobs(spark, work):
    tracker, group = spark.sparkContext.statusTracker(), f"g{random.random()}"
    spark.sparkContext.setJobGroup(group, "counted")
    work()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(tracker.getJobIdsForGroup(group))


def test_gates_need_no_job_of_their_own(spark):
    df = spark.range(100).repartition(3)
    assert _jobs(spark, lambda: materialize(df)) == _jobs(spark, lambda: materialize(df, "rows")) > 0
    with pytest.raises(EmptyStep, match="nothing left"):
        materialize(df.where("id < 0"), "nothing left")
    assert materialize(df.where("id < 0")).count() == 0


def test_gate_of_a_stream(spark, tmp_path):
    schema = "OUTAGE_ID string, CREATION_DATETIME timestamp, n int"
    feed = str(tmp_path / "feed")
    spark.createDataFrame([], schema).write.parquet(feed)
    stream = jobs.read_feed(spark, feed, spark.read.parquet(feed).schema, "*.parquet", "parquet")
    with pytest.raises(EmptyStep, match="feed of changes"):
        jobs.upsert_batches(stream, str(tmp_path / "out"), str(tmp_path / "progress"), ["OUTAGE_ID"], ["n"])


def test_days_with_an_incomplete_marker_lack_the_value(spark):
    rows = [("2024-01-01", 1, 1.0, 2.0), ("2024-01-01", 2, None, 4.0), ("2024-01-02", 1, 3.0, 1.0)]
    df = spark.createDataFrame(rows, "Date string, m int, a double, b double")
    got = sorted(map(tuple, preparedness.incomplete_as_null(df, ["a", "b"]).collect()))
    assert got == [("2024-01-01", 1, None, 2.0), ("2024-01-01", 2, None, 4.0), ("2024-01-02", 1, 3.0, 1.0)]

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stormgrid import schemas
from stormgrid.plans import daily_summary, weather_view
from stormgrid.session import materialize, shared_dir
from stormgrid.sources import files, sinks, snapshots, warehouse


def test_latin_csv_and_parsed_times(spark, tmp_path):
    path = tmp_path / "facility.csv"
    names = [f.name for f in schemas.FACILITY.fields]
    row = {"FAC_JOB_ID": "1", "STRCTUR_NO": "Señal", "CREATION_DATETIME": "2024-01-01 05:00:00", "ETR_DATETIME": "soon"}
    path.write_bytes(("\n".join([",".join(names), ",".join(row.get(n, "") for n in names)]) + "\n").encode("latin-1"))
    got = files.with_parsed_times(files.read_facility(spark, str(path), schemas.FACILITY)).first()
    assert (got.STRCTUR_NO, got.CREATION_DATETIME, got.ETR_DATETIME) == ("Señal", dt.datetime(2024, 1, 1, 5), None)
    assert files.read_csv(spark, str(path), encoding=files.LATIN).schema["FAC_JOB_ID"].dataType.simpleString() == "int"


def test_newest_file_per_feed(spark, tmp_path, rows):
    names = ["INCIDENT_DEVICE_IPL_01.csv", "INCIDENT_DEVICE_IPL_02.csv", "INCIDENT_IPL_01.csv", "LOCATION_IPL_01.csv", "LOCATION_IPL_HIS_09.csv", "FACILITY_IPL_Daily_HIS_2.csv", "FACILITY_IPL_Daily_HIS_1.csv", "other.csv"]
    for name in names:
        (tmp_path / "20240101").mkdir(exist_ok=True)
        (tmp_path / "20240101" / name).write_text("x\n")
    manifest = files.list_files(spark, str(tmp_path))
    current = files.latest_files(manifest, day="20240101").withColumn("path", F.substring_index("path", "/", -1))
    assert rows(current, "feed", "path") == [
        ("device", "INCIDENT_DEVICE_IPL_02.csv"), ("history", "FACILITY_IPL_Daily_HIS_1.csv"),
        ("incident", "INCIDENT_IPL_01.csv"), ("location", "LOCATION_IPL_01.csv"),
    ]


def test_gate_needs_three_new_files(spark):
    schema = "feed string, path string"
    current = spark.createDataFrame([("device", "d2"), ("incident", "i2"), ("location", "l2"), ("history", "h1")], schema)
    def gate(*last):
        return tuple(files.freshness_gate(current, spark.createDataFrame(last, schema)).first())

    assert gate(("device", "d1"), ("incident", "i1"), ("location", "l1"), ("history", "h1")) == (3, 0, 1)
    assert gate(("device", "d2"), ("incident", "i1"), ("location", "l1")) == (3, 1, 0)
    assert gate(("none", "x")) == (3, 0, 1)


def test_publish_appends_and_replaces(spark, tmp_path, rows):
    root = str(tmp_path / "p")
    for stamp, ids in (("2024-01-01 00:00", [1, 2]), ("2024-01-01 00:32", [3]), ("2024-01-01 00:32", [3])):
        sinks.publish(spark.createDataFrame([(i, stamp) for i in ids], "id int, Last_Updated string"), root, stamp)
    history, live = (snapshots.read(spark, root, name, "id int, Last_Updated string") for name in (sinks.HISTORY, sinks.LIVE))
    assert rows(history, "id") == [(1,), (2,), (3,)] and rows(live, "id") == [(3,)]


def _ids(spark, root, table, **options):
    return sorted(r.id for r in snapshots.read(spark, root, table, "id int", **options).collect())


@pytest.mark.parametrize("broken", ["replace", "_commit"])
def test_a_failure_between_the_writes_leaves_both_tables(spark, tmp_path, monkeypatch, broken):
    root = str(tmp_path / "p")
    sinks.publish(spark.createDataFrame([(1,)], "id int"), root, "a")
    real = getattr(snapshots.Transaction, broken)

    def fail(*args):
        raise OSError("lost")

    monkeypatch.setattr(snapshots.Transaction, broken, fail)
    with pytest.raises(OSError):
        sinks.publish(spark.createDataFrame([(2,)], "id int"), root, "b")
    assert _ids(spark, root, "history") == [1] and _ids(spark, root, "live") == [1]
    monkeypatch.setattr(snapshots.Transaction, broken, real)
    for _ in range(2):
        sinks.publish(spark.createDataFrame([(2,)], "id int"), root, "b")
    assert _ids(spark, root, "history") == [1, 2] and _ids(spark, root, "live") == [2]
    assert snapshots.vacuum(spark, root, keep=1) >= 1
    assert _ids(spark, root, "history") == [1, 2] and _ids(spark, root, "live") == [2]


def test_named_parts_versions_and_races(spark, tmp_path):
    root = str(tmp_path / "t")
    frame = lambda *rows: spark.createDataFrame(rows, "id int, day string")
    with snapshots.Transaction(spark, root, "1") as run:
        run.replace_parts("days", frame((1, "a"), (2, "b"), (3, "c")), "day", ["a", "b", "c"])
    with snapshots.Transaction(spark, root, "2") as run:
        kept = run.read("days", "id int", ["b"])
        run.replace_parts("days", kept.unionByName(spark.createDataFrame([(4,)], "id int")).selectExpr("id", "'b' AS day"), "day", ["b", "c"])
        assert sorted(r.id for r in run.read("days", "id int").collect()) == [1, 2, 4]
        with pytest.raises(ValueError):
            run.replace_parts("days", frame((9, "z")), "day", ["a"])
    assert _ids(spark, root, "days") == [1, 2, 4] and _ids(spark, root, "days", number=1) == [1, 2, 3] and _ids(spark, root, "days", parts=["b"]) == [2, 4]
    assert _ids(spark, root, "none") == [] and snapshots.version(spark, root) == 2
    one, other = snapshots.Transaction(spark, root, "3"), snapshots.Transaction(spark, root, "4")
    with one:
        one.append("log", frame((1, "x")).select("id"))
    with pytest.raises(Exception, match="[Ee]xist"), other:
        other.append("log", frame((2, "x")).select("id"))
    assert _ids(spark, root, "log") == [1]


def test_many_appends_become_one_part(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "MERGE_AFTER", 3)
    root = str(tmp_path / "t")
    for i in range(8):
        with snapshots.Transaction(spark, root, str(i)) as run:
            run.append("log", spark.createDataFrame([(i,)], "id int"))
    assert _ids(spark, root, "log") == list(range(8)) and len(snapshots.manifest(spark, root)[0]) <= 3


def test_single_csv_and_slices(spark, tmp_path, rows):
    sinks.write_csv(spark.range(5), str(tmp_path / "one"), single_file=True)
    assert len(list((tmp_path / "one").glob("part-*.csv"))) == 1
    df = spark.createDataFrame([(dt.datetime(2024, 1, d, 5),) for d in range(1, 9)], "timestamp timestamp")
    sinks.write_day_slices(df, str(tmp_path / "s"), F.lit("2024-01-04").cast("date"))
    assert sorted(p.name for p in (tmp_path / "s").glob("day_label=*")) == [f"day_label={n}" for n in ("DAY_A_TOM", "DAY_B_YDAY", "TODAY", "TOM", "YDAY")]


def test_scan_predicates_are_pushed(spark, tmp_path):
    path = str(tmp_path / "w")
    spark.createDataFrame([], schemas.FORECAST_DAY).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    plan = warehouse.forecast_day(spark.read.parquet(path), "2024-01-01").select("tempAvg")._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(Location,IPL)" in plan and "EqualTo(timestamp" in plan
    assert "ReadSchema: struct<timestamp:timestamp,Location:string,tempAvg:double>" in plan


def test_next_hours(spark, rows):
    now = dt.datetime(2024, 1, 1, 8)
    df = spark.createDataFrame([(now + dt.timedelta(hours=h),) for h in (0, 1, 6, 7, 12, 24, 25, 1)], "timestamp timestamp")
    got = weather_view.next_hours(df, F.lit(now)).groupBy("Filter_ID").count()
    assert rows(got) == [("Next 12 Hours", 4), ("Next 24 Hours", 5), ("Next 6 Hours", 2)]


def test_shown_bounds(spark):
    row = (dt.date(2024, 1, 1), "One day ahead", 5, 9.0, 0, 12345, 3, 8)
    df = spark.createDataFrame([row], schemas.STORM_PREPARATIONS)
    assert tuple(daily_summary.forecast_bounds(df, "2024-01-01").first()) == ("3", "8", "0", "12,345")


def test_steps_are_stored_in_the_shared_folder(spark):
    step = materialize(spark.range(4))
    assert shared_dir(spark) in step.inputFiles()[0] and step.count() == 4

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormgrid import constants as C
from stormgrid.operators import aggregate
from stormgrid.operators.trailing import known_outages, trailing_counts
from stormgrid.sources import snapshots
from stormgrid.streaming import jobs

ID = T.StructField("OUTAGE_ID", T.StringType())

FLAGS = list(C.DAILY_COUNTERS.values())
SCHEMA = "OUTAGE_ID string, CREATION_DATETIME timestamp, " + ", ".join(f"{f} int" for f in FLAGS)


def _land(spark, folder, number):
    start = dt.datetime(2024, 1, 1, 6) + dt.timedelta(hours=9 * number)
    data = [(f"{number * 4 + i}", start + dt.timedelta(minutes=20 * i), i % 2, 1, 0, 0, 1) for i in range(6)]  # ids overlap between files
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def _stream(spark, folder):
    return jobs.read_feed(spark, folder, spark.read.parquet(folder).schema, "*.parquet", "parquet", files_per_batch=1)


def test_files_are_picked_up_once(spark, tmp_path):
    feed, out, progress = (str(tmp_path / n) for n in ("feed", "out", "progress"))
    _land(spark, feed, 0)
    jobs.pick_up_new_files(_stream(spark, feed), out, progress)
    jobs.pick_up_new_files(_stream(spark, feed), out, progress)
    assert spark.read.parquet(out).count() == 6
    _land(spark, feed, 1)
    jobs.pick_up_new_files(_stream(spark, feed), out, progress)
    assert spark.read.parquet(out).count() == 12 and spark.read.parquet(out).select("source_file").distinct().count() == 2


def test_running_counts_end_at_the_batch_result(spark, tmp_path, rows):
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    for n in range(3):
        _land(spark, feed, n)
        jobs.daily_counts(_stream(spark, feed), out, str(tmp_path / "progress"))
    assert rows(jobs.newest_rows(spark, out, ["Date"]).select("Date", *C.DAILY_COUNTERS)) == rows(aggregate.daily_counters(spark.read.parquet(feed)))


def test_each_outage_passes_once_and_predicted_ones_not(spark, tmp_path):
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    predicted = spark.createDataFrame([("2",)], "OUTAGE_ID string")
    for n in range(2):
        _land(spark, feed, n)
        jobs.not_yet_predicted(_stream(spark, feed), predicted, out, str(tmp_path / "progress"))
    assert sorted(int(r[0]) for r in spark.read.parquet(out).select("OUTAGE_ID").collect()) == [0, 1, 3, 4, 5, 6, 7, 8, 9]


def test_upserts_repeat_and_compact(spark, tmp_path, rows):
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    for n in range(2):
        _land(spark, feed, n)
    jobs.upsert_batches(_stream(spark, feed), out, str(tmp_path / "progress"), ["OUTAGE_ID"], ["CREATION_DATETIME"])
    now = rows(jobs.newest_rows(spark, out, ["OUTAGE_ID"]), "OUTAGE_ID", "CREATION_DATETIME")
    want = spark.read.parquet(feed).groupBy("OUTAGE_ID").agg(F.max("CREATION_DATETIME"))
    assert now == rows(want)
    jobs.compact(spark, out, ["OUTAGE_ID"], str(tmp_path / "small"))
    assert rows(jobs.newest_rows(spark, str(tmp_path / "small"), ["OUTAGE_ID"]), "OUTAGE_ID", "CREATION_DATETIME") == now


def test_trailing_batches_see_recent_history(spark, tmp_path, rows):
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    _land(spark, feed, 0)
    history = spark.createDataFrame([("h1", dt.datetime(2024, 1, 1, 5)), ("h2", dt.datetime(2023, 12, 1))], "OUTAGE_ID string, CREATION_DATETIME timestamp")
    live = _stream(spark, feed).select("OUTAGE_ID", "CREATION_DATETIME")
    jobs.trailing_count_batches(live, history, out, str(tmp_path / "progress"))
    batch = spark.read.parquet(feed).select("OUTAGE_ID", "CREATION_DATETIME")
    want = trailing_counts(batch, batch.unionByName(history))
    assert rows(jobs.trailing_table(spark, out, ID)) == rows(want)


def _feed(spark, folder, parts, schema="OUTAGE_ID string, CREATION_DATETIME timestamp, " + ", ".join(f"{f} int" for f in FLAGS)):
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)


def _dealt(rows, ways):
    """The same rows in one file, in several out of date order, and one row per file."""
    return {1: [rows], 3: [rows[2::3], rows[::3], rows[1::3]], len(rows): [[r] for r in reversed(rows)]}[ways]


def _outages():
    first = dt.datetime(2024, 1, 10, 20)
    times = [0, 1, 2.5, 3, 5, -120, 27, 11, 2.5]  # hours; one five days late, one the day after
    return [(f"o{i}", first + dt.timedelta(hours=h), i % 2, 1, 0, 0, 1) for i, h in enumerate(times)]


def test_late_days_count_in_any_batch(spark, tmp_path, rows):
    want = rows(aggregate.daily_counters(spark.createDataFrame(_outages(), SCHEMA)))
    for ways in (1, 3, 9):
        feed, out = str(tmp_path / f"feed{ways}"), str(tmp_path / f"out{ways}")
        _feed(spark, feed, _dealt(_outages(), ways))
        jobs.daily_counts(_stream(spark, feed), out, str(tmp_path / f"progress{ways}"))
        assert rows(jobs.newest_rows(spark, out, ["Date"]).select("Date", *C.DAILY_COUNTERS)) == want, ways


def test_late_outages_pass_in_any_batch(spark, tmp_path):
    predicted = spark.createDataFrame([("o3",)], "OUTAGE_ID string")
    for ways in (1, 3, 9):
        feed, out = str(tmp_path / f"feed{ways}"), str(tmp_path / f"out{ways}")
        _feed(spark, feed, _dealt(_outages(), ways) + [_outages()[:2]])
        jobs.not_yet_predicted(_stream(spark, feed), predicted, out, str(tmp_path / f"progress{ways}"))
        assert sorted(r[0] for r in spark.read.parquet(out).select("OUTAGE_ID").collect()) == [f"o{i}" for i in range(9) if i != 3], ways


def test_trailing_counts_do_not_depend_on_batches(spark, tmp_path, rows):
    outages = [r[:2] for r in _outages()] + [("o1", dt.datetime(2024, 1, 10, 22, 30)), ("none", None)]  # one id moves
    history = spark.createDataFrame([("o2", dt.datetime(2024, 1, 10, 19)), ("h", dt.datetime(2024, 1, 10, 21, 30)), ("old", dt.datetime(2023, 1, 1))], "OUTAGE_ID string, CREATION_DATETIME timestamp")
    schema = "OUTAGE_ID string, CREATION_DATETIME timestamp"
    whole = spark.createDataFrame(outages, schema)
    want = rows(trailing_counts(whole, known_outages(whole, history)))
    for ways in (1, 3, 11):
        feed, out = str(tmp_path / f"feed{ways}"), str(tmp_path / f"out{ways}")
        _feed(spark, feed, _dealt(outages, ways), schema)
        jobs.trailing_count_batches(_stream(spark, feed), history, out, str(tmp_path / f"progress{ways}"))
        assert rows(jobs.trailing_table(spark, out, ID)) == want, ways


def test_trailing_batches_read_only_days_they_can_change(spark, tmp_path, monkeypatch):
    """Rows read per batch do not grow with the days before it, and the scans name their days."""
    schema, feed, out = "OUTAGE_ID string, CREATION_DATETIME timestamp", str(tmp_path / "feed"), str(tmp_path / "out")
    asked, read = [], snapshots.Transaction.read

    def watched(run, table, shape, parts=None):
        frame = read(run, table, shape, parts)
        asked.append((len(parts), len(frame.inputFiles()) and frame.count()))
        return frame

    monkeypatch.setattr(snapshots.Transaction, "read", watched)
    history = spark.createDataFrame([], schema)
    for day in range(4):
        start = dt.datetime(2024, 1, 1) + dt.timedelta(days=10 * day)
        _feed(spark, feed, [[(f"{day}-{i}", start + dt.timedelta(minutes=i)) for i in range(20)]], schema)
        asked.append("batch")
        jobs.trailing_count_batches(_stream(spark, feed), history, out, str(tmp_path / "progress"))
    batches = [b.strip() for b in " ".join(map(str, asked)).split("batch")[2:]]
    assert len(set(batches)) == 1 and jobs.trailing_table(spark, out, ID).count() == 80
    one = jobs.trailing_table(spark, out, ID, days=["2024-01-11"])
    assert one.count() == 20 and all("_part=2024-01-11" in f for f in one.inputFiles())


def test_outages_share_entries_of_the_state_store(spark, tmp_path, monkeypatch):
    """One call of Python and one entry for many outages; what a batch changes comes with what it was."""
    monkeypatch.setattr(jobs, "KEY_BUCKETS", 3)
    schema, feed, start = "OUTAGE_ID long, CREATION_DATETIME timestamp", str(tmp_path / "feed"), dt.datetime(2024, 1, 10)
    big = (1 << 60) + 1  # not a double
    first = [(big + i, start + dt.timedelta(minutes=i)) for i in range(200)] + [(None, start), (None, None), (5, None)]
    _feed(spark, feed, [first, [(big, start - dt.timedelta(days=1)), (None, start + dt.timedelta(days=1)), (7, start)]], schema)
    stored = str(tmp_path / "history")
    spark.createDataFrame([(big + 1, start), (big + 1, start + dt.timedelta(hours=1)), (9, None)], schema).write.parquet(stored)
    seen = {}
    changes = jobs.outage_times(_stream(spark, feed), spark.readStream.schema(schema).parquet(stored), "OUTAGE_ID", "CREATION_DATETIME")
    run = changes.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True)
    run = run.foreachBatch(lambda df, batch: seen.update({batch: {r.key: tuple(r)[1:] for r in df.collect()}})).start()
    run.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in run.recentProgress if p["stateOperators"]) <= 3
    at = {n: int((start + dt.timedelta(hours=n) - dt.datetime(1970, 1, 1)).total_seconds()) * 1_000_000 for n in (-24, 0, 1, 24)}
    whole = seen[0] | seen[1]
    assert len(whole) == 204 and whole[big + 1] == (True, at[0] + 60_000_000, at[1], False, None, None) and whole[5] == (True, None, None, False, None, None)
    assert whole[9] == (False, None, None, False, None, None) and seen[1].keys() == {big, None, 7}
    assert seen[1][big] == (True, at[-24], at[0], True, at[0], at[0]) and seen[1][None] == (True, at[0], at[24], True, at[0], at[0])


def test_a_failed_trailing_batch_repeats(spark, tmp_path, rows, monkeypatch):
    schema, feed, out = "OUTAGE_ID string, CREATION_DATETIME timestamp", str(tmp_path / "feed"), str(tmp_path / "out")
    outages = [r[:2] for r in _outages()]
    _feed(spark, feed, _dealt(outages, 3), schema)
    history, commit, calls = spark.createDataFrame([], schema), snapshots.Transaction._commit, []

    def sometimes(run):
        calls.append(run.token)
        if len(calls) == 2:
            raise OSError("lost")
        commit(run)

    monkeypatch.setattr(snapshots.Transaction, "_commit", sometimes)
    with pytest.raises(Exception, match="lost"):
        jobs.trailing_count_batches(_stream(spark, feed), history, out, str(tmp_path / "progress"))
    jobs.trailing_count_batches(_stream(spark, feed), history, out, str(tmp_path / "progress"))
    whole = spark.createDataFrame(outages, schema)
    assert rows(jobs.trailing_table(spark, out, ID)) == rows(trailing_counts(whole, known_outages(whole, history)))


def test_another_progress_folder_is_refused(spark, tmp_path):
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    _land(spark, feed, 0)
    jobs.daily_counts(_stream(spark, feed), out, str(tmp_path / "progress"))
    jobs.daily_counts(_stream(spark, feed), out, str(tmp_path / "progress"))
    with pytest.raises(ValueError):
        jobs.daily_counts(_stream(spark, feed), out, str(tmp_path / "another"))

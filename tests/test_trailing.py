import random

from pyspark.sql import functions as F

from stormgrid.operators.trailing import known_outages, trailing_counts

BASE = 1_704_067_200  # midnight


def _frame(spark, pairs):
    return spark.createDataFrame(pairs, "OUTAGE_ID string, s bigint").select("OUTAGE_ID", F.timestamp_seconds("s").alias("CREATION_DATETIME"))


def _brute(probes, events, hours=10):
    return {
        (i, k): sum(1 for _, e in events if 0 < s - e <= 3600 * k) for i, s in probes for k in range(1, hours + 1)
    }


def _got(df):
    return {(r.OUTAGE_ID, k): r[f"Outages_in_last_{k}hr"] for r in df.collect() for k in range(1, 11)}


def test_boundaries(spark):
    probe = [("p", BASE + 7200)]
    events = [("same", BASE + 7200), ("second", BASE + 7199), ("hour", BASE + 3600), ("over", BASE + 3599), ("later", BASE + 7201), ("ten", BASE + 7200 - 36000), ("past", BASE + 7199 - 36000)]
    got = _got(trailing_counts(_frame(spark, probe), _frame(spark, events)))
    assert got == _brute(probe, events)
    assert (got["p", 1], got["p", 2], got["p", 10]) == (2, 3, 4)


def test_storm_day_against_brute_force(spark):
    """A third of the outages start in the same second, the rest run over three days."""
    rng = random.Random(4)
    times = [BASE + 86_400 if i % 3 == 0 else BASE + rng.randrange(3 * 86_400) for i in range(600)]
    live = [(f"l{i}", t) for i, t in enumerate(times)]
    history = [(f"h{i}", BASE + rng.randrange(3 * 86_400)) for i in range(200)]
    events = live + history
    assert _got(trailing_counts(_frame(spark, live), _frame(spark, events))) == _brute(live, events)


def test_history_wins_and_ids_count_once(spark, rows):
    live = _frame(spark, [("a", BASE), ("b", BASE + 5)])
    history = _frame(spark, [("a", BASE + 100), ("c", BASE + 7)])
    got = known_outages(live, history).select("OUTAGE_ID", F.unix_timestamp("CREATION_DATETIME") - BASE)
    assert rows(got) == [("a", 100), ("b", 5), ("c", 7)]
    twice = _frame(spark, [("a", BASE + 50), ("a", BASE + 10)])
    assert trailing_counts(twice, history).count() == 1


def test_groups_are_bounded_by_the_seconds_of_a_day(spark):
    """Rows are grouped by second before the window sees them."""
    plan = trailing_counts(_frame(spark, [("a", BASE)]), _frame(spark, [("a", BASE)]))._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window ["):]
    assert "Aggregate [_sec" in window

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stormgrid.operators import ordered, priority


def _skewed(spark, n=3000, seed=5):
    """A third of all rows share one value; some have none."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        value = 7.5 if i % 3 == 0 else (None if rng.random() < 0.05 else round(rng.uniform(0, 400), 1))
        data.append((i, value))
    return spark.createDataFrame(data, "id int, v double").repartition(6)


@pytest.mark.parametrize("descending", [False, True])
def test_dense_rank_equals_the_plain_window(spark, rows, descending):
    df = _skewed(spark)
    order = F.col("v").desc() if descending else F.col("v").asc()
    want = df.where("v IS NOT NULL").withColumn("r", F.dense_rank().over(Window.orderBy(order)).cast("bigint"))
    want = want.unionByName(df.where("v IS NULL").withColumn("r", F.lit(None).cast("bigint")))
    assert rows(ordered.dense_rank_of(df, "v", "r", descending, partitions=5)) == rows(want)


def test_max_rank_counts_rows_up_to_the_value(spark, rows):
    df = _skewed(spark)
    window = Window.orderBy("v").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.where("v IS NOT NULL").withColumn("r", F.count("*").over(window))
    got = ordered.max_rank_of(df, "v", "r", partitions=5)
    assert rows(got.where("v IS NOT NULL")) == rows(want)
    assert got.where("v IS NULL AND r IS NULL").count() == df.where("v IS NULL").count()


def test_single_row_and_all_null(spark, rows):
    assert rows(ordered.dense_rank_of(spark.createDataFrame([(1, 4.0)], "id int, v double"), "v", "r")) == [(1, 4.0, 1)]
    empty = spark.createDataFrame([(1, None)], "id int, v double")
    assert rows(ordered.dense_rank_of(empty, "v", "r")) == [(1, None, None)]


def test_hot_values_are_salted(spark):
    """Rows of a hot value do not meet in one task of the join."""
    df = _skewed(spark)
    lookup = ordered.value_ranks(df, "v").drop("_upto")
    plan = ordered.attach_by_value(df, lookup, "v")._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "xxhash64" in plan


def test_rank_within_day(spark, rows):
    base = 1_704_067_200
    rng = random.Random(2)
    data = [(i, base + (0 if i % 3 == 0 else rng.randrange(5 * 86400))) for i in range(2000)]
    df = spark.createDataFrame(data, "id int, s bigint").select("id", F.timestamp_seconds("s").alias("ts"))
    want = df.withColumn("r", F.dense_rank().over(Window.partitionBy(F.to_date("ts")).orderBy("ts")).cast("bigint"))
    assert rows(ordered.rank_within_day(df, "ts", "r", partitions=4)) == rows(want)


@pytest.mark.parametrize("partitions", [1, 4, 9])
def test_forward_fill_equals_the_plain_window(spark, rows, partitions):
    rng = random.Random(9)
    data = [(i, rng.randrange(50), rng.choice([None, None, rng.random()]), rng.choice([None, "x", "y"]), None) for i in range(1500)]
    data = [(i, k, None if k < 4 else a, b, c) for i, k, a, b, c in data]  # leading gaps stay
    df = spark.createDataFrame(data, "id int, k int, a double, b string, c int").repartition(7)
    upto = Window.orderBy("k", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.select("id", "k", *[F.last(x, ignorenulls=True).over(upto).alias(x) for x in ("a", "b", "c")])
    got = ordered.forward_fill(df, ["a", "b", "c"], ["k", "id"], partitions)
    assert rows(got) == rows(want) and got.where("a IS NULL").count() > 0


def test_exact_median(spark):
    for values in ([3.0], [1.0, 2.0], [5.0, 1.0, 3.0], [1.0, 1.0, 1.0, 9.0], [4.0, 4.0, 8.0, 8.0, None]):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        known = sorted(v for v in values if v is not None)
        want = (known[(len(known) - 1) // 2] + known[len(known) // 2]) / 2
        assert ordered.exact_median(df, "v", partitions=3).first()[0] == want


def test_no_single_task_holds_the_rows(spark):
    """The only single-partition step works on one row per run."""
    df = _skewed(spark)
    ranks = ordered.value_ranks(df, "v", partitions=5)
    plan = ranks._jdf.queryExecution().executedPlan().toString()
    for part in plan.split("Exchange SinglePartition")[1:]:
        assert "HashAggregate" in part.split("\n")[1]  # the per-run totals


def test_priority_by_distance(spark):
    df = spark.createDataFrame([("a", 39.7, -86.1, 10), ("b", 39.9, -86.3, 10), ("c", 39.9, -86.3, 10), ("d", None, None, 4), ("e", 39.8, -86.2, 0)],
                               "OUTAGE_ID string, LAT double, LONG double, CUST_QTY int")
    got = {r.OUTAGE_ID: r.Priority_Dist_Customer_Qty for r in priority.by_distance(df).collect()}
    assert got == {"a": 1, "b": 3, "c": 3, "d": None, "e": None}
    mean = {r.OUTAGE_ID: r.Center_Distance for r in priority.with_center_distance(df.where("LAT IS NOT NULL"), "haversine", "mean").collect()}
    assert mean["b"] == mean["c"] and mean["e"] < mean["a"]
    assert {r.OUTAGE_ID: r.Priority_Customer_Qty for r in priority.by_customers(df).collect()} == {"a": 1, "b": 1, "c": 1, "d": 2, "e": 3}


def test_rows_without_a_key_are_spread(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(20_000).select("id", F.when(F.col("id") % 10 == 0, F.col("id")).alias("key"))
        ranked = ordered.dense_rank_of(df, "key", "rank")
        sizes = ranked.groupBy(F.spark_partition_id()).count()
        counts = [r["count"] for r in sizes.collect()]
        assert ranked.where("(rank IS NULL) <> (key IS NULL)").count() == 0 and max(counts) < 2 * 20_000 / 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_forward_fill_shuffles_the_stored_rows_once(spark):
    df = spark.createDataFrame([(i, i // 3, None if i % 4 else float(i), None if i % 7 else "x") for i in range(50)], "o int, p int, a double, b string")
    filled = ordered.forward_fill(df, ["a", "b"], ["o"], partitions=5)
    plan = filled._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(_run") <= 2 and "a#" in plan  # the rows, and the summary of one row per run
    rows = sorted(filled.collect())
    assert [r.a for r in rows] == [float(4 * (i // 4)) for i in range(50)] and [r.b for r in rows] == ["x"] * 50

import numpy as np
import pytest
from pyspark.sql import functions as F

from stormgrid import constants as C
from stormgrid.models import components, forecasts
from stormgrid.operators import reshape


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 3))
    data = np.hstack([base, base @ rng.normal(size=(3, 3)) + 0.1 * rng.normal(size=(60, 3))])
    names = [f"f{i}" for i in range(6)]
    return data, names, spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(data)], "Date int, " + ", ".join(f"{n} double" for n in names))


def test_components_equal_numpy(spark, table):
    data, names, df = table
    model = components.fit_components(df, names, k=3)
    scores = np.array([r[1:] for r in model.scores(df).orderBy("Date").collect()])
    z = (data - data.mean(0)) / data.std(0, ddof=1)
    values, vectors = np.linalg.eigh(np.cov(z.T))
    vectors = vectors[:, ::-1][:, :3]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), range(3)])
    assert np.allclose(scores, z @ vectors, atol=1e-8)
    running = [r.running_percent for r in model.variance(spark).orderBy("component").collect()]
    assert np.allclose(running, np.cumsum(np.round(values[::-1][:3] / values.sum(), 3) * 100))
    shuffled = df.select("Date", *reversed(names))
    assert np.allclose([r[1:] for r in model.scores(shuffled).orderBy("Date").collect()], scores)


def test_zscores_of_new_rows_use_the_reference(spark, table):
    data, names, df = table
    got = components.zscores(df.limit(1), names, df).first()
    assert got.f2 == pytest.approx((data[got.Date, 2] - data[:, 2].mean()) / data[:, 2].std(ddof=1))


def test_pivot_and_vectors_agree(spark):
    data = [(f"2024-01-0{d} 05:00:00", f"IPL_Marker{m}", d * 10.0 + m, 1.0) for d in (1, 2) for m in (1, 2, 3)]
    data += [("2024-01-03 05:00:00", "IPL_Marker2", 9.0, 1.0), ("2024-01-04 05:00:00", "IPL_Marker1", 9.0, 1.0)]
    df = spark.createDataFrame(data, "timestamp string, Location string, tempAvg double, precip double").withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    wide = {str(r.Date): r for r in reshape.marker_pivot(df, ["tempAvg", "precip"], 3).collect()}
    assert set(wide) == {"2024-01-01", "2024-01-02", "2024-01-04"}  # no first marker on the third
    assert wide["2024-01-04"].MARKER2_tempAvg is None and wide["2024-01-02"].MARKER3_tempAvg == 23.0
    vectors = {str(r.Date): r.features for r in reshape.marker_vectors(df, ["tempAvg", "precip"], 3).collect()}
    names = reshape.vector_names(["tempAvg", "precip"], 3)
    assert vectors == {d: [wide[d][n] for n in names] for d in ("2024-01-01", "2024-01-02")}


def test_model_columns():
    class Frame:
        columns = [*C.COMPONENT_LABELS, "MARKER1_radSolarMin", "MARKER1_tempAvg", "MARKER20_radSolarMin"]

    assert reshape.model_columns(Frame) == ["MARKER1_tempAvg"]


def test_log_and_cube_targets_come_back(spark):
    df = spark.createDataFrame([(i, float(i % 20), float(np.exp(1 + 0.1 * (i % 20)))) for i in range(200)], "Date int, x double, OUTAGES double")
    model = forecasts.fit_outage_count(df, ["x"])
    row = forecasts.forecast_outages(model, df.where("x = 10")).first()
    assert row.predicted_Number_of_OUTAGES == pytest.approx(np.exp(2), rel=0.05) and row.Outages_LL_95 == 0
    cubes = df.withColumn("CUST_QTY", F.pow(F.abs(F.col("x") - 10) + 5, F.lit(3)))
    customers = forecasts.fit_customers(cubes, ["x"], quantiles=(0.5,))
    got = forecasts.forecast_customers(customers, df.where("x = 4")).first()
    assert got.Predicted_Cust_Qty == pytest.approx(11**3, rel=0.2) and got.Predicted_Cust_Qty == round(got.Predicted_Cust_Qty)
    forest = forecasts.fit_restoration(df, ["x"], target="OUTAGES", trees=5)
    assert forest.predict(df.where("x = 19"), "p").first().p == pytest.approx(np.exp(2.9), rel=0.2)


def test_profiles(spark):
    data = [(i, f"Cluster{i % 3 + 1}", float(i % 3)) for i in range(90)]
    df = spark.createDataFrame(data, "id int, clusters string, x double")
    got = forecasts.classify_profiles(forecasts.fit_profiles(df, ["x"], trees=5), df, ["id"]).orderBy("id").collect()
    assert all(r.clusters == f"Cluster{r.id % 3 + 1}" and r.profile == C.PROFILES[r.clusters] for r in got)
    first = got[0]
    assert sum(first[f"prob_{n}"] for n in C.PROFILES) == pytest.approx(1.0) and first.prob_Cluster6 == 0.0
    assert first.prob_2 <= first.prob_Cluster1 and first.profile_desc2 in C.PROFILES.values()


def test_rows_with_missing_inputs_come_back(spark):
    data = [(i, float(i % 20), None if i % 5 == 0 else float(i % 3), float(np.exp(1 + 0.1 * (i % 20)))) for i in range(100)]
    df = spark.createDataFrame(data, "Date int, x double, z double, OUTAGES double").withColumn("CUST_QTY", F.col("OUTAGES"))
    for model in (
        forecasts.fit_outage_count(df, ["x", "z"]), forecasts.fit_restoration(df, ["x", "z"], target="OUTAGES", trees=3), forecasts.fit_customers(df, ["x", "z"]),
    ):
        got = {r.Date: r.p for r in model.predict(df, "p").collect()}
        assert len(got) == 100 and all((got[i] is None) == (i % 5 == 0) for i in got)
    bands = forecasts.forecast_outages(forecasts.fit_outage_count(df, ["x", "z"]), df).collect()
    assert len(bands) == 100 and all((r.Outages_UL_95 is None) == (r.Date % 5 == 0) for r in bands)
    named = df.withColumn("clusters", F.concat(F.lit("Cluster"), (F.col("Date") % 3 + 1).cast("string")))
    rows = forecasts.classify_profiles(forecasts.fit_profiles(named, ["x", "z"], trees=3), named, ["Date"]).collect()
    assert len(rows) == 100
    assert all((r.clusters is None) == (r.Date % 5 == 0) and (r.prob_2 is None) == (r.Date % 5 == 0) and (r.profile is None) == (r.Date % 5 == 0) for r in rows)


def test_scores_of_incomplete_days_are_null(spark, table):
    _, names, df = table
    holes = df.withColumn("f1", F.when(F.col("Date") > 3, F.col("f1")))
    model = components.fit_components(holes, names, k=2)
    got = {r.Date: r.PC1 for r in model.scores(holes).collect()}
    assert len(got) == 60 and all((got[d] is None) == (d <= 3) for d in got)


def test_vectors_of_all_days(spark):
    df = spark.createDataFrame([("2024-01-01 05:00:00", "IPL_Marker2", 9.0)], "timestamp string, Location string, t double").withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    assert reshape.marker_vectors(df, ["t"], 3, complete_only=False).first().features == [None, 9.0, None]

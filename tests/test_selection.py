from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from stormgrid.models import components, moments, selection


def best_subset(x, y):
    """The subset of columns with the least criterion, and its coefficients, by trying all."""
    ends = []
    for k in range(x.shape[1] + 1):
        for names in combinations(range(x.shape[1]), k):
            design = np.column_stack([np.ones(len(y)), x[:, names]])
            weights, *_ = np.linalg.lstsq(design, y, rcond=None)
            rest = ((y - design @ weights) ** 2).sum() / ((y - y.mean()) ** 2).sum()
            ends.append((selection.aic(len(y), rest, k), names, weights))
    return min(ends, key=lambda e: e[0])


@pytest.mark.parametrize("seed", range(6))
def test_steps_find_the_best_subset_of_seven(seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(80, 7))
    x[:, 3] += 0.7 * x[:, 0]
    y = 2 + x[:, 0] - 0.5 * x[:, 3] + 0.4 * x[:, 5] * (seed % 2) + rng.normal(size=80)
    every = np.column_stack([x, y])
    centred = (every - every.mean(axis=0)).T @ (every - every.mean(axis=0))
    state = selection.search(centred, 80)
    _, names, weights = best_subset(x, y)
    assert tuple(sorted(state.inside)) == names
    assert np.allclose(list(state.coefficients().values()), weights[1:])


def test_sweeping_twice_restores_the_matrix():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(30, 5))
    state = selection.Sweeps(x.T @ x)
    before = state.a.copy()
    for k in (1, 3, 0, 3, 1, 0):
        state.sweep(k)
    assert np.allclose(state.a, before) and not state.inside


def test_stepwise_on_a_table(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 3))
    y = np.exp(1 + 0.5 * x[:, 1] + 0.05 * rng.normal(size=300))
    data = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))] + [(300, 1.0, None, 2.0, 5.0), (301, float("nan"), 1.0, 1.0, None)]
    df = spark.createDataFrame(data, "Date int, PC1 double, PC2 double, PC3 double, OUTAGES double").repartition(3)
    model = selection.stepwise(df, ["PC1", "PC2", "PC3"], F.log("OUTAGES"), "exp")
    _, names, weights = best_subset(x, np.log(y))
    assert [t.name for t in model.terms] == [f"PC{i + 1}" for i in names] and np.allclose([model.intercept, *model.coefficients], weights)
    got = {r.Date: r.p for r in model.predict(df, "p").collect()}
    assert len(got) == 302 and got[300] is None and got[0] == pytest.approx(np.exp(weights[0] + x[0, list(names)] @ weights[1:]))


def test_planted_knots_are_found(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.uniform(0, 10, size=(2000, 3)), 1)
    y = 4 + 2 * np.maximum(x[:, 0] - 3, 0) - np.maximum(6 - x[:, 1], 0) + 0.1 * rng.normal(size=2000)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, y double").repartition(4)
    knots = {name: [i / 2 for i in range(20)] for name in "abc"}
    model = selection.splines(df, ["a", "b", "c"], F.col("y"), knots=knots)
    assert [(t.name, t.knot, t.side) for t in model.terms] == [("a", 3.0, 1), ("b", 6.0, -1)]
    assert np.allclose([model.intercept, *model.coefficients], [4, 2, -1], atol=0.02)
    found = selection.splines(df, ["a", "b", "c"], F.col("y"))  # knots at quantiles
    rest = df.select((F.col("y") - F.lit(0)).alias("y"), "a", "b", "c")
    error = found.predict(rest, "p").agg(F.avg(F.pow(F.col("p") - F.col("y"), F.lit(2)))).first()[0]
    assert error < 0.05 and {t.name for t in found.terms} == {"a", "b"}


def test_pruning_keeps_the_least_cross_validation():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 5))
    y = x[:, 2] + 0.3 * rng.normal(size=60)
    every = np.column_stack([x, y])
    centred = (every - every.mean(axis=0)).T @ (every - every.mean(axis=0))
    kept = selection.pruned(centred, 60, set(range(5)), 2.0)
    assert 2 in kept.inside
    scores = {k: selection.gcv(60, kept.rest, k, 2.0) for k in (1, 5)}
    assert scores[1] < scores[5] and selection.gcv(3, 0.5, 2, 2.0) == float("inf")


def test_no_complete_row(spark):
    df = spark.createDataFrame([(1.0, None)], "x double, y double")
    for fit in (selection.stepwise, lambda *a: selection.splines(*a, knots={"x": [0.5]})):
        with pytest.raises(ValueError):
            fit(df, ["x"], F.col("y"))


def test_moments_merge_in_any_division(spark):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(500, 4)) * [1, 10, 100, 1] + [0, 5, -3, 1000]
    rows = [(i % 7 if i % 50 else None, *map(float, r)) for i, r in enumerate(data)] + [(1, None, 1.0, 1.0, 1.0), (1, float("nan"), 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "day int, a double, b double, c double, d double").repartition(6)
    columns = {c: F.col(c) for c in "abcd"}
    daily = moments.moments(df, columns, F.col("day"))
    assert sorted(r.n for r in daily.collect()) == sorted([10] + [sum(1 for i in range(500) if i % 50 and i % 7 == d) for d in range(7)])
    for parts in (daily, moments.moments(df, columns), moments.merged(daily, F.col("part") > 3)):
        whole = moments.total(parts, list("abcd"))
        assert whole.n == 500 and np.allclose(whole.means, data.mean(axis=0)) and np.allclose(whole.covariance(), np.cov(data.T))
    assert moments.total(moments.moments(df.limit(0), columns), list("abcd")).n == 0


def test_components_from_moments_equal_a_fit(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(80, 3))
    data = np.hstack([base, base @ rng.normal(size=(3, 2)) + 0.2 * rng.normal(size=(80, 2))])
    names = [f"f{i}" for i in range(5)]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(data)] + [(99, None, 1.0, 1.0, 1.0, 1.0)], "Date int, " + ", ".join(f"{n} double" for n in names))
    parts = moments.moments(df, {n: F.col(n) for n in names}, F.col("Date") % 9)
    model = moments.components(moments.total(parts, names), 3)
    want = {r.Date: r for r in components.fit_components(df, names, k=3).scores(df).collect()}
    got = {r.Date: r for r in model.scores(df).collect()}
    assert got[99].PC1 is None and want[99].PC1 is None
    assert np.allclose([got[i][1:] for i in range(80)], [want[i][1:] for i in range(80)], atol=1e-8)
    assert np.allclose(model.shares, components.fit_components(df, names, k=3).pca.explainedVariance.toArray())


def test_hinge_products_from_sums_by_interval(spark, monkeypatch):
    """As from the hinges of every row, of which none travels; knots may repeat, and lie beyond all rows."""
    rng = np.random.default_rng(4)
    rows = [(float(a), float(round(b, 1)), float(y)) for a, b, y in rng.normal(0, 2, (500, 3))] + [(None, 1.0, 1.0), (1.0, float("nan"), 1.0), (1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, y double").repartition(5)
    knots = {"a": [0.5, -1.0, 0.5, 9.0], "b": [-9.0, 0.0, 0.1, 1.0]}
    terms = [selection.Term(name, knot, side) for name in ("a", "b") for knot in knots[name] for side in (1, -1)]
    want = selection._total(df, terms, F.col("y"))
    monkeypatch.setattr(selection, "_total", None)
    got = selection.hinge_total(df, terms, F.col("y"))
    assert got.n == want.n == 500 and np.allclose(got.sums, want.sums) and np.allclose(got.products, want.products)
    assert selection.hinge_total(df.limit(0), terms, F.col("y")).n == 0
    assert selection.splines(df, ["a", "b"], F.col("y"), knots=knots) is not None

"""Queries: small fits of the model family that SQL can solve as well."""

from __future__ import annotations

from pyspark.sql import functions as F

from stormgrid import constants as C
from stormgrid.catalog import tables as t
from stormgrid.catalog.oracle import sql
from stormgrid.catalog.registry import query
from stormgrid.models import components, forecasts

_PAIR = "SELECT l_orderkey * 8 + l_linenumber AS Date, CAST(l_quantity AS DOUBLE) AS a, CAST(l_extendedprice AS DOUBLE) AS b FROM lineitem"
_STATS = "SELECT avg(a) AS ma, avg(b) AS mb, stddev_samp(a) AS sa, stddev_samp(b) AS sb, corr(a, b) AS r FROM pair"


def _pair(spark, folder):
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return t.load(spark, folder, "lineitem").select(key.alias("Date"), F.col("l_quantity").cast("double").alias("a"), F.col("l_extendedprice").cast("double").alias("b"))


@query(
    "pca_two_features",
    sql("", """SELECT Date, round(abs((a - ma) / sa + sign(r) * (b - mb) / sb) / sqrt(2), 5) + 0 AS PC1, round(abs((a - ma) / sa - sign(r) * (b - mb) / sb) / sqrt(2), 5) + 0 AS PC2 FROM pair, s""",
        {"pair": _PAIR, "s": _STATS}),
)
def pca_two_features(spark, folder):
    """Two standardised features lie along their sum and difference; the sizes of the scores, as their sign is a tie."""
    rows = _pair(spark, folder)
    scores = components.fit_components(rows, ["a", "b"], k=2).scores(rows)
    return scores.select("Date", *[(F.round(F.abs(c), 5) + 0).alias(c) for c in ("PC1", "PC2")])


@query(
    "pca_two_variances",
    sql("", """SELECT 1::BIGINT AS component, round((1 + abs(r)) / 2, 6) AS share, round((1 + abs(r)) / 2, 3) * 100 AS running_percent FROM s
      UNION ALL SELECT 2::BIGINT, round((1 - abs(r)) / 2, 6), round((1 + abs(r)) / 2, 3) * 100 + round((1 - abs(r)) / 2, 3) * 100 FROM s""",
        {"pair": _PAIR, "s": _STATS}),
)
def pca_two_variances(spark, folder):
    shown = components.fit_components(_pair(spark, folder), ["a", "b"], k=2).variance(spark)
    return shown.select("component", F.round("share", 6).alias("share"), F.round("running_percent", 6).alias("running_percent"))


_SPEND = "SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_custkey AS DOUBLE) END AS x, CAST(o_totalprice AS DOUBLE) AS OUTAGES FROM orders"


@query(
    "log_regression",
    sql("", """SELECT o_orderkey, round(slope * x + intercept, 6) AS log_forecast FROM spend,
      (SELECT regr_slope(ln(OUTAGES), x) AS slope, regr_intercept(ln(OUTAGES), x) AS intercept FROM spend WHERE OUTAGES > 0)""", {"spend": _SPEND}),
)
def log_regression(spark, folder):
    """One input, no ridge; every order comes back, without a forecast where the input is missing."""
    x = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey").cast("double"))
    rows = t.load(spark, folder, "orders").select("o_orderkey", x.alias("x"), F.col("o_totalprice").cast("double").alias("OUTAGES"))
    scored = forecasts.fit_outage_count(rows, ["x"], ridge=0.0).predict(rows, "p")
    return scored.select("o_orderkey", F.round(F.log("p"), 6).alias("log_forecast"))


_KNOT = 25.0
_BENT = f"""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_quantity AS DOUBLE) AS u, greatest(0, CAST(l_quantity AS DOUBLE) - {_KNOT}::DOUBLE) AS v,
  cbrt(CAST(l_extendedprice AS DOUBLE)) AS y FROM lineitem"""


@query(
    "hinge_regression",
    sql("", """SELECT l_orderkey, l_linenumber, round(my + bu * (u - mu) + bv * (v - mv), 5) AS root FROM bent, (SELECT *,
        (uy * vv - vy * uv) / (uu * vv - uv * uv) AS bu, (vy * uu - uy * uv) / (uu * vv - uv * uv) AS bv FROM (SELECT avg(u) AS mu, avg(v) AS mv, avg(y) AS my,
        covar_pop(u, u) AS uu, covar_pop(v, v) AS vv, covar_pop(u, v) AS uv, covar_pop(u, y) AS uy, covar_pop(v, y) AS vy FROM bent))""", {"bent": _BENT}),
)
def hinge_regression(spark, folder):
    """One input that bends at one knot, no ridge."""
    rows = t.load(spark, folder, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), F.col("l_quantity").cast("double").alias("u"), F.col("l_extendedprice").cast("double").alias("CUST_QTY")
    )
    scored = forecasts.fit_customers(rows, ["u"], knots={"u": [_KNOT]}, ridge=0.0).predict(rows, "p")
    return scored.select("l_orderkey", "l_linenumber", F.round(F.cbrt("p"), 5).alias("root"))


_TREE = "SELECT o_orderkey, CAST(CASE WHEN o_orderpriority LIKE '1%' THEN 1 ELSE 0 END AS DOUBLE) AS x, CAST(o_totalprice AS DOUBLE) AS TTR, 'Cluster' || (o_custkey % 6 + 1) AS clusters FROM orders"


def _tree_rows(spark, folder):
    first = F.col("o_orderpriority").startswith("1").cast("double").alias("x")
    profile = F.concat(F.lit("Cluster"), (F.col("o_custkey") % 6 + 1).cast("string")).alias("clusters")
    return t.load(spark, folder, "orders").select("o_orderkey", first, F.col("o_totalprice").cast("double").alias("TTR"), profile)


@query(
    "one_split_forest",
    sql("", "SELECT o_orderkey, round(avg(ln(TTR)) OVER (PARTITION BY x), 6) AS log_forecast FROM tree", {"tree": _TREE}),
)
def one_split_forest(spark, folder):
    """One tree of depth 1 without resampling on a 0/1 input: the mean logarithm of each side."""
    rows = _tree_rows(spark, folder)
    scored = forecasts.fit_restoration(rows, ["x"], trees=1, depth=1, bootstrap=False).predict(rows, "p")
    return scored.select("o_orderkey", F.round(F.log("p"), 6).alias("log_forecast"))


_SHARES = ", ".join(f"round(avg(CASE WHEN clusters = '{name}' THEN 1.0::DOUBLE ELSE 0 END) OVER (PARTITION BY x), 6) AS prob_{name}" for name in C.PROFILES)


@query("one_split_profiles", sql("", f"SELECT o_orderkey, {_SHARES} FROM tree", {"tree": _TREE}))
def one_split_profiles(spark, folder):
    """The same tree as a classifier: the share of each class on each side."""
    rows = _tree_rows(spark, folder)
    scored = forecasts.classify_profiles(forecasts.fit_profiles(rows, ["x"], trees=1, depth=1, bootstrap=False), rows, ["o_orderkey"])
    return scored.select("o_orderkey", *[F.round(f"prob_{name}", 6).alias(f"prob_{name}") for name in C.PROFILES])

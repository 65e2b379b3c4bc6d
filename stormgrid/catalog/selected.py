"""Queries: regressions that choose their terms, and components from moments that merge."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from stormgrid.catalog import tables as t
from stormgrid.catalog.fits import _PAIR, _STATS, _pair
from stormgrid.catalog.oracle import sql
from stormgrid.catalog.registry import query
from stormgrid.models import moments, selection
from stormgrid.session import materialize, work_path
from stormgrid.sources import sinks


def _det(rows: list[list[str]]) -> str:
    """Determinant by expansion along the first row."""
    if not rows:
        return "1.0::DOUBLE"
    parts = [f"{'-' if j % 2 else '+'} {rows[0][j]} * ({_det([r[:j] + r[j + 1:] for r in rows[1:]])})" for j in range(len(rows))]
    return "(" + " ".join(parts) + ")"


def _products(names: list[str], label: str, source: str) -> str:
    """Means and sums of products of deviations, as columns m_x and c_x_y."""
    every = [*names, label]
    means = ", ".join(f"avg({a}) AS m_{a}" for a in every)
    pairs = ", ".join(f"covar_pop({a}, {b}) * count(*) AS c_{a}_{b}" for a in every for b in every)
    return f"SELECT count(*) AS n, {means}, {pairs} FROM {source}"


def _fit(names: tuple[str, ...], label: str) -> tuple[dict[str, str], str, str]:
    """Coefficients by Cramer's rule, the intercept, and the unexplained share, over columns of `_products`."""
    whole = _det([[f"c_{a}_{b}" for b in names] for a in names])
    weights = {b: f"{_det([[f'c_{a}_{label}' if c == b else f'c_{a}_{c}' for c in names] for a in names])} / {whole}" for b in names}
    intercept = f"m_{label}" + "".join(f" - {w} * m_{b}" for b, w in weights.items())
    every = [*names, label]
    rest = f"{_det([[f'c_{a}_{b}' for b in every] for a in every])} / ({whole} * c_{label}_{label})"
    return weights, intercept, rest


_INPUTS = ["q", "d", "x"]
_ROWS = "SELECT CAST(l_quantity AS DOUBLE) AS q, CAST(l_discount AS DOUBLE) AS d, CAST(l_tax AS DOUBLE) AS x, ln(CAST(l_extendedprice AS DOUBLE)) AS y FROM lineitem"
_SUBSETS = " UNION ALL ".join(
    f"SELECT n * ln({rest}) + {2 * (len(names) + 1)} AS criterion, [{', '.join(repr(b) for b in [*names, 'intercept'])}] AS term, [{', '.join([*weights.values(), intercept])}] AS value FROM s"
    for k in range(len(_INPUTS) + 1)
    for names in combinations(_INPUTS, k)
    for weights, intercept, rest in [_fit(names, "y")]
)


@query(
    "stepwise_terms",
    sql("", f"SELECT unnest(term) AS term, round(unnest(value), 6) AS coefficient FROM (SELECT * FROM ({_SUBSETS}) ORDER BY criterion LIMIT 1)", {"item": _ROWS, "s": _products(_INPUTS, "y", "item")}),
)
def stepwise_terms(spark, folder):
    """Inputs that a search by steps keeps, with their coefficients; the SQL tries every subset."""
    rows = t.load(spark, folder, "lineitem").select(
        F.col("l_quantity").cast("double").alias("q"), F.col("l_discount").cast("double").alias("d"), F.col("l_tax").cast("double").alias("x"), F.log(F.col("l_extendedprice").cast("double")).alias("y")
    )
    model = selection.stepwise(rows, _INPUTS, F.col("y"), "exp")
    named = [(term.name, weight) for term, weight in zip(model.terms, model.coefficients, strict=True)] + [("intercept", model.intercept)]
    return spark.createDataFrame(named, "term string, coefficient double").withColumn("coefficient", F.round("coefficient", 6))


#: Bends at a quantity of 20 and a discount of 0.05, with a disturbance that depends on neither.
_Q, _D = 20.0, 0.05
_BENT = f"""SELECT CAST(l_quantity AS DOUBLE) AS q, CAST(l_discount AS DOUBLE) AS d, CAST(l_tax AS DOUBLE) AS x,
  5 + 0.3::DOUBLE * greatest(CAST(l_quantity AS DOUBLE) - {_Q}::DOUBLE, 0) - 0.1::DOUBLE * greatest({_Q}::DOUBLE - CAST(l_quantity AS DOUBLE), 0)
    + 60 * greatest(CAST(l_discount AS DOUBLE) - {_D}::DOUBLE, 0) + ((l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 1000 - 499.5::DOUBLE) / 5000 AS y FROM lineitem"""
_HINGED = f"SELECT greatest(q - {_Q}::DOUBLE, 0) AS qa, greatest({_Q}::DOUBLE - q, 0) AS qb, greatest(d - {_D}::DOUBLE, 0) AS da, y FROM bent"
_WEIGHTS, _INTERCEPT, _ = _fit(("qa", "qb", "da"), "y")


@query(
    "spline_terms",
    sql("", f"""SELECT 'q' AS name, {_Q}::DOUBLE AS knot, 1::BIGINT AS side, round({_WEIGHTS["qa"]}, 6) AS coefficient FROM s
      UNION ALL SELECT 'q', {_Q}::DOUBLE, -1::BIGINT, round({_WEIGHTS["qb"]}, 6) FROM s UNION ALL SELECT 'd', {_D}::DOUBLE, 1::BIGINT, round({_WEIGHTS["da"]}, 6) FROM s
      UNION ALL SELECT 'intercept', NULL, NULL, round({_INTERCEPT}, 6) FROM s""", {"bent": _BENT, "hinged": _HINGED, "s": _products(["qa", "qb", "da"], "y", "hinged")}),
)
def spline_terms(spark, folder):
    """Hinges that the search finds among 49 knots of the quantity, 9 of the discount and 7 of the tax; the SQL fits the planted ones."""
    q, d, x = (F.col(c).cast("double") for c in ("l_quantity", "l_discount", "l_tax"))
    noise = ((F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729 + F.col("l_partkey") * 31) % 1000 - 499.5) / 5000
    y = 5 + 0.3 * F.greatest(q - _Q, F.lit(0.0)) - 0.1 * F.greatest(_Q - q, F.lit(0.0)) + 60 * F.greatest(d - _D, F.lit(0.0)) + noise
    rows = t.load(spark, folder, "lineitem").select(q.alias("q"), d.alias("d"), x.alias("x"), y.alias("y"))
    knots = {"q": list(range(1, 50)), "d": [i / 100 for i in range(9)], "x": [i / 100 for i in range(7)]}
    model = selection.splines(rows, ["q", "d", "x"], F.col("y"), knots=knots)
    named = [(term.name, term.knot, term.side, weight) for term, weight in zip(model.terms, model.coefficients, strict=True)]
    return spark.createDataFrame([*named, ("intercept", None, None, model.intercept)], "name string, knot double, side bigint, coefficient double").withColumn("coefficient", F.round("coefficient", 6))


@query(
    "daily_moments",
    sql("", """SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS part, count(*) AS n, round(sum(CAST(o_totalprice AS DOUBLE)), 3) AS total,
      round(sum(CAST(o_totalprice AS DOUBLE) * o_custkey) / 997, 3) AS mixed FROM orders GROUP BY ALL"""),
)
def daily_moments(spark, folder):
    """One row a day that stands for all orders of the day."""
    rows = t.load(spark, folder, "orders")
    table = moments.moments(rows, {"a": F.col("o_totalprice"), "b": F.col("o_custkey")}, F.to_date("o_orderdate"))
    return table.select("part", "n", F.round(F.col("sums")[0], 3).alias("total"), F.round(F.col("products")[1] / 997, 3).alias("mixed"))


@query(
    "pca_carried_moments",
    sql("", """SELECT Date, round(abs((a - ma) / sa + sign(r) * (b - mb) / sb) / sqrt(2), 5) + 0 AS PC1, round(abs((a - ma) / sa - sign(r) * (b - mb) / sb) / sqrt(2), 5) + 0 AS PC2 FROM pair, s""",
        {"pair": _PAIR, "s": _STATS}),
)
def pca_carried_moments(spark, folder):
    """Components fitted from the moments of an earlier run and those of the rows since, as from all rows."""
    rows, path = _pair(spark, folder), work_path(spark, "moments")
    part, columns = (F.col("Date") % 31).cast("bigint"), {"a": F.col("a"), "b": F.col("b")}
    sinks.append(moments.moments(rows.where(part < 20), columns, part), path)
    sinks.append(moments.moments(rows.where(part >= 20), columns, part), path)
    model = moments.components(moments.total(spark.read.parquet(path), ["a", "b"]), 2)
    scored = model.scores(materialize(rows))
    return scored.select("Date", *[(F.round(F.abs(c), 5) + 0).alias(c) for c in ("PC1", "PC2")])

"""Restoration time, number of outages, customers affected, weather profile.

The fitted models of the published pipeline are not available, so each is
trained here with the same inputs, target transformation and output.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgrid import constants as C
from stormgrid.functions import intervals, weather
from stormgrid.models import selection
from stormgrid.session import materialize

SEED = 17


@dataclass(frozen=True)
class Regression:
    """A fitted pipeline with the inverse of its target transformation."""

    model: PipelineModel
    inverse: str
    features: list[str]
    knots: dict[str, list[float]] = field(default_factory=dict)

    def predict(self, df: DataFrame, output: str) -> DataFrame:
        """Every row with its forecast, null where an input is missing."""
        hinged = with_hinges(df, self.knots)
        scored = self.model.transform(with_inputs(hinged, self.features))
        value = F.exp("_prediction") if self.inverse == "exp" else F.pow("_prediction", F.lit(3.0))
        return scored.select(*df.columns, F.when(F.col("_complete"), value).alias(output))


def with_inputs(df: DataFrame, features: list[str]) -> DataFrame:
    """`_inputs` array of the features, missing ones as 0, and whether none is missing (`_complete`)."""
    values = [F.col(f).cast("double") for f in features]
    known = F.lit(True)
    for v in values:
        known = known & v.isNotNull() & ~F.isnan(v)
    filled = F.array(*[F.when(v.isNull() | F.isnan(v), 0.0).otherwise(v) for v in values])
    return df.withColumns({"_inputs": array_to_vector(filled), "_complete": known})


def _fit(df: DataFrame, features: list[str], label: Column, estimator, inverse: str, knots: dict | None = None) -> Regression:
    """Fits on the rows with all inputs and a label."""
    learner = estimator.setFeaturesCol("_inputs").setLabelCol("_label").setPredictionCol("_prediction")
    labelled = df.withColumn("_label", label).where(F.col("_label").isNotNull() & ~F.isnan("_label"))
    # Fitting passes over its rows many times.
    rows = materialize(with_inputs(labelled, features).where("_complete").select("_inputs", "_label"), "no row has all inputs and a label")
    return Regression(Pipeline(stages=[learner]).fit(rows), inverse, features, knots or {})


def fit_restoration(df: DataFrame, features: list[str], target: str = "TTR", trees: int = 40, depth: int = 8, bootstrap: bool = True) -> Regression:
    """Random forest on the log of the duration."""
    forest = RandomForestRegressor(numTrees=trees, maxDepth=depth, seed=SEED, bootstrap=bootstrap)
    return _fit(df.where(F.col(target) > 0), features, F.log(target), forest, "exp")


def fit_outage_count(df: DataFrame, features: list[str], target: str = "OUTAGES", ridge: float = 1e-3) -> Regression:
    """Linear regression on the log of the number of outages."""
    return _fit(df.where(F.col(target) > 0), features, F.log(target), LinearRegression(regParam=ridge), "exp")


def choose_outage_inputs(df: DataFrame, features: list[str], target: str = "OUTAGES") -> selection.Chosen:
    """Linear regression on the log of the number of outages, on the inputs that a stepwise search keeps."""
    return selection.stepwise(df.where(F.col(target) > 0), features, F.log(target), "exp")


def choose_customer_hinges(df: DataFrame, features: list[str] = C.CUSTOMER_MODEL_FEATURES, target: str = "CUST_QTY") -> selection.Chosen:
    """Additive splines on the cube root, with knots and terms chosen by search."""
    return selection.splines(df, features, F.cbrt(target), "cube")


def with_hinges(df: DataFrame, knots: dict[str, list[float]]) -> DataFrame:
    """max(0, x - k) at the given knots; with x itself they span all lines that bend there. A missing x stays missing."""
    columns = {}
    for name, values in knots.items():
        for i, knot in enumerate(values):
            above = F.col(name) - knot
            columns[f"_{name}_up{i}"] = F.when(above > 0, above).when(above <= 0, 0.0)
    return df.withColumns(columns) if columns else df


def fit_customers(df: DataFrame, features: list[str] = C.CUSTOMER_MODEL_FEATURES, target: str = "CUST_QTY", quantiles: tuple[float, ...] = (0.33, 0.67), ridge: float = 1e-2, knots: dict[str, list[float]] | None = None) -> Regression:
    """Piecewise-linear regression on the cube root, with hinges at given knots or at quantiles of each input."""
    if knots is None:
        marks = df.approxQuantile(features, list(quantiles), 0.001)
        knots = {name: sorted(set(values)) for name, values in zip(features, marks)}
    hinged = with_hinges(df, knots)
    inputs = [c for c in hinged.columns if c not in df.columns]
    return _fit(hinged, [*features, *inputs], F.cbrt(target), LinearRegression(regParam=ridge), "cube", knots)


def forecast_outages(model: Regression | selection.Chosen, scores: DataFrame) -> DataFrame:
    predicted = model.predict(scores, "predicted_Number_of_OUTAGES").select("Date", "predicted_Number_of_OUTAGES")
    low, high = intervals.outage_interval(F.col("predicted_Number_of_OUTAGES"))
    return predicted.withColumns({"Outages_LL_95": low, "Outages_UL_95": high})


def forecast_customers(model: Regression | selection.Chosen, days: DataFrame) -> DataFrame:
    predicted = model.predict(days, "Predicted_Cust_Qty").select("Date", F.bround("Predicted_Cust_Qty", 0).alias("Predicted_Cust_Qty"))
    low, high = intervals.customer_interval(F.col("Predicted_Cust_Qty"))
    return predicted.withColumns({"Customers_LL_95": low, "Customers_UL_95": high})


@dataclass(frozen=True)
class ProfileModel:
    """A fitted classifier with the names of its inputs."""

    model: PipelineModel
    features: list[str]


def fit_profiles(df: DataFrame, features: list[str], label: str = "clusters", trees: int = 40, depth: int = 6, bootstrap: bool = True) -> ProfileModel:
    """Random forest over the six weather profiles, in their fixed order; fitted on the rows with all inputs."""
    stages = [
        StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc", handleInvalid="skip"),
        RandomForestClassifier(featuresCol="_inputs", labelCol="_label", numTrees=trees, maxDepth=depth, seed=SEED, bootstrap=bootstrap),
    ]
    rows = with_inputs(df.where(F.col(label).isin(list(C.PROFILES))), features).where("_complete")
    return ProfileModel(Pipeline(stages=stages).fit(materialize(rows.select("_inputs", label), "no labelled row has all inputs")), features)


def classify_profiles(model: ProfileModel, df: DataFrame, keep: list[str]) -> DataFrame:
    """Most and second most probable profile of every row, with all six probabilities.

    A row that lacks an input stays, with null in place of all of them.
    """
    labels = model.model.stages[0].labels
    scorer = PipelineModel(stages=model.model.stages[1:])
    named = IndexToString(inputCol="prediction", outputCol="_named", labels=labels)
    scored = named.transform(scorer.transform(with_inputs(df.drop("clusters"), model.features)))
    scored = scored.withColumn("clusters", F.when(F.col("_complete"), F.col("_named")))
    known = vector_to_array("probability")
    shares = [F.when(F.col("_complete"), known[labels.index(name)] if name in labels else F.lit(0.0)) for name in C.PROFILES]
    table = scored.select(
        *keep, "clusters", F.when(F.col("_complete"), weather.profile_text(F.col("clusters"))).alias("profile"), F.array(*shares).alias("_p"),
        *[share.alias(f"prob_{name}") for name, share in zip(C.PROFILES, shares)],
    )
    second = table.withColumn("_s", weather.second_best(F.col("_p")))
    known = F.col("clusters").isNotNull()
    return second.withColumns(
        {"profile_desc2": F.when(known, weather.profile_text_by_index(F.col("_s.index"))), "prob_2": F.when(known, F.col("_s.prob"))}
    ).drop("_s", "_p")

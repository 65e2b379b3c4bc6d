"""Standardising and principal components of the wide weather rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import PCA, PCAModel, StandardScaler, StandardScalerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

COMPONENTS = 7


def zscores(df: DataFrame, columns: list[str], reference: DataFrame | None = None) -> DataFrame:
    """(x - mean) / sample deviation, with the figures of `reference` (default: of the rows themselves)."""
    basis = df if reference is None else reference
    stats = basis.agg(*[F.avg(c).alias(f"_m_{c}") for c in columns], *[F.stddev_samp(c).alias(f"_s_{c}") for c in columns])
    scaled = {c: F.try_divide(F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}")) for c in columns}
    return df.crossJoin(F.broadcast(stats)).select(*[scaled.get(c, F.col(c)).alias(c) for c in df.columns])  # one row


def as_vectors(df: DataFrame, features: list[str]) -> DataFrame:
    """`_raw` vector of the features, from one array column or columns taken by name, and whether none is missing (`_complete`)."""
    values = F.col("features") if "features" in df.columns else F.array(*[F.col(f).cast("double") for f in features])
    missing = lambda v: v.isNull() | F.isnan(v)
    filled = F.transform(values, lambda v: F.when(missing(v), 0.0).otherwise(v))
    # An array that is null or of another length lacks inputs as well.
    whole = F.coalesce((F.size(values) == len(features)) & ~F.exists(values, missing), F.lit(False))
    zeros = F.array_repeat(F.lit(0.0), len(features))
    return df.withColumns({"_raw": array_to_vector(F.when(F.size(values) == len(features), filled).otherwise(zeros)), "_complete": whole})


@dataclass(frozen=True)
class ComponentModel:
    features: list[str]
    scaler: StandardScalerModel
    pca: PCAModel
    signs: list[float]

    def scores(self, df: DataFrame, key: str = "Date") -> DataFrame:
        """PC1..PCk of every row, null where an input is missing."""
        scored = self.pca.transform(self.scaler.transform(as_vectors(df, self.features)))
        values = vector_to_array("_pc")
        return scored.select(key, *[F.when(F.col("_complete"), values[i] * sign).alias(f"PC{i + 1}") for i, sign in enumerate(self.signs)])

    def variance(self, spark: SparkSession) -> DataFrame:
        """Explained share per component and the running percentage (k rows)."""
        shares = [(i + 1, float(v)) for i, v in enumerate(self.pca.explainedVariance)]
        rows = spark.createDataFrame(shares, "component int, share double")
        running = F.sum(F.bround("share", 3) * 100).over(Window.orderBy("component"))
        return rows.withColumn("running_percent", running)


def fit_components(df: DataFrame, features: list[str], k: int = COMPONENTS) -> ComponentModel:
    """Fits scaler and components; the largest loading of each component is made positive.

    The covariance is a features x features sum over all rows: its size does not
    depend on the number of days.
    """
    vector = as_vectors(df, features).where("_complete").select("_raw")
    scaler = StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True).fit(vector)
    pca = PCA(k=k, inputCol="_scaled", outputCol="_pc").fit(scaler.transform(vector))
    loadings = pca.pc.toArray()
    signs = [1.0 if column[abs(column).argmax()] >= 0 else -1.0 for column in loadings.T]
    return ComponentModel(features, scaler, pca, signs)

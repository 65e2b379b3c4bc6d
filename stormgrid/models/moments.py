"""Counts, sums and cross products that merge.

A row of a moments table stands for many rows of data: how many they are, the sum
of each column, and the sum of each product of two columns (upper triangle by
rows). Parts add up, so a run that keeps one row for each day reads those instead
of the history, and means, covariances, components and regressions come from the
total, whose size depends on the number of columns alone.

Each task adds up its own rows; partial sums of one part meet in `SPREAD` tasks first
and then in one, where they are added as they stream in.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPREAD = 16
#: Parts whose sums a task holds at a time.
PARTS_HELD = 64


@dataclass(frozen=True)
class Total:
    names: list[str]
    n: int
    sums: np.ndarray
    products: np.ndarray

    @property
    def means(self) -> np.ndarray:
        return self.sums / self.n

    @property
    def centred(self) -> np.ndarray:
        """Sums of products of deviations from the means."""
        return self.products - np.outer(self.sums, self.sums) / self.n

    def covariance(self) -> np.ndarray:
        return self.centred / (self.n - 1)


def _schema(part: T.DataType) -> T.StructType:
    doubles = T.ArrayType(T.DoubleType())
    return T.StructType([T.StructField("part", part), T.StructField("n", T.LongType()), T.StructField("sums", doubles), T.StructField("products", doubles)])


def moments(df: DataFrame, columns: dict[str, Column], part: Column | None = None) -> DataFrame:
    """One row per part (all rows without one): part, n, sums, products. Rows that lack a value do not count."""
    width = len(columns)
    upper = np.triu_indices(width)
    values = F.array(*[c.cast("double") for c in columns.values()])
    rows = df.select((F.lit(0) if part is None else part).alias("part"), values.alias("values"))
    rows = rows.where(~F.exists("values", lambda v: v.isNull() | F.isnan(v)))
    schema = _schema(rows.schema["part"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[object, list] = {}

        def flushed() -> pa.RecordBatch:
            kind = held_type
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(held), kind), pa.array([h[0] for h in held.values()], pa.int64()), *[pa.array([h[i].tolist() for h in held.values()], pa.list_(pa.float64())) for i in (1, 2)]],
                names=["part", "n", "sums", "products"],
            )
            held.clear()
            return batch

        for batch in batches:
            held_type = batch.schema.field(0).type
            matrix = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            keys, which = np.unique(np.array([str(k) for k in batch.column(0).to_pylist()]), return_inverse=True)
            names = batch.column(0).to_pylist()
            for i in range(len(keys)):
                mine = np.flatnonzero(which == i)
                own, name = matrix[mine], names[mine[0]]
                if name not in held and len(held) >= PARTS_HELD:
                    yield flushed()
                total = held.setdefault(name, [0, np.zeros(width), np.zeros(len(upper[0]))])
                total[0] += len(own)
                total[1] += own.sum(axis=0)
                total[2] += (own.T @ own)[upper]
        if held:
            yield flushed()

    return merged(rows.mapInArrow(run, schema))


def merged(parts: DataFrame, part: Column | None = None) -> DataFrame:
    """Adds up the rows of each part (or of what `part` makes of it)."""
    named = parts if part is None else parts.withColumn("part", part)
    schema = _schema(named.schema["part"].dataType)

    def add(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, sums, products = 0, 0.0, 0.0
        for batch in batches:
            n += int(batch["n"].sum())
            for s, p in zip(batch["sums"], batch["products"], strict=True):
                sums, products = sums + np.asarray(s), products + np.asarray(p)
        yield pd.DataFrame({"part": [key[0]], "n": [n], "sums": [sums], "products": [products]})

    salted = named.withColumn("_salt", F.spark_partition_id() % SPREAD)
    first = salted.groupBy("part", "_salt").applyInPandas(add, schema)
    return first.groupBy("part").applyInPandas(add, schema)


def total(parts: DataFrame, names: list[str]) -> Total:
    """The sum of all parts, whose size is the square of the number of columns."""
    row = merged(parts.select("part", "n", "sums", "products"), F.lit(0)).first()
    width = len(names)
    products = np.zeros((width, width))
    if row is None:
        return Total(names, 0, np.zeros(width), products)
    products[np.triu_indices(width)] = row.products
    return Total(names, row.n, np.array(row.sums), products + np.triu(products, 1).T)


@dataclass(frozen=True)
class Components:
    """Scaler and principal components that a total of moments gives."""

    names: list[str]
    means: np.ndarray
    deviations: np.ndarray
    loadings: np.ndarray
    shares: np.ndarray

    def scores(self, df: DataFrame, key: str = "Date") -> DataFrame:
        """PC1..PCk of every row, null where an input is missing."""
        columns = []
        for i, weights in enumerate((self.loadings / self.deviations[:, None]).T):
            score = F.lit(float(-(weights @ self.means)))
            for name, weight in zip(self.names, weights, strict=True):
                score = score + F.nanvl(F.col(name).cast("double"), F.lit(None)) * F.lit(float(weight))
            columns.append(score.alias(f"PC{i + 1}"))
        return df.select(key, *columns)


def components(whole: Total, k: int) -> Components:
    """The `k` first components of the standardised columns; the largest loading of each is positive."""
    covariance = whole.covariance()
    deviations = np.sqrt(np.diag(covariance))
    values, vectors = np.linalg.eigh(covariance / np.outer(deviations, deviations))
    order = np.argsort(values)[::-1]
    vectors = vectors[:, order[:k]]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), range(vectors.shape[1])] < 0, -1.0, 1.0)
    return Components(whole.names, whole.means, deviations, vectors, values[order][:k] / values.sum())

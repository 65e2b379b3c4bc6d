"""Named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormgrid.session import use_utc


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    """Column types both engines print alike: bigint, double and text."""
    def convert(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(column, "yyyy-MM-dd").alias(field.name)
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.BooleanType)):
            return column.cast("bigint").alias(field.name)
        return column

    return df.select(*[convert(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None):
    def register(function):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return portable(function(use_utc(spark), folder))

        run.__name__ = function.__name__
        run.__doc__ = function.__doc__
        REGISTRY[name] = Query(name, run, sql)
        return function

    return register

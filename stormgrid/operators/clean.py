"""Row filters, gates and column hygiene."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgrid import constants as C


def drop_junk_columns(df: DataFrame, pattern: str = C.JUNK_COLUMNS) -> DataFrame:
    """Leaves out index columns that writers add to CSV files."""
    return df.drop(*[name for name in df.columns if re.search(pattern, name)])


def underscore_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.replace(".", "_") for name in df.columns])


def has_customers() -> Column:
    return F.col("DOWNSTREAM_CUST_QTY") > 0


def connected_station() -> Column:
    return F.col("EQUIP_STN_NO") != C.NON_CONNECTED_STATION


def complete_keys() -> Column:
    return (
        (F.col("CIRCT_ID") != 0) & F.col("STRCTUR_NO").isNotNull() & F.col("DNI_EQUIP_TYPE").isNotNull()
    )


def outage_clue() -> Column:
    clue = F.col("CLUE_CD")
    return clue.startswith("0") & ~clue.startswith("00") & ~clue.isin(C.EXCLUDED_CLUES)


def wanted_occurrence(excluded: list[int] = C.EXCLUDED_OCCURRENCES) -> Column:
    """A missing occurrence code stays in."""
    return F.coalesce(~F.col("OCCURN_CD").isin(excluded), F.lit(True))


OUTAGE_STAGES = {
    "customers": has_customers,
    "station": connected_station,
    "keys": complete_keys,
    "clue": outage_clue,
    "occurrence": wanted_occurrence,
}


def outage_rows(df: DataFrame) -> DataFrame:
    """Keeps the rows that describe a real outage; all predicates reach the scan."""
    for rule in OUTAGE_STAGES.values():
        df = df.where(rule())
    return df


def stage_counts(df: DataFrame) -> DataFrame:
    """Rows left after each successive filter stage, from one pass over the input."""
    passed, columns = F.lit(True), {"input": F.lit(True)}
    for name, rule in OUTAGE_STAGES.items():
        passed = passed & F.coalesce(rule(), F.lit(False))
        columns[name] = passed
    counts = df.agg(*[F.count_if(flag).alias(name) for name, flag in columns.items()])
    return counts.select(F.posexplode(F.map_entries(F.create_map(
        *[piece for name in columns for piece in (F.lit(name), F.col(name))]
    )))).select(F.col("pos").cast("bigint").alias("stage_no"), F.col("col.key").alias("stage"), F.col("col.value").alias("rows_left"))


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Raises when the input is empty; reads at most one row to find out."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def without_power() -> Column:
    """No restoration time; 1900-01-01 stands for 'none'."""
    energised = F.to_date("ENERGIZED_DATETIME")
    return energised.isNull() | (energised == F.lit("1900-01-01").cast("date"))


def still_out(df: DataFrame) -> DataFrame:
    """Outages without a restoration time."""
    return df.where(without_power())


def drop_any_null(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def negative_to_null(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.when(F.col(name) >= 0, F.col(name)))


def default_columns(df: DataFrame) -> DataFrame:
    """Customer quantity under both names, and the downstream rating as the rating."""
    if "DOWNSTREAM_CUST_QTY" not in df.columns:
        df = df.withColumn("DOWNSTREAM_CUST_QTY", F.col("CUST_QTY"))
    return df.withColumn("KVA_VAL", F.col("DOWNSTREAM_KVA_VAL"))

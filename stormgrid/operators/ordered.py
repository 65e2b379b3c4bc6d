"""Order-dependent operators (ranks, forward fill) without a single-task window.

The common step range-partitions rows by the order, so every task holds one
contiguous run of it, and materialises that layout in the shared folder. Each
run is then scanned on its own and a summary with one row per run (as many rows
as there are partitions) carries the state from run to run.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormgrid.session import materialize

# A value is hot when it holds at least this share of all rows: 1/share values at most.
HOT_SHARE = 1000
SALTS = 64
#: Number of a row of a stored table (`numbered`).
ROW = "_row"


def runs(df: DataFrame, order: list[Column], partitions: int | None = None) -> DataFrame:
    """Rows with the number (`_run`) of the contiguous run of the order they belong to.

    Without a given number, adaptive execution merges neighbouring runs to its target size.
    """
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return materialize(ranged.withColumn("_run", F.spark_partition_id()), codec="zstd")


def _before(summary: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Values accumulated over all earlier runs; the input has one row per partition."""
    earlier = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(summary.select("_run", *[c.over(earlier).alias(name) for name, c in columns.items()]))


def value_ranks(df: DataFrame, key: str, descending: bool = False, partitions: int | None = None) -> DataFrame:
    """One row per distinct non-null value: rows of it, dense rank, and rows up to and including it."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    order = F.col(key).desc() if descending else F.col(key).asc()
    laid_out = runs(counts, [order], partitions)
    within = Window.partitionBy("_run").orderBy(order)
    totals = laid_out.groupBy("_run").agg(F.count("*").alias("_values"), F.sum("_n").alias("_rows"))
    offsets = _before(totals, {"_v0": F.sum("_values"), "_r0": F.sum("_rows")})
    return (
        laid_out.withColumns({"_dense": F.row_number().over(within), "_upto": F.sum("_n").over(within)})
        .join(offsets, "_run")
        .select(
            key,
            "_n",
            (F.col("_dense") + F.coalesce("_v0", F.lit(0))).cast("bigint").alias("_dense"),
            (F.col("_upto") + F.coalesce("_r0", F.lit(0))).cast("bigint").alias("_upto"),
        )
    )


def attach_by_value(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Left join of a lookup with one row per key (`_n` = rows of `df` with that key).

    Rows of hot keys take their values from a broadcast of the hot part, which by
    its definition has at most HOT_SHARE rows. They, and rows without a key, which
    find nothing, are salted so that the shuffle of the remaining join spreads them.
    """
    fields = [c for c in lookup.columns if c not in (key, "_n")]
    total = F.broadcast(lookup.agg(F.sum("_n").alias("_all")))
    hot = (
        lookup.join(total, F.col("_n") * HOT_SHARE >= F.col("_all"))
        .select(F.col(key).alias("_hot_key"), *[F.col(c).alias(f"_hot{c}") for c in fields])
    )
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)) + 1
    salted = df.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left").withColumn(
        "_salt", F.when(F.col("_hot_key").isNotNull() | F.col(key).isNull(), spread).otherwise(F.lit(0).cast("bigint"))
    )
    # Always 0, but a literal would make the optimizer take the salt out of the join's keys.
    cold = lookup.drop("_n").withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(1)))
    joined = salted.join(cold, [key, "_salt"], "left")
    return joined.select(*[F.col(c) for c in df.columns], *[F.coalesce(f"_hot{c}", c).alias(c) for c in fields])


def dense_rank_of(df: DataFrame, key: str, name: str, descending: bool = False, partitions: int | None = None) -> DataFrame:
    """Dense rank over the whole table; a missing value has no rank.

    Like the other ranks it reads `df` twice, to count the values and to attach the
    ranks: the caller stores a costly input (or one whose values might differ when
    computed again) first.
    """
    ranks = value_ranks(df, key, descending, partitions).drop("_upto")
    return attach_by_value(df, ranks, key).withColumnRenamed("_dense", name)


def max_rank_of(df: DataFrame, key: str, name: str, partitions: int | None = None) -> DataFrame:
    """Ascending rank over the whole table where ties share the highest position."""
    ranks = value_ranks(df, key, False, partitions).drop("_dense")
    return attach_by_value(df, ranks, key).withColumnRenamed("_upto", name)


def day_ranks(df: DataFrame, ts: str, partitions: int | None = None) -> DataFrame:
    """One row per different time: rows of it, and its dense rank within its date.

    The global dense rank less the first one of the date: a date with most of the
    rows is no single group. The per-date table is broadcast: it cannot outgrow
    the calendar (a century has 36 525 days).
    """
    ranks = value_ranks(df, ts, False, partitions).drop("_upto").withColumn("_day", F.to_date(ts))
    first = ranks.groupBy("_day").agg(F.min("_dense").alias("_first"))
    return ranks.join(F.broadcast(first), "_day").select(ts, "_n", (F.col("_dense") - F.col("_first") + 1).alias("_dense"))


def rank_within_day(df: DataFrame, ts: str, name: str, partitions: int | None = None) -> DataFrame:
    """Dense rank by time within its date."""
    return attach_by_value(df, day_ranks(df, ts, partitions), ts).withColumnRenamed("_dense", name)


def _filled_within(columns: list[str]):
    """Fills the gaps of a partition's ordered rows from those before them, and numbers the rows (`_place`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, start = {}, 0
        for batch in batches:
            arrays = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            for name in columns:
                values = arrays[name]
                if values.null_count:
                    values = pc.fill_null_forward(values)
                    if values.null_count and name in last:
                        values = values.fill_null(last[name])
                if len(values) and values[-1].is_valid:
                    last[name] = values[-1]
                arrays[name] = values
            arrays["_place"] = pa.array(range(start, start + batch.num_rows), pa.int64())
            start += batch.num_rows
            yield pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))

    return run


def forward_fill(df: DataFrame, columns: list[str], order: list[str], partitions: int | None = None, keep: list[str] | None = None) -> DataFrame:
    """Missing values take the last known one before them in the given (total) order.

    One range shuffle brings the rows into order; each run fills itself as it is
    stored, with only the columns to `keep` (all of them by default). What is still
    missing stands before the first known value of its run and takes the one that
    earlier runs hand on, a single row for each run.
    """
    keys = [F.col(c).asc() for c in order]
    kept = df.columns if keep is None else keep
    ranged = (df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)).sortWithinPartitions(*keys)
    rows = ranged.select(*kept, F.spark_partition_id().alias("_run"))
    schema = T.StructType([*rows.schema.fields, T.StructField("_place", T.LongType())])
    laid_out = materialize(rows.mapInArrow(_filled_within([c for c in columns if c in kept]), schema), codec="zstd")
    known = {f"_last_{c}": F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_place"))) for c in columns}
    summary = laid_out.groupBy("_run").agg(*[value.alias(name) for name, value in known.items()])
    carried = _before(summary, {f"_carry_{c}": F.last(f"_last_{c}", ignorenulls=True) for c in columns})
    filled = {c: F.coalesce(c, f"_carry_{c}").alias(c) for c in columns}
    return laid_out.join(carried, "_run").select(*[filled.get(c, F.col(c)) for c in kept])


def numbered(df: DataFrame, gate: str | None = None) -> DataFrame:
    """Stores a table with a number (`ROW`) of its own for every row.

    Steps then move the number with the few columns they need, and what they find is
    joined to the stored rows by it: joins on `ROW` in a row share one shuffle.
    """
    return materialize(df.drop(ROW).withColumn(ROW, F.monotonically_increasing_id()), gate, "zstd")


def gap_values(df: DataFrame, columns: list[str], order: list[str], partitions: int | None = None) -> DataFrame | None:
    """What `forward_fill` puts into a numbered table: `ROW` and the columns that have gaps, for rows with one.

    Columns without a missing value, or with nothing else, stay as they are, so only
    the others are laid out by the order. None if there are no such columns.
    """
    counts = df.agg(F.count(F.lit(1)).alias("_all"), *[F.count(c).alias(c) for c in columns]).first()
    open_ones = [c for c in columns if 0 < counts[c] < counts["_all"]]
    if not open_ones:
        return None
    lacks = F.lit(False)
    for c in open_ones:
        lacks = lacks | F.col(c).isNull()
    narrow = df.select(ROW, *order, *open_ones, lacks.alias("_lacks"))
    return materialize(forward_fill(narrow, open_ones, order, partitions, [ROW, *open_ones, "_lacks"]).where("_lacks").drop("_lacks"), codec="zstd")


def with_gap_values(df: DataFrame, found: DataFrame | None) -> DataFrame:
    """A numbered table with its gaps filled by `gap_values`."""
    if found is None:
        return df
    names = [c for c in found.columns if c != ROW]
    renamed = found.select(ROW, *[F.col(c).alias(f"_gap_{c}") for c in names])
    joined = df.join(renamed, ROW, "left")
    return joined.select(*[F.coalesce(c, f"_gap_{c}").alias(c) if c in names else F.col(c) for c in df.columns])


def exact_median(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Exact median of a column of any size, as a one-row table, from the ranked distinct values."""
    ranks = value_ranks(df, key, False, partitions)
    total = F.broadcast(ranks.agg(F.sum("_n").alias("_all")))
    start, stop = F.col("_upto") - F.col("_n") + 1, F.col("_upto")
    low, high = F.floor((F.col("_all") + 1) / 2), F.floor((F.col("_all") + 2) / 2)
    return ranks.join(total, (stop >= low) & (start <= high)).agg(
        ((F.min(key) + F.max(key)) / 2.0).alias("median")
    )


def grouped_quantiles(df: DataFrame, group: str, key: str, shares: dict[str, float], partitions: int | None = None) -> DataFrame:
    """Exact quantiles (linear between neighbours) of every group, as columns named by `shares`.

    Equal values are counted first; the different (group, value) pairs are laid out
    in runs, so a group of any size spreads over many tasks, and each run knows from
    one row per run and group how many of the group's rows stand before it.
    A group of nulls has no quantile.
    """
    counts = df.groupBy(group, key).agg(F.count("*").alias("_n"))
    laid_out = runs(counts, [F.asc_nulls_first(group), F.asc_nulls_first(key)], partitions)
    pieces = laid_out.groupBy("_run", F.col(group).alias("_group")).agg(F.sum(F.when(F.col(key).isNotNull(), F.col("_n"))).alias("_rows"))
    all_of = Window.partitionBy("_group")
    earlier = F.sum("_rows").over(all_of.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.select("_run", "_group", F.coalesce(earlier, F.lit(0)).alias("_before"), F.sum("_rows").over(all_of).alias("_all"))
    within = Window.partitionBy("_run", group).orderBy(F.asc_nulls_first(key))
    known = F.when(F.col(key).isNotNull(), F.col("_n")).otherwise(0)
    placed = laid_out.withColumn("_upto", F.sum(known).over(within)).join(pieces.withColumnRenamed("_run", "_r"), (F.col("_run") == F.col("_r")) & F.col(group).eqNullSafe(F.col("_group")))
    stop = F.col("_upto") + F.col("_before")
    start = stop - F.col("_n") + 1

    def at(place: Column) -> Column:
        """The value at a place counted from 1."""
        return F.max(F.when(F.col(key).isNotNull() & (start <= place) & (place <= stop), F.col(key).cast("double")))

    columns, ends = [], []
    for name, share in shares.items():
        exact = (F.col("_all") - 1) * F.lit(float(share)) + 1
        low = F.floor(exact)
        columns += [at(low).alias(f"_low_{name}"), at(F.least(low + 1, F.col("_all"))).alias(f"_high_{name}"), F.max(exact - low).alias(f"_part_{name}")]
        ends.append((F.col(f"_low_{name}") + F.col(f"_part_{name}") * (F.col(f"_high_{name}") - F.col(f"_low_{name}"))).alias(name))
    return placed.groupBy(group).agg(*columns).select(group, *ends)


def grouped_median(df: DataFrame, group: str, key: str, partitions: int | None = None) -> DataFrame:
    """Exact median of every group."""
    return grouped_quantiles(df, group, key, {"median": 0.5}, partitions)

"""The recurring batch runs as bounded Structured Streaming jobs.

Every job reads a file source (so each file is picked up once), stops when the
available files are used up, and keeps its progress under a checkpoint folder.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormgrid import constants as C
from stormgrid.operators import aggregate, joins
from stormgrid.operators.latest import keep_newest, pick_one
from stormgrid.operators.trailing import trailing_counts
from stormgrid.session import EmptyStep
from stormgrid.sources import snapshots


def read_feed(spark: SparkSession, folder: str, schema: T.StructType, glob: str, fmt: str = "csv", files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt).option("pathGlobFilter", glob)
    if fmt == "csv":
        reader = reader.option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def run_each_batch(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", gate: str | None = None) -> None:
    """Runs the handler on each batch, to the end of the available files.

    With a `gate` the feed's rows are counted as the handler reads them, without a job
    of its own, and `EmptyStep` is raised under that name if a run that found files read no row.
    """
    counted: list[int] = []

    def watched(df: DataFrame, batch: int) -> None:
        seen = Observation()
        handle(df.observe(seen, F.count(F.lit(1)).alias("rows")), batch)
        counted.append(seen.get["rows"])

    writer = stream.writeStream.outputMode(mode).foreachBatch(handle if gate is None else watched)
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    if counted and not sum(counted):
        raise EmptyStep(gate)


def append_stream(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Exactly-once append: the file sink records which files belong to a finished batch."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    writer.option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def pick_up_new_files(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Rows of files not seen before, with the name of their file."""
    named = stream.withColumn("source_file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    append_stream(named, out, checkpoint)


# ------------------------------------------------------------ tables kept as batches
def write_batch(df: DataFrame, path: str, batch: int) -> None:
    """Batch rows under their own folder; a repeated batch replaces itself."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """All batches, or those before a given one, so that a repeated batch does not see itself; none is an empty table."""
    full = T.StructType([*(f for f in schema.fields if f.name != "batch"), T.StructField("batch", T.IntegerType())])
    if before is not None and before <= 0:
        return spark.createDataFrame([], full)
    try:
        rows = spark.read.schema(full).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)
    return rows if before is None else rows.where(F.col("batch") < before)


def claim(spark: SparkSession, out: str, checkpoint: str) -> None:
    """Ties an output to the progress folder it began with.

    Batches are numbered by the progress folder. A new one would begin at 0 again
    and overwrite the history of the output, so it is refused.
    """
    owner = f"{out.rstrip('/')}-owner"
    try:
        held = spark.read.text(owner).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        spark.createDataFrame([(checkpoint,)], "value string").coalesce(1).write.text(owner)
        return
    if held != checkpoint:
        raise ValueError(f"{out} belongs to the progress folder {held}, not to {checkpoint}")


def newest_rows(spark: SparkSession, path: str, keys: list[str], by: list[str] | None = None) -> DataFrame:
    """Current content: the row of each key from its latest batch, or the newest by given columns in whichever batch it came."""
    return keep_newest(spark.read.parquet(path), keys, [*(by or []), "batch"]).drop("batch")


def compact(spark: SparkSession, path: str, keys: list[str], target: str) -> None:
    """Rewrites the current content as batch 0 of a new table."""
    write_batch(newest_rows(spark, path, keys), target, 0)


# ------------------------------------------------------------ jobs
def daily_counts(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Running daily counters: each batch adds its sums to the newest earlier ones of the same dates.

    A day counts however late its rows come; a repeated batch sees only the batches
    before it, and so replaces itself. `newest_rows` by date is the current table.
    """
    spark = stream.sparkSession
    claim(spark, out, checkpoint)

    def handle(df: DataFrame, batch: int) -> None:
        sums = aggregate.daily_counters(df)
        before = keep_newest(read_batches(spark, out, sums.schema, before=batch), ["Date"], ["batch"])
        held = before.select("Date", *[F.col(name).alias(f"_{name}") for name in C.DAILY_COUNTERS])
        added = [(F.col(name) + F.coalesce(f"_{name}", F.lit(0))).alias(name) for name in C.DAILY_COUNTERS]
        write_batch(sums.join(held, "Date", "left").select("Date", *added), out, batch)

    run_each_batch(stream, handle, checkpoint, gate="no row in the feed of daily counts")


def not_yet_predicted(stream: DataFrame, predictions: DataFrame, out: str, checkpoint: str, key: str = "OUTAGE_ID", ts: str = "CREATION_DATETIME") -> None:
    """Outages without a prediction, each passed on once, however old it is when it comes.

    A batch leaves out the predicted ids and those that earlier batches passed on;
    of several rows of one id within a batch the oldest passes.
    """
    spark = stream.sparkSession
    claim(spark, out, checkpoint)

    def handle(df: DataFrame, batch: int) -> None:
        passed = read_batches(spark, out, df.schema, before=batch).select(key)
        fresh = joins.not_yet_predicted(df, predictions).join(passed, key, "left_anti")
        write_batch(pick_one(fresh, [key], [F.col(ts).asc_nulls_last()]).select(*df.columns), out, batch)

    run_each_batch(stream, handle, checkpoint)


def upsert_batches(stream: DataFrame, out: str, checkpoint: str, keys: list[str], by: list[str]) -> None:
    """Each batch's newest row per key, laid over the earlier batches; a feed without rows raises."""
    claim(stream.sparkSession, out, checkpoint)
    run_each_batch(stream, lambda df, batch: write_batch(keep_newest(df, keys, by), out, batch), checkpoint, gate="no row in the feed of changes")


#: Stand for no time where frames without missing values travel, below and above every time.
NO_TIME, NEVER = -(1 << 62), 1 << 62
#: Entries of the state store. An entry holds all outages whose keys hash to it, so that a task handles many at a time.
KEY_BUCKETS = 2048


def outage_times(stream: DataFrame, history: DataFrame, key: str, ts: str) -> DataFrame:
    """What each batch changes: key, live, first and event (microseconds), and what they were before.

    `first` is the earliest live time, `event` the historical time or else the latest
    live one. The state of an outage lies in Spark's state store in the bucket of its
    key, so a batch opens the buckets of the keys it brings and no others; the keys of
    a bucket are brought up to date as one table.
    """
    kind = stream.schema[key].dataType.simpleString()

    def tagged(df: DataFrame, past: bool) -> DataFrame:
        at, none = F.coalesce(F.unix_micros(ts), F.lit(NO_TIME)), F.lit(NO_TIME)
        first = F.lit(NEVER) if past else F.coalesce(F.unix_micros(ts), F.lit(NEVER))
        return df.select(
            F.col(key).cast("string").alias("key"), F.lit(not past).alias("live"), first.alias("first"), (none if past else at).alias("last"), F.lit(past).alias("past"), (at if past else none).alias("known")
        )

    rows = tagged(stream, False).unionByName(tagged(history, True)).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(KEY_BUCKETS)).cast("int"))
    shape = pa.schema([("key", pa.string()), ("live", pa.bool_()), ("first", pa.int64()), ("last", pa.int64()), ("past", pa.bool_()), ("known", pa.int64())])
    least = {"first": "min"}

    def reduced(tables: list[pa.Table]) -> pa.Table:
        whole = pa.concat_tables(tables)
        values = [c for c in whole.column_names if c != "key"]
        return whole.group_by("key", use_threads=False).aggregate([(c, least.get(c.removeprefix("old_"), "max")) for c in values]).rename_columns({f"{c}_{least.get(c.removeprefix('old_'), 'max')}": c for c in values}).select(whole.column_names)

    def beside(table: pa.Table, old: pa.Table | None) -> pa.Table:
        """Rows with the values they had before (none) and whether the batch brings them."""
        for c in shape.names[1:]:
            none = pa.array(np.full(len(table), NEVER if c == "first" else NO_TIME)) if shape.field(c).type == pa.int64() else pa.array(np.zeros(len(table), dtype=bool))
            table = table.append_column(f"old_{c}", none if old is None else old.column(c))
        return table.append_column("new", pa.array(np.full(len(table), old is None)))

    def update(_: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        held = pa.ipc.open_stream(state.get[0]).read_all() if state.exists else shape.empty_table()
        # Reduced batch by batch: a key with many rows needs no more room than another.
        found = [reduced([pa.Table.from_pandas(batch[shape.names], shape, preserve_index=False)]) for batch in batches]
        whole = reduced([beside(held, held), *[beside(t, None) for t in found]])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, shape) as writer:
            writer.write_table(whole.select(shape.names))
        state.update((sink.getvalue().to_pybytes(),))
        changed = whole.filter(whole.column("new"))
        value = {c: changed.column(c).to_numpy() for c in changed.column_names if c != "key"}
        yield pd.DataFrame(
            {"key": changed.column("key").to_pandas()}
            | {
                f"{old}{name}": made
                for old in ("", "old_")
                for name, made in (
                    ("live", value[f"{old}live"]),
                    ("first", np.where(value[f"{old}first"] == NEVER, NO_TIME, value[f"{old}first"])),
                    ("event", np.where(value[f"{old}past"], value[f"{old}known"], value[f"{old}last"])),
                )
            }
        )

    out = "key string, live boolean, first bigint, event bigint, old_live boolean, old_first bigint, old_event bigint"
    changes = rows.groupBy("bucket").applyInPandasWithState(update, out, "keys binary", "update", "NoTimeout")
    return changes.withColumns({"key": F.col("key").cast(kind)} | {c: F.when(F.col(c) != NO_TIME, F.col(c)) for c in ("first", "event", "old_first", "old_event")})


#: Part of outages whose time is not known.
NO_DAY = "none"


def trailing_count_batches(stream: DataFrame, history: DataFrame, out: str, checkpoint: str, key: str = "OUTAGE_ID", ts: str = "CREATION_DATETIME", hours: int = C.TRAILING_HOURS) -> None:
    """Trailing-hour counts that end at the answer for all rows at once.

    The times of live outages, of all known ones, and the counts are kept by day.
    A batch replaces the days on which its outages stand or stood before, counts
    again the live outages of those and of the days up to `hours` after, reads the
    days up to `hours` before these, and no others; all its days take effect in one
    commit. The history is a stream beside the feed, read once. `trailing_table` of
    the output is the current table.
    """
    spark = stream.sparkSession
    claim(spark, out, checkpoint)
    if not history.isStreaming:
        stored = f"{out.rstrip('/')}-history"
        try:
            shape = spark.read.parquet(stored).schema
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            history.select(key, ts).write.parquet(stored)
            shape = spark.read.parquet(stored).schema
        history = spark.readStream.schema(shape).parquet(stored)
    kind = stream.schema[key].dataType.simpleString()
    reach = -(-hours // 24)

    def day_of(micros: str) -> Column:
        return F.coalesce(F.date_format(F.timestamp_micros(micros), "yyyy-MM-dd"), F.lit(NO_DAY))

    def shifted(days: set[str], by: range) -> list[str]:
        dated = {dt.date.fromisoformat(d) for d in days if d != NO_DAY}
        return sorted({(d + dt.timedelta(days=i)).isoformat() for d in dated for i in by})

    def handle(df: DataFrame, batch: int) -> None:
        with snapshots.Transaction(spark, out, f"batch-{batch}") as run:
            if run.done:
                return
            # Stored, so that the state is not asked again by every step.
            df.write.mode("overwrite").parquet(f"{out.rstrip('/')}-changes/batch={batch}")
            changes = spark.read.parquet(f"{out.rstrip('/')}-changes/batch={batch}")
            # At most one row for each day of the calendar and kind.
            stands = {"probe": F.col("live"), "event": F.lit(True)}
            stood = {"probe": F.col("old_live"), "event": F.col("old_event").isNotNull()}
            touched: dict[str, set[str]] = {}
            for name, column in (("probe", "first"), ("event", "event")):
                days = changes.where(stands[name]).select(day_of(column).alias("day")).unionByName(changes.where(stood[name]).select(day_of(f"old_{column}").alias("day")))
                touched[name] = {r.day for r in days.distinct().collect()}
                kept = run.read(name, f"key {kind}, at bigint", sorted(touched[name])).join(changes.select(F.col("key").alias("_key")), F.col("key").eqNullSafe(F.col("_key")), "left_anti")
                new = changes.where(stands[name]).select("key", F.col(column).alias("at"))
                run.replace_parts(name, kept.unionByName(new).withColumn("day", day_of("at")), "day", sorted(touched[name]))
            again = sorted({*touched["probe"], *shifted(touched["event"], range(reach + 1))})
            around = shifted(set(again), range(-reach, 1))

            def times(name: str, days: list[str]) -> DataFrame:
                rows = run.read(name, f"key {kind}, at bigint", days)
                return rows.select(F.col("key").alias(key), F.timestamp_micros("at").alias(ts))

            counts = trailing_counts(times("probe", again), times("event", around), key, ts, hours)
            run.replace_parts("counts", counts.withColumn("day", F.coalesce(F.date_format(ts, "yyyy-MM-dd"), F.lit(NO_DAY))), "day", again)

    run_each_batch(outage_times(stream, history, key, ts), handle, checkpoint, "update")


def trailing_table(spark: SparkSession, out: str, key: T.StructField, ts: str = "CREATION_DATETIME", hours: int = C.TRAILING_HOURS, days: list[str] | None = None) -> DataFrame:
    """The current counts, of all days or some."""
    fields = [key, T.StructField(ts, T.TimestampType()), *[T.StructField(f"Outages_in_last_{k}hr", T.LongType()) for k in range(1, hours + 1)]]
    return snapshots.read(spark, out, "counts", T.StructType(fields), days)

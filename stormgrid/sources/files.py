"""Feed files: typed CSV reads, file listings, newest file per feed, freshness gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormgrid import constants as C
from stormgrid.functions import times
from stormgrid.functions.choose import first_match
from stormgrid.session import materialize

LATIN = "ISO-8859-1"


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, encoding: str = "UTF-8") -> DataFrame:
    """Comma-separated file with a header. Without a schema the types are inferred (an extra pass).

    Index columns a previous writer left in the file belong in the schema: a declared
    schema is matched by position.
    """
    reader = spark.read.option("header", True).option("encoding", encoding)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_facility(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """The daily history is written in Latin-1."""
    return read_csv(spark, path, schema, LATIN)


def with_parsed_times(df: DataFrame, columns: tuple[str, ...] = ("CREATION_DATETIME", "ENERGIZED_DATETIME", "ETR_DATETIME")) -> DataFrame:
    """Text times to timestamps; text that is no time becomes null."""
    return df.withColumns({c: times.parse_timestamp(F.col(c)) for c in columns if c in df.columns})


def list_files(spark: SparkSession, folder: str, glob: str = "*.csv") -> DataFrame:
    """Manifest (path, modified, length) of a folder tree; file contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(folder)
    return files.select("path", F.col("modificationTime").alias("modified"), "length")


def with_feed(manifest: DataFrame) -> DataFrame:
    """Names the feed a path belongs to: the three live ones and the daily history."""
    path = F.col("path")
    historical = path.contains(C.HISTORY_MARK)
    feed = first_match(
        [(path.contains(mark) & ~historical, name) for name, mark in C.LIVE_FEEDS.items()]
        + [(path.contains(C.HISTORY_FEED) & historical, "history")]
    )
    return manifest.withColumn("feed", feed).where(F.col("feed").isNotNull())


def latest_files(manifest: DataFrame, day: str | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """Current file per feed: the last name of a live feed, the first name of the history."""
    feeds = with_feed(manifest)
    if day is not None:
        feeds = feeds.where(F.col("path").contains(day))
    current = F.when(F.col("feed") == "history", F.min("path")).otherwise(F.max("path"))
    return feeds.groupBy(*keys, "feed").agg(current.alias("path"))


def freshness_gate(current: DataFrame, last: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """New data only if every live feed has another file than in the last run (or there was none)."""
    live = F.col("feed").isin(list(C.LIVE_FEEDS))
    on = [*keys, "feed"]
    pairs = current.where(live).join(last.where(live).select(*on, F.col("path").alias("_last")), on, "left")
    same = F.count_if(F.col("path") == F.col("_last"))
    grouped = pairs.groupBy(*keys) if keys else pairs.groupBy()
    return grouped.agg(
        F.count("*").alias("feeds"), same.alias("unchanged"), (same == 0).cast("bigint").alias("is_new")
    )


REJECTS = "file string, reason string, row string"
_ROW = "_row"


def headers(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> DataFrame:
    """First line of every file: file, header."""
    lines = spark.read.option("encoding", encoding).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("nth"), "value"
    )
    return lines.where("start = 0").groupBy("file").agg(F.min_by("value", "nth").alias("header"))


def read_checked(spark: SparkSession, path: str | list[str], schema: T.StructType, encoding: str = "UTF-8") -> tuple[DataFrame, DataFrame]:
    """Rows of comma-separated files that fit the schema, and a table of those that do not.

    A file whose header does not name the schema's columns in order is rejected with
    all its rows (`header`): read by position, its values would stand in other columns.
    A row with a value of another type or another number of columns is rejected by
    itself (`row`) and kept as it was written; rows of a rejected file that could be
    parsed are put together again from their values. Rows are parsed once: both tables
    come from one stored step.
    """
    wanted = ",".join(f.name for f in schema.fields)
    shown = headers(spark, path, encoding)
    # One row for each file.
    wrong = materialize(shown.where(F.lower(F.regexp_replace("header", '[ "\r\ufeff]', "")) != wanted.lower()).select(F.col("file").alias("_wrong")))
    typed = T.StructType([*schema.fields, T.StructField(_ROW, T.StringType())])
    reader = spark.read.schema(typed).option("header", True).option("encoding", encoding).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _ROW).option("enforceSchema", True)
    rows = reader.csv(path).select("*", F.col("_metadata.file_path").alias("_file"))
    stored = materialize(rows.join(wrong, F.col("_file") == F.col("_wrong"), "left"))
    text = F.coalesce(F.col(_ROW), F.concat_ws(",", *[F.coalesce(F.col(f"`{f.name}`").cast("string"), F.lit("")) for f in schema.fields]))
    whole = F.when(F.col("_wrong").isNotNull(), "header").when(F.col(_ROW).isNotNull(), "row")
    rejects = stored.where(whole.isNotNull()).select(F.col("_file").alias("file"), whole.alias("reason"), text.alias("row"))
    return stored.where(whole.isNull()).select(*[f"`{f.name}`" for f in schema.fields]), rejects

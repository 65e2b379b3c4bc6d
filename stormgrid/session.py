"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "stormgrid", cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session used by the tests and the benchmark; a cluster brings its own."""
    session = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("STORMGRID_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        # Recording the call site of every column operation costs more than planning itself.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def use_utc(spark: SparkSession) -> SparkSession:
    """All feed times are zone-less UTC; pin the session zone before casting them."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Only a session in one process (`local`, `local[n]`) may fall back to a temporary
    folder: on a cluster, `local-cluster` included, a machine-local path would not
    survive the loss of that machine. A `file:` folder that the setting names is
    taken as what it is said to be, a mount that all machines share.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="stormgrid-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


#: For rows of megabytes. Parquet looks at sizes every hundred rows only, and keeps least and greatest values until a file is closed.
LARGE_ROWS = {"parquet.enable.dictionary": False, "parquet.column.statistics.enabled": False, "parquet.size.statistics.enabled": False}

#: The folder of the run in progress, below the shared folder.
_RUN: ContextVar[str | None] = ContextVar("run", default=None)


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared folder, or of the run in progress."""
    return f"{_RUN.get() or shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def stored_steps(spark: SparkSession) -> Iterator[str]:
    """A run whose stored steps are removed at its end.

    Steps stored inside go to a folder of the run's own, and only that folder is
    removed, also when the run fails. Results must be written elsewhere before.
    """
    folder = f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"
    token = _RUN.set(folder)
    try:
        yield folder
    finally:
        _RUN.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def dealt_by_part_of_keys(spark: SparkSession) -> Iterator[None]:
    """Joins run in the block take feeds that both are dealt out by some of the keys as they lie.

    Spark shuffles such feeds again by all keys otherwise, against skew.
    """
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class EmptyStep(ValueError):
    """A step that must have rows has none."""


def materialize(df: DataFrame, gate: str | None = None, codec: str | None = None, group_rows: int | None = None) -> DataFrame:
    """Stores a step as a table in the shared folder and reads it back.

    Later reads see the very same rows, need only the columns they use, know the
    size of the table, and survive the loss of any executor. With a `gate` the rows
    are counted while they are written, and `EmptyStep` is raised under that name if
    there are none: no job is run to find out. A `codec` names the compression of the
    stored files, else the session's own. `group_rows` is for rows of megabytes: so
    many of them are held while they are written, and read at a time.
    """
    path = work_path(df.sparkSession, "step")
    seen = Observation()
    write = (df if gate is None else df.observe(seen, F.count(F.lit(1)).alias("rows"))).write
    if group_rows is not None:
        write = write.options(**{"parquet.block.row.count.limit": group_rows}, **LARGE_ROWS)
    write.parquet(path, compression=codec)
    if gate is not None and not seen.get["rows"]:
        raise EmptyStep(gate)
    return df.sparkSession.read.schema(df.schema).parquet(path)

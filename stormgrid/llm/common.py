"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that travel to a Python worker at a time; Spark's own number suits short rows, not whole texts.
BATCH_ROWS = 1024
#: Bytes that travel at a time where single rows are large.
BATCH_BYTES = 4 << 20
#: Text bytes handled at a time inside a task; a single longer row is handled alone.
SLICE_BYTES = 2 << 20


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row, also when `body` uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def share(spark: SparkSession, value: object) -> Callable[[], object]:
    """A broadcast of `value`, as a function that gives it inside a task.

    A plain broadcast names the classes of its objects, which a worker without this
    package cannot import; here they travel along, as functions do.
    """
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(shared.value)


def small_batches(spark: SparkSession) -> None:
    """Has Spark send rows to Python in batches of at most `BATCH_ROWS`: both sides hold a batch in memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def short_batches(spark: SparkSession) -> None:
    """Like `small_batches`, and in batches that end with the row that makes them longer than `BATCH_BYTES`."""
    small_batches(spark)
    if not 0 < spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch() <= BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def release_memory() -> None:
    """Gives memory that a task has freed back to the machine: the worker outlives the task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that each part holds at most `limit` bytes of `column`, or one row."""
    array = batch.column(batch.schema.get_field_index(column))
    lengths = pa.compute.binary_length(array).fill_null(0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(lengths):
        if held and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The UTF-8 bytes of a text column; null counts as empty."""
    array = batch.column(batch.schema.get_field_index(column))
    return [t or b"" for t in array.cast(pa.binary()).to_pylist()]


def process_memory(name: str) -> dict:
    """A dictionary that lasts as long as the Python worker, which serves many tasks one after the other."""
    store = sys.modules.setdefault("_stormgrid_llm_memory", types.ModuleType("_stormgrid_llm_memory"))
    return store.__dict__.setdefault(name, {})


class WordMemory:
    """Numbers that texts have word by word, words being cut at ASCII blanks; a word met lately is not looked into again."""

    def __init__(self, words_kept: int, bytes_kept: int) -> None:
        self.words_kept, self.bytes_kept = words_kept, bytes_kept
        self.forget()

    def learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all these words one after the other, and how many each has."""
        raise NotImplementedError

    def forget(self) -> None:
        self.words, self.parts, self.ends = pa.array([], pa.string()), np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all texts and how many each text has."""
        if len(self.words) > self.words_kept or self.words.nbytes > self.bytes_kept:
            self.forget()
        split = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).view(pa.string()))
        words = split.flatten().dictionary_encode()
        known = pc.index_in(words.dictionary, self.words)
        fresh = known.is_null()
        new = words.dictionary.filter(fresh)
        known, fresh = known.fill_null(0).to_numpy(), fresh.to_numpy(zero_copy_only=False)
        if len(new):
            known = np.where(fresh, len(self.words) + np.cumsum(fresh) - 1, known)
            parts, sizes = self.learn(new.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist())
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
            self.parts, self.words = np.concatenate([self.parts, parts.astype(np.int32)]), pa.concat_arrays([self.words, new])
        place = known[words.indices.to_numpy()]
        size = np.diff(self.ends)[place]
        last = np.cumsum(size)
        numbers = self.parts[np.repeat(self.ends[place + 1] - last, size) + np.arange(size.sum())]
        ends = np.concatenate([[0], last])[np.cumsum(pc.list_value_length(split).to_numpy())]
        return numbers, np.diff(ends, prepend=0)


def append_columns(
    frame: DataFrame,
    column: str,
    make: Callable[[], Callable[[list[bytes]], Iterable]],
    fields: list[T.StructField],
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """Adds columns computed from the bytes of one text or binary column.

    `make` runs once in each task and returns a function from a list of texts to
    one Arrow array (or list) per field. A column of the same name as a new one
    is replaced; all others pass through unless named in `drop`.
    """
    new = {f.name for f in fields}
    kept = [f for f in frame.schema.fields if f.name not in new and f.name not in drop]
    schema = T.StructType(kept + fields)
    names = [f.name for f in kept]
    types = [_arrow(f.dataType) for f in fields]
    out_names = names + [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for whole in batches:
            for batch in slices(whole, column):
                columns = work(texts_of(batch, column))
                arrays = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(n)) for n in names] + arrays, names=out_names)
        del work
        release_memory()

    small_batches(frame.sparkSession)
    needed = frame.select(*[F.col(f"`{n}`") for n in dict.fromkeys([*names, column])])
    return needed.mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    simple = {
        T.StringType: pa.string(), T.BinaryType: pa.binary(), T.LongType: pa.int64(), T.IntegerType: pa.int32(),
        T.DoubleType: pa.float64(), T.FloatType: pa.float32(), T.BooleanType: pa.bool_(), T.ByteType: pa.int8(),
    }
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, _arrow(f.dataType)) for f in kind.fields])
    return simple[type(kind)]

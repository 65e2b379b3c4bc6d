import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormgrid.llm import common


def test_slices_hold_a_bounded_number_of_bytes():
    texts = ["a" * 10, None, "b" * 25, "", "c" * 90, "d"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"])
    parts = [p.column(0).to_pylist() for p in common.slices(batch, "t", 40)]
    assert [t for p in parts for t in p] == texts
    assert all(len(p) == 1 or sum(len(t or "") for t in p) <= 40 for p in parts)
    assert list(common.slices(batch.slice(0, 0), "t", 40)) == []


def test_let_binds_a_value_once(spark):
    row = spark.range(1).select(common.let(F.array(F.lit(3), F.lit(1)), lambda a: F.struct(F.size(a).alias("n"), F.array_min(a).alias("least"))).alias("s")).first()
    assert (row.s.n, row.s.least) == (2, 1)


def test_append_columns_keeps_replaces_and_drops(spark):
    frame = spark.createDataFrame([(1, "ab", "x", [1.5]), (2, None, "y", None)], "id long, text string, n string, other array<double>")
    out = common.append_columns(frame, "text", lambda: lambda texts: [[len(t) for t in texts]], [T.StructField("n", T.LongType())], drop=("text",))
    assert out.columns == ["id", "other", "n"] and sorted(map(tuple, out.collect()), key=str) == [(1, [1.5], 2), (2, None, 0)]


def test_small_batches_only_lowers_the_number(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    for given, want in (("10000", str(common.BATCH_ROWS)), ("0", str(common.BATCH_ROWS)), ("7", "7")):
        spark.conf.set(name, given)
        common.small_batches(spark)
        assert spark.conf.get(name) == want
    spark.conf.unset(name)


def test_short_batches_only_lowers_the_bytes(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    for given, want in (("64m", str(common.BATCH_BYTES)), (str(common.BATCH_BYTES + 1), str(common.BATCH_BYTES)), ("3k", "3k")):
        spark.conf.set(name, given)
        common.short_batches(spark)
        assert spark.conf.get(name) == want
    spark.conf.unset(name)

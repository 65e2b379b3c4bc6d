"""The curated live outages: rows move with few columns, and what is found beside them is right."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import functions as F

from stormgrid import constants as C
from stormgrid.operators import aggregate, ordered
from stormgrid.plans import restoration


def _table(spark, values, kinds):
    return spark.createDataFrame(values, kinds)


def test_forward_fill_carries_over_batches_and_runs(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        values = [(i, float(i) if i % 7 == 2 else None, f"w{i}" if i in (5, 40) else None) for i in range(60)]
        got = ordered.forward_fill(_table(spark, values, "o int, a double, b string").repartition(5, "a"), ["a", "b"], ["o"], partitions=4, keep=["o", "a", "b"])
        a = b = None
        want = {}
        for o, x, y in values:
            a, b = (x if x is not None else a), (y if y is not None else b)
            want[o] = (a, b)
        assert {r.o: (r.a, r.b) for r in got.collect()} == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_only_columns_with_gaps_are_laid_out(spark):
    stored = ordered.numbered(_table(spark, [(1, 1.0, None, None), (2, 2.0, 5, None), (3, 3.0, None, None)], "o int, full double, some int, none string"))
    found = ordered.gap_values(stored, ["full", "some", "none"], ["o"])
    assert found.columns == [ordered.ROW, "some"] and found.count() == 2
    filled = ordered.with_gap_values(stored, found)
    assert sorted((r.o, r.full, r.some, r.none) for r in filled.collect()) == [(1, 1.0, None, None), (2, 2.0, 5, None), (3, 3.0, 5, None)]
    assert ordered.gap_values(stored, ["full", "none"], ["o"]) is None


def _feeds(spark):
    at = datetime(2024, 1, 3, 10)
    device = [(i % 40, 1 + i % 2, i, f"S{i % 3}", 7, "X", "E", 1, 4, 1.0, 2.0, 3, "0205", 1.0, at.replace(minute=i % 40)) for i in range(120)]
    location = [(i, 1 + h, i, "SPEEDWAY", 1, "2", None, 160000.0 + i if i % 5 else None, 1650000.0) for i in range(40) for h in (0, 1)]
    location += location[6:8]  # a location listed twice
    return (
        _table(spark, device, "INCIDENT_ID long, LOCATION_ID long, INCIDENT_DEVICE_ID long, STRCTUR_NO string, CIRCT_ID long, DNI_EQUIP_TYPE string, EQUIP_STN_NO string, CALL_QTY int, DOWNSTREAM_CUST_QTY int, KVA_VAL double, DOWNSTREAM_KVA_VAL double, SUBST_ID long, CLUE_CD string, PRIORITY_VAL double, CREATION_DATETIME timestamp"),
        _table(spark, location, "INCIDENT_ID long, LOCATION_ID long, MAJ_OTG_ID long, CITY_NAM string, OCCURN_CD long, CAUSE_CD string, ENERGIZED_DATETIME timestamp, GEO_X_COORD double, GEO_Y_COORD double"),
        _table(spark, [("0205", "Tree on line")], "CLUE_CD string, CLUE_DESC string"),
        _table(spark, [(1, "WIRE DOWN")], "OCCURN_CD long, OCCURN_DESC string"),
        _table(spark, [("2", "ANIMAL")], "CAUSE_CD string, CAUSE_DESC string"),
    )


def test_stored_outages_are_the_outage_table_with_packed_flags(spark):
    feeds = _feeds(spark)
    stored = restoration.stored_outages(*feeds)
    assert set(aggregate.MASKS) < set(stored.columns) and not set(C.KEYWORD_FLAGS) & set(stored.columns)
    want = restoration.outage_table(*feeds)
    got = aggregate.unpacked(stored).select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_wide_rows_move_only_once_to_be_located(spark):
    """Before, all rows with all their flags went through the rank, the fill and its window."""
    feeds = _feeds(spark)
    stored = restoration.stored_outages(*feeds)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        located = restoration.located_outages(stored, feeds[1], wanted=F.col("CIRCT_ID") == 7)
        plan = located._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    exchanges = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert exchanges.count(ordered.ROW) == 3  # the rows, their places, their ranks
    rows = located.collect()
    keys = {(r.INCIDENT_ID, r.STRCTUR_NO) for r in rows}
    assert len(keys) == stored.count() and all(r.LAT is not None or r.INCIDENT_ID == 0 for r in rows)
    assert len(rows) > len(keys)  # the location listed twice still gives two rows

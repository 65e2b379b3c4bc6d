import datetime as dt

from pyspark.sql import functions as F

from stormgrid import constants as C
from stormgrid.operators import aggregate, joins
from stormgrid.plans import restoration

DEVICE = ("INCIDENT_ID bigint, LOCATION_ID bigint, INCIDENT_DEVICE_ID bigint, STRCTUR_NO string, CIRCT_ID double, DNI_EQUIP_TYPE string, EQUIP_STN_NO string, "
          "CALL_QTY int, DOWNSTREAM_CUST_QTY int, KVA_VAL double, DOWNSTREAM_KVA_VAL double, CREATION_DATETIME timestamp, SUBST_ID bigint, CLUE_CD string, PRIORITY_VAL double")  # fmt: skip
LOCATION = "INCIDENT_ID bigint, LOCATION_ID bigint, MAJ_OTG_ID bigint, CITY_NAM string, OCCURN_CD bigint, CAUSE_CD string, ENERGIZED_DATETIME timestamp, GEO_X_COORD double, GEO_Y_COORD double"


def _feeds(spark):
    t0 = dt.datetime(2024, 1, 6, 7)
    device = [
        (1, 10, 100, "S1", 5.0, "T", "E", 1, 4, None, 1.0, t0, 3, "0AB", 1.0),
        (1, 11, 101, "S1", 5.0, "T", "E", 2, 6, None, 2.0, t0 - dt.timedelta(hours=2), 2, "0CD", 9.0),
        (2, 12, 102, "S1", 5.0, "T", "E", 0, 1, 8.0, 1.0, t0, None, "0AB", None),
        (3, 99, 103, None, 5.0, "T", "E", 0, 1, 8.0, 1.0, t0, None, "0AB", None),
    ]
    location = [
        (1, 10, 7, None, 50, "c1", None, 190000.0, 1647000.0),
        (1, 11, 7, "SPEEDWAY", None, "c2", dt.datetime(2024, 1, 7), None, None),
        (2, 12, 8, "INDIANAPOLIS EAST", 51, None, None, 190000.0, 1647000.0),
    ]
    clues = spark.createDataFrame([("0AB", "Pole down"), ("0CD", "power out")], "CLUE_CD string, CLUE_DESC string")
    occurrences = spark.createDataFrame([(50, "FUSE NOT BLOWN"), (51, "WIRE DOWN"), (51, "POLE")], "OCCURN_CD bigint, OCCURN_DESC string")
    causes = spark.createDataFrame([("c1", "TREE"), ("c2", "ANIMAL")], "CAUSE_CD string, CAUSE_DESC string")
    return spark.createDataFrame(device, DEVICE), spark.createDataFrame(location, LOCATION), clues, occurrences, causes


def test_outage_table(spark):
    got = {r.INCIDENT_ID: r for r in restoration.outage_table(*_feeds(spark)).collect()}
    assert set(got) == {1, 2}
    one, two = got[1], got[2]
    assert (one.CALL_QTY, one.CUST_QTY, one.KVA_VAL, one.DOWNSTREAM_KVA_VAL, one.INCIDENT_DEVICE_ID, one.SUBST_ID, one.LOCATION_ID) == (3, 10, None, 2.0, 101, 2, 11)
    assert one.CREATION_DATETIME == dt.datetime(2024, 1, 6, 5) and one.ENERGIZED_DATETIME == dt.datetime(2024, 1, 7)
    assert (one.OUTAGE_ID, one.CITY_NAM, one.DAY_FLAG) == ("1S15T", "SPEEDWAY", 0)
    assert (two.OUTAGE_ID, two.CITY_NAM, two.DAY_FLAG, two.CUST_QTY) == ("2S15T", "INDIANAPOLIS", 1, 1)
    on = {n for n in [*C.KEYWORD_FLAGS, *C.PRIORITY_FLAGS] if one[n]}
    assert on == {"POLE_CLUE_FLG", "POWER_OUT_CLUE_FLG", "TREE_CAUSE_FLG", "ANIMAL_CAUSE_FLG", "PRIORITY_VAL_1_0"}
    # An occurrence code listed twice gives both flags and does not double the customers.
    assert two["WIRE_OCCURN_FLG"] == two["POLE_OCCURN_FLG"] == 1


def test_city_choice(spark):
    keys = (1, "S", 1, "T")
    def city(*pairs):
        df = spark.createDataFrame([(*keys, i, c) for i, c in pairs], "INCIDENT_ID int, STRCTUR_NO string, CIRCT_ID int, DNI_EQUIP_TYPE string, INCIDENT_DEVICE_ID int, CITY_NAM string")
        return aggregate.outage_cities(df).first().CITY_NAM

    assert city((1, None)) == "NO_CITY"
    assert city((1, None), (2, "X")) == "X"
    assert city((2, "X"), (1, "Y")) == "Y"


def test_sums_of_nothing_are_zero(spark):
    df = spark.createDataFrame([(1, None)], "k int, v int")
    assert df.groupBy("k").agg(aggregate.total("v").alias("v")).first().v == 0


def test_counters_merge(spark, rows):
    day = dt.datetime(2024, 1, 1, 4)
    flags = list(C.DAILY_COUNTERS.values())
    df = spark.createDataFrame([(day, 1, 0, 1, 0, 0), (day, 1, 0, 0, 0, 0), (None, 1, 1, 1, 1, 1)], "CREATION_DATETIME timestamp, " + ", ".join(f"{f} int" for f in flags))
    batch = aggregate.daily_counters(df)
    assert rows(batch) == [(day.date(), 2, 0, 1, 0, 0)]
    assert rows(aggregate.merge_counters(batch, batch)) == [(day.date(), 4, 0, 2, 0, 0)]


def test_profiles_of_tables(spark, rows):
    df = spark.createDataFrame([(1, None, 2.0), (1, "a", 4.0), (2, None, None)], "k int, s string, v double")
    assert rows(aggregate.null_profile(df)) == [("k", 0, 0), ("s", 2, 1), ("v", 1, 1)]
    assert rows(aggregate.grain_violations(df, ["k"])) == [(1, 2)]
    assert rows(aggregate.duplicate_summary(df, ["k"])) == [(3, 2)]
    stat = aggregate.column_statistics(df, ["v"]).first()
    assert (stat.n, stat.mean, round(stat.std, 6), stat.min, stat.max) == (2, 3.0, 1.414214, 2.0, 4.0)
    assert aggregate.distinct_count(df, "k").first()[0] == aggregate.distinct_count(df, "k", approximate=True).first()[0] == 2


def test_rollup_statistics():
    pick = {f: aggregate.rollup_function(f) for f in C.ROLLUP_FEATURES}
    assert all(pick[f] is F.max for f in C.ROLLUP_MAX) and pick["windDir100mAvg"] is F.avg
    assert pick["tempAvg"] is F.avg and pick["tempMax"] is F.max and pick["radSolarMin"] is F.min


def test_weather_summary_and_places(spark):
    schema = "Location string, Landmark string, tempMin double, tempMax double, tempAvg double, windSpdMin double, windSpdMax double, windSpdAvg double, precipProb double, snowfallProb double, windDirAvg double"
    df = spark.createDataFrame([("b", "B", 1.0, 9.0, 5.0, 1.0, 8.0, 2.0, 10.0, 0.0, 10.0), ("a", "A", 1.0, 8.0, 6.0, 1.0, 9.0, 3.0, 30.0, 0.0, 100.0)], schema)
    stats = aggregate.weather_summary(df).first()
    assert (stats.temp_min, stats.temp_max, stats.temp_median, stats.precip_mean, stats.wind_direction_median) == (1.0, 9.0, 5.5, 20.0, 55.0)
    assert tuple(aggregate.weather_extremes(df).first()) == ("A", "A", "A")


def test_location_rows_fan_out(spark):
    device, location, *_ = _feeds(spark)
    assert joins.device_locations(device, location.unionAll(location)).count() == 7

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stormgrid import constants as C
from stormgrid.functions import flags, intervals, times, weather


def _column(spark, values, kind):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}").orderBy("i")


def _run(spark, values, kind, expression):
    return [r[0] for r in _column(spark, values, kind).select(expression(F.col("x"))).collect()]


@pytest.mark.parametrize(
    ("table", "text", "expected"),
    [
        (C.CLUE_KEYWORDS, "Pole down", {"POLE_CLUE_FLG"}),
        (C.CLUE_KEYWORDS, "Transformer", set()),
        (C.CLUE_KEYWORDS, "power out - OPEN DEVICE", {"POWER_OUT_CLUE_FLG", "OPEN_DEVICE_CLUE_FLG"}),
        (C.OCCURRENCE_KEYWORDS, "FUSE NOT BLOWN", set()),
        (C.OCCURRENCE_KEYWORDS, "NOT FOUND OPEN", set()),
        (C.OCCURRENCE_KEYWORDS, "FUSE FOUND OPEN", {"FUSE_OCCURN_FLG", "FOUND_OPEN_OCCURN_FLG"}),
        (C.CAUSE_KEYWORDS, "O.H. WIRE", {"OH_CAUSE_FLG"}),
        (C.CAUSE_KEYWORDS, "ST LIGHT", {"STREET_CAUSE_FLG"}),
        (C.CAUSE_KEYWORDS, "LAST", set()),
        (C.CAUSE_KEYWORDS, None, set()),
    ],
)
def test_keyword_flags(spark, table, text, expected):
    df = spark.createDataFrame([(text,)], "d string")
    row = df.select(*[c.alias(n) for n, c in flags.keyword_flags("d", table).items()]).first().asDict()
    assert {n for n, v in row.items() if v == 1} == expected and set(row.values()) <= {0, 1}
    packed = df.select(flags.pack(flags.keyword_conditions("d", table)).alias("m"))
    assert flags.unpack(packed, {"m": list(table)}).first().asDict() == row


def test_flag_counts():
    assert (len(C.CLUE_KEYWORDS), len(C.CAUSE_KEYWORDS), len(C.OCCURRENCE_KEYWORDS), len(C.TEXT_FLAGS)) == (10, 19, 18, 52)
    assert len(C.EXCLUDED_OCCURRENCES) == 85 == len(set(C.EXCLUDED_OCCURRENCES))
    assert len(C.WEATHER_FEATURES) == 50 and len(C.ROLLUP_FEATURES) == 51 and len(C.CUSTOMER_MODEL_FEATURES) == 18


def test_priority_and_text_flags(spark):
    df = spark.createDataFrame([(1, 2.0, 1), (2, None, 0), (3, 4.0, None)], "id int, PRIORITY_VAL double, DAY_FLAG int")
    got = df.select("id", *[c.alias(n) for n, c in flags.priority_flags().items()]).orderBy("id").collect()
    assert [tuple(r)[1:] for r in got] == [(0, 1, 0, 0), (0, 0, 0, 0), (0, 0, 0, 0)]
    assert [r.DAY_FLAG for r in flags.flags_to_text(df, ["DAY_FLAG"]).orderBy("id").collect()] == ["True", "False", None]


def test_cities(spark):
    assert _run(spark, ["INDIANAPOLIS EAST", "INDIAN LAKE", None, "X"], "string", flags.normal_city) == ["INDIANAPOLIS", "INDIANAPOLIS", "NO_CITY", "X"]


def test_day_and_weekend_flags(spark):
    hours = [dt.datetime(2024, 1, 5, h) for h in (5, 6, 17, 18)] + [None]
    assert _run(spark, hours, "timestamp", times.day_flag) == [0, 1, 1, 0, 0]
    days = [dt.datetime(2024, 1, d) for d in (5, 6, 7, 8)]
    assert _run(spark, days, "timestamp", times.weekend_flag) == [0, 1, 1, 0]
    assert _run(spark, [dt.datetime(2024, 1, 1, 6)], "timestamp", lambda c: F.round(times.hour_sin(c), 12)) == [1.0]


def test_wind_sectors(spark):
    degrees = [0.0, 0.5, 1.0, 44.9, 45.0, 90.0, 135.0, 180.0, 225.0, 270.0, 315.0, 359.9, 360.0, None]
    want = [None, None, "N-E-N", "N-E-N", "N-E-E", "S-E-E", "S-E-E", "S-W-S", "S-W-W", "N-W-W", "N-W-N", "N-W-N", None, None]
    assert _run(spark, degrees, "double", weather.wind_sector) == want


def test_marker_keys(spark):
    assert _run(spark, ["IPL_Marker12"], "string", weather.marker_key) == ["Marker12"]
    assert _run(spark, ["IPL_Marker12", "IPL_Marker3"], "string", weather.spaced_marker) == ["Marker 12", "Marker 3"]
    assert _run(spark, ["Marker 12", None], "string", weather.outage_marker_key) == ["Marker12", None]


def test_ratio_over_zero_is_null(spark):
    names = [f"{n}{s}" for n in C.RANGE_FEATURES for s in ("Max", "Min")]
    df = spark.createDataFrame([tuple(4.0 if n.endswith("Max") else 0.0 for n in names), tuple(0.0 for _ in names)], ", ".join(f"{n} double" for n in names))
    got = weather.range_and_ratio(df).orderBy("tempMax").collect()
    assert [(r.tempRange, r.relHumRatio, r.sfcPresRatio) for r in got] == [(0.0, None, None), (4.0, None, None)]


def test_durations_round_half_even(spark):
    start = dt.datetime(2024, 1, 1)
    ends = [start + dt.timedelta(seconds=s) for s in (30, 90, 150, 61)] + [None]
    got = _run(spark, ends, "timestamp", lambda c: times.restoration_minutes(F.lit(start), c))
    assert got == [0.0, 2.0, 2.0, 1.0, None]


def test_business_minutes(spark):
    assert _run(spark, [1440.0, 1440.0001, None, 10.0], "double", times.business_minutes) == [1485.0, 1800.0001, None, 55.0]


def test_restoration_time_rounds_to_even_ten_minutes(spark):
    start = dt.datetime(2024, 1, 1)
    got = _run(spark, [5.0, 15.0, 25.0, 5.01, 29.999, 0.0], "double", lambda c: times.restoration_time(F.lit(start), c))
    assert [(g - start).seconds // 60 for g in got] == [0, 20, 20, 0, 30, 0]


def test_intervals(spark):
    got = _run(spark, [25.0, 25.1, 50.0, 100.0, 250.0, 250.1, 1.0, None], "double", lambda c: F.struct(*intervals.outage_interval(c)))
    want = []
    for x, s in zip([25.0, 25.1, 50.0, 100.0, 250.0, 250.1, 1.0], [13.52, 12.07, 12.07, 15.13, 35.9, 172.96, 13.52]):
        want.append((round(max(0, x - 1.96 * s)), round(x + 1.96 * s)))
    assert [tuple(g) for g in got] == [*want, (None, None)]
    edge = _run(spark, [2500.0, 4000.0, 7000.0, 20000.0, 20000.5], "double", lambda c: intervals.residual_deviation(c, C.CUSTOMER_BANDS))
    assert edge == [1363.56, 1566.72, 3850.02, 5592.56, 4387.43]


def test_second_best_and_profiles(spark):
    df = spark.createDataFrame([(1, [0.1, 0.5, 0.4, 0.0, 0.0, 0.0]), (2, [0.5, 0.5, 0.0, 0.0, 0.0, 0.0])], "id int, p array<double>")
    got = df.select("id", weather.second_best(F.col("p")).alias("s")).orderBy("id").collect()
    assert [(r.s["index"], r.s["prob"]) for r in got] == [(3, 0.4), (2, 0.5)]
    assert _run(spark, ["Cluster3", "Cluster9", None], "string", weather.profile_text) == ["Thunderstorms", "", ""]
    assert _run(spark, [1, 6, 7], "int", weather.profile_text_by_index) == [C.PROFILES["Cluster1"], C.PROFILES["Cluster6"], None]


def test_day_names(spark):
    today = F.lit("2024-03-01").cast("date")
    days = [dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 3, 1), dt.date(2024, 3, 2), dt.date(2024, 3, 3), dt.date(2024, 3, 4)]
    assert _run(spark, days, "date", lambda c: times.day_label(c, today)) == ["DAY_B_YDAY", "YDAY", "TODAY", "TOM", "DAY_A_TOM", None]
    assert _run(spark, days[2:], "date", lambda c: times.horizon_label(c, today)) == ["0", "One day ahead", "Two days ahead", "3"]


def test_parsing_never_fails(spark):
    assert _run(spark, ["2024-01-01 05:00:00", "n/a", None], "string", times.parse_timestamp) == [dt.datetime(2024, 1, 1, 5), None, None]
    assert _run(spark, ["1.5", "x", None], "string", times.parse_number) == [1.5, None, None]

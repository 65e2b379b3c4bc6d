"""Feed-shaped tables derived from the given parquet tables.

Each function reads whole tables and derives codes, times, texts and coordinates
by plain arithmetic on their columns, so the outage operators can run on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stormgrid import constants as C
from stormgrid.session import use_utc

# Sample texts of the code tables, picked by (code % number of texts).
CLUE_TEXTS = [
    "Pole down across road", "Part lights only", "EMERGENCY call", "Power out whole street", "Tree on line",
    "Wire down in yard", "Reported by IVR", "EQUIPMENT damage", "TRANSFORMER humming", "OPEN DEVICE upstream",
    "Transformer noise", "power out - OPEN DEVICE",
]
CAUSE_TEXTS = [
    "OH LINE", "O.H. WIRE", "UG CABLE", "U.G. FAULT", "ANIMAL - SQUIRREL", "WEATHER - COLD", "WEATHER - LIGHTNING",
    "WEATHER - SNOW AND WIND", "WEATHER - HEAT", "FLOOD", "PUBLIC DAMAGE", "ST LIGHT", "SUBSTATION", "TREE CONTACT",
    "MISCELLANEOUS", "CUSTOMER REQUEST", "NO CAUSE FOUND", "PLANNED WORK", "NO OUTAGE", "animal",
]
OCCURRENCE_TEXTS = [
    "FUSE BLOWN", "FUSE NOT BLOWN", "CUSTOMER EQUIP", "POLE BROKEN", "TRANSFORMER FAILED", "METER", "SERVICE DROP",
    "CABLE FAULT", "ST LIGHT OUT", "FIRE", "FOUND OPEN", "NOT FOUND OPEN", "PUBLIC SAFETY", "WIRE DOWN", "SWITCH",
    "CUTOUT", "REGULATOR", "CAP BANK", "OH FAULT", "RECLOSER",
]
FIRST_DAY = 1_704_067_200  # 2024-01-01 as seconds
CITIES = ["INDIANAPOLIS", "INDIAN LAKE", None, "SPEEDWAY", "BEECH GROVE"]


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{folder}/{name}.parquet")


def pick(texts: list, index: Column) -> Column:
    return F.get(F.array(*[F.lit(t) for t in texts]), (index % len(texts)).cast("int"))


def _seconds(ts: str) -> Column:
    return F.unix_timestamp(F.col(ts).cast("timestamp"))


def _device_columns() -> dict[str, Column]:
    part, line, supplier = F.col("l_partkey"), F.col("l_linenumber"), F.col("l_suppkey")
    clue = (
        F.when(part % 16 == 0, "01").when(part % 16 == 1, "00A").when(part % 16 == 2, "09OD")
        .when(part % 16 == 3, "1EF").when(part % 16 != 4, F.concat(F.lit("0"), (part % 200 + 200).cast("string")))
    )
    return {
        "INCIDENT_ID": F.col("l_orderkey"),
        "LOCATION_ID": F.when(part % 19 == 0, F.lit(-1)).otherwise(F.col("l_orderkey") % 1000 + 1 + 1000 * (line % 2)).cast("bigint"),
        "INCIDENT_DEVICE_ID": part * 10 + line,
        "STRCTUR_NO": F.when(part % 53 != 0, F.concat(F.lit("S"), (part % 97).cast("string"))),
        "CIRCT_ID": supplier,
        "DNI_EQUIP_TYPE": F.col("l_returnflag"),
        "EQUIP_STN_NO": F.when(part % 29 == 0, C.NON_CONNECTED_STATION).when(part % 31 != 0, "E"),
        "CALL_QTY": line,
        "DOWNSTREAM_CUST_QTY": F.col("l_quantity").cast("int") - 5,
        "KVA_VAL": F.when(part % 7 != 0, F.col("l_extendedprice")),
        "DOWNSTREAM_KVA_VAL": F.col("l_extendedprice") * (1 - F.col("l_discount")),
        "SUBST_ID": F.when(part % 23 != 0, part % 41),
        "CLUE_CD": clue,
        "PRIORITY_VAL": F.when(part % 6 != 0, (part % 6).cast("double")),
    }


def device(spark: SparkSession, folder: str) -> DataFrame:
    """Live device feed: one row per line item, its ship date folded into the month of the weather data."""
    day = F.floor(_seconds("l_shipdate") / 86400) % 30
    created = F.timestamp_seconds(F.lit(FIRST_DAY) + day * 86400 + F.col("l_orderkey") * 7919 % 86400)
    columns = _device_columns() | {"CREATION_DATETIME": created}
    return load(spark, folder, "lineitem").select(*[c.alias(n) for n, c in columns.items()])


def location(spark: SparkSession, folder: str) -> DataFrame:
    """Live location feed: two locations per order."""
    orders = load(spark, folder, "orders").withColumn("half", F.explode(F.array(F.lit(0), F.lit(1))))
    order, customer, half = F.col("o_orderkey"), F.col("o_custkey"), F.col("half")
    mix = order * 7 + customer + half * 3
    return orders.select(
        order.alias("INCIDENT_ID"),
        (order % 1000 + 1 + 1000 * half).cast("bigint").alias("LOCATION_ID"),
        customer.alias("MAJ_OTG_ID"),
        pick(CITIES, mix).alias("CITY_NAM"),
        F.when(mix % 17 != 0, 30003000 + mix % 400).alias("OCCURN_CD"),
        (mix % 300).cast("string").alias("CAUSE_CD"),
        F.when(mix % 11 != 0, F.timestamp_seconds(_seconds("o_orderdate") + mix * 3571 % 8640000)).alias("ENERGIZED_DATETIME"),
        F.when(mix % 13 != 0, (150000 + customer * 37 % 80000).cast("double")).alias("GEO_X_COORD"),
        F.when(mix % 13 != 0, (1600000 + order * 53 % 100000).cast("double")).alias("GEO_Y_COORD"),
    )


def facility(spark: SparkSession, folder: str) -> DataFrame:
    """Daily history: line items with the dates of their order."""
    joined = load(spark, folder, "lineitem").join(
        load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    part, order = F.col("l_partkey"), F.col("l_orderkey")
    created = _seconds("o_orderdate") + order * 7919 % 86400
    codes = ["01", "00A", "09OD", "0AB", "0CD", "1EF", None]
    columns = _device_columns() | {
        "FAC_JOB_ID": order * 8 + F.col("l_linenumber"),
        "MAJ_OTG_ID": F.col("o_custkey"),
        "CLUE_CD": pick(codes, part),
        "OCCURN_CD": F.when(part % 13 == 0, 30003001).when(part % 17 != 0, 99).cast("bigint"),
        "CREATION_DATETIME": F.timestamp_seconds(created),
        "ENERGIZED_DATETIME": F.when(order % 11 != 0, F.timestamp_seconds(created + part * 31 % 3000 * 60)),
        "ETR_DATETIME": F.timestamp_seconds(created + (F.col("l_suppkey") * 17 % 900 - 60) * 60),
    }
    names = [n for n in columns if n not in ("LOCATION_ID", "INCIDENT_DEVICE_ID", "PRIORITY_VAL")]
    return joined.select(*[columns[n].alias(n) for n in names])


def clue_map(spark: SparkSession, folder: str) -> DataFrame:
    code = F.col("p_partkey") % 200
    return load(spark, folder, "part").select(
        F.concat(F.lit("0"), (code + 200).cast("string")).alias("CLUE_CD"), pick(CLUE_TEXTS, code).alias("CLUE_DESC")
    ).distinct()


def cause_map(spark: SparkSession, folder: str) -> DataFrame:
    code = F.col("p_partkey") % 300
    return load(spark, folder, "part").select(code.cast("string").alias("CAUSE_CD"), pick(CAUSE_TEXTS, code).alias("CAUSE_DESC")).distinct()


def occurrence_map(spark: SparkSession, folder: str) -> DataFrame:
    code = F.col("p_partkey") % 400
    return load(spark, folder, "part").select((code + 30003000).alias("OCCURN_CD"), pick(OCCURRENCE_TEXTS, code).alias("OCCURN_DESC")).distinct()


def outage_events(spark: SparkSession, folder: str) -> DataFrame:
    """Outage starts (one per event), cut to the second."""
    return load(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("OUTAGE_ID"),
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("CREATION_DATETIME"),
        "event_type",
        "user_id",
        "value",
    )


def event_flags(spark: SparkSession, folder: str) -> DataFrame:
    """The five counted flags, taken from the type of each event."""
    events = outage_events(spark, folder)
    kinds = ["view", "click", "purchase", "signup", "error"]
    return events.select(
        "OUTAGE_ID", "CREATION_DATETIME",
        *[(F.col("event_type") == kind).cast("int").alias(flag) for kind, flag in zip(kinds, C.DAILY_COUNTERS.values())],
    )


# Daily weather features: families are spread around the event values of the day and marker.
FAMILIES = [name[:-3] for name in C.WEATHER_FEATURES if name.endswith("Min")]


def _weather_features() -> dict[str, str]:
    """Feature expressions over the sum (cs), highest (cx), lowest (cn) and number (n) of cents."""
    mean, top, low = "cs / (n * 100D)", "cx / 100D", "cn / 100D"
    columns = {}
    for i, family in enumerate(FAMILIES):
        columns |= {f"{family}Avg": f"{mean} + {i}", f"{family}Max": f"{top} + {i}", f"{family}Min": f"{low} - {i}"}
    return columns | {
        "precip": "(cs % 97) / 10D",
        "snowfall": "(cs % 31) / 10D",
        "radSolarAvg": f"{mean} * 2",
        "radSolarMax": f"{top} * 2",
        "radSolarTot": "cs / 100D",
        "radSolarMin": f"{low} * 2",
        "windDir100mAvg": "(cs % 3600) / 10D",
        "windDir80mAvg": "(cx % 3600) / 10D",
        "windDirAvg": "(cs % 3611) / 10D",
    }


def _by_marker(spark: SparkSession, folder: str, unit: str) -> DataFrame:
    cents = F.round(F.col("value") * 100).cast("bigint")
    events = load(spark, folder, "events").select(
        F.date_trunc(unit, F.col("ts").cast("timestamp")).alias("moment"), (F.col("user_id") % 20 + 1).alias("marker"), cents.alias("cents")
    )
    return events.groupBy("moment", "marker").agg(
        F.sum("cents").alias("cs"), F.max("cents").alias("cx"), F.min("cents").alias("cn"), F.count("*").alias("n")
    )


def _loads(df: DataFrame) -> DataFrame:
    """Two loads of every forecast, an hour apart; the later one is 100 cents higher."""
    again = df.withColumn("load_no", F.explode(F.array(F.lit(1), F.lit(2))))
    shift = (F.col("load_no") - 1) * 100
    return again.withColumns({"cs": F.col("cs") + shift * F.col("n"), "cx": F.col("cx") + shift, "cn": F.col("cn") + shift})


def _hours(n: int | Column) -> Column:
    return F.make_dt_interval(F.lit(0), n if isinstance(n, Column) else F.lit(n))


def forecast_day(spark: SparkSession, folder: str) -> DataFrame:
    """Daily forecast per marker: the table the weather operators read."""
    days = _loads(_by_marker(spark, folder, "day"))
    places = F.get(F.array(*[F.struct(F.lit(a), F.lit(b)) for a, b in C.MARKERS]), (F.col("marker") - 1).cast("int"))
    return days.select(
        (F.col("moment") + _hours(5)).alias("timestamp"),
        F.concat(F.lit(f"{C.LOCATION_PREFIX}_Marker"), F.col("marker").cast("string")).alias("Location"),
        places["col1"].alias("Latitude"),
        places["col2"].alias("Longitude"),
        F.col("moment").alias("timestampInit"),
        (F.col("moment") + _hours(F.col("load_no"))).alias("Job_Update_Time"),
        ((F.col("cx") % 1000) / 10.0).alias("precipProb"),
        ((F.col("cn") % 1000) / 10.0).alias("snowfallProb"),
        *[F.expr(text).alias(name) for name, text in _weather_features().items()],
    )


def forecast_hour(spark: SparkSession, folder: str) -> DataFrame:
    hours = _loads(_by_marker(spark, folder, "hour"))
    return hours.select(
        (F.date_trunc("day", "moment") + _hours(F.col("load_no"))).alias("Job_Update_Time"),
        F.col("moment").alias("timestamp"),
        F.date_trunc("day", "moment").alias("timestampInit"),
        (F.col("cs") / (F.col("n") * 100.0)).alias("temp"),
        (F.col("cx") / 1000.0).alias("windSpd"),
        ((F.col("cn") % 1000) / 10.0).alias("snowfallProb"),
        ((F.col("cx") % 1000) / 10.0).alias("precipProb"),
        F.concat(F.lit(f"{C.LOCATION_PREFIX}_Marker"), F.col("marker").cast("string")).alias("Location"),
    )


def landmarks(spark: SparkSession, folder: str) -> DataFrame:
    """Landmark per marker, from the nations."""
    return load(spark, folder, "nation").select(
        F.concat(F.lit(f"{C.LOCATION_PREFIX}_Marker"), F.col("n_nationkey").cast("string")).alias("Location"),
        F.col("n_name").alias("Landmark"),
    )


def storm_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """Weather class per day and marker."""
    days = _by_marker(spark, folder, "day")
    return days.select(
        F.to_date("moment").alias("timestamp"),
        F.concat(F.lit("Marker "), F.col("marker").cast("string")).alias("Location"),
        F.concat(F.lit("Cluster"), (F.col("cs") % 7 + 1).cast("string")).alias("clusters"),
    )


def class_probabilities(spark: SparkSession, folder: str) -> DataFrame:
    """Six class weights per event, as an array."""
    return load(spark, folder, "events").select(
        "event_id",
        F.array(*[((F.col("event_id") * step + F.col("user_id")) % 101 / 101.0) for step in (3, 5, 7, 11, 13, 17)]).alias("probabilities"),
    )


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """File names as a feed folder would list them: one per event type and quarter day."""
    names = {
        "view": "INCIDENT_DEVICE_IPL", "click": "INCIDENT_IPL", "purchase": "LOCATION_IPL",
        "signup": "INCIDENT_IPL_HIS", "error": "FACILITY_IPL_Daily_HIS",
    }
    ts = F.col("ts").cast("timestamp")
    feed = F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.col("event_type"))
    quarter = F.lpad((F.floor(F.hour(ts) / 6) * 6).cast("string"), 2, "0")
    day = F.date_format(ts, "yyyyMMdd")
    return load(spark, folder, "events").select(
        F.to_date(ts).alias("day"), F.concat(F.lit("OMS/"), day, F.lit("/"), feed, F.lit("_"), quarter, F.lit("0000.csv")).alias("path")
    ).distinct()


def event_coordinates(spark: SparkSession, folder: str) -> DataFrame:
    """A point around the city per event; some have none."""
    event, user = F.col("event_id"), F.col("user_id")
    return load(spark, folder, "events").select(
        event.cast("string").alias("OUTAGE_ID"),
        F.when(event % 41 != 0, F.lit(39.5) + (event * 7 % 500) / 1000.0).alias("LAT"),
        F.when(event % 41 != 0, F.lit(-86.5) + (user * 13 + event) % 700 / 1000.0).alias("LONG"),
        (user % 40 + 1).alias("CUST_QTY"),
    )


def preparations(spark: SparkSession, folder: str) -> DataFrame:
    """Two stored day forecasts per order date."""
    days = load(spark, folder, "orders").groupBy(F.to_date("o_orderdate").alias("Date")).agg(
        F.count("*").alias("n"), F.sum("o_custkey").alias("c")
    )
    ahead = F.explode(F.array(F.lit(1), F.lit(2))).alias("ahead")
    return days.select("Date", "n", "c", ahead).select(
        "Date",
        F.when(F.col("ahead") == 1, C.HORIZON_LABELS[1]).otherwise(C.HORIZON_LABELS[2]).alias("Number_of_days_ahead"),
        (F.col("n") + F.col("ahead")).alias("Number_of_outages"),
        (F.col("c") % 9000 * F.col("ahead")).cast("double").alias("Customer_quantity"),
    )

import pytest

from stormgrid.operators import clean

SCHEMA = "id int, DOWNSTREAM_CUST_QTY int, EQUIP_STN_NO string, CIRCT_ID double, STRCTUR_NO string, DNI_EQUIP_TYPE string, CLUE_CD string, OCCURN_CD bigint"
GOOD = (1, 1, "E", 5.0, "S1", "T", "0AB", 99)


def _vary(**changes):
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return tuple(changes.get(n, v) for n, v in zip(names, GOOD))


def test_only_real_outages_stay(spark):
    data = [
        GOOD,
        _vary(id=2, DOWNSTREAM_CUST_QTY=0), _vary(id=3, DOWNSTREAM_CUST_QTY=None),
        _vary(id=4, EQUIP_STN_NO="<NCC>"), _vary(id=5, EQUIP_STN_NO=None),
        _vary(id=6, CIRCT_ID=0.0), _vary(id=7, CIRCT_ID=None), _vary(id=8, STRCTUR_NO=None), _vary(id=9, DNI_EQUIP_TYPE=None),
        _vary(id=10, CLUE_CD="01"), _vary(id=11, CLUE_CD="00A"), _vary(id=12, CLUE_CD="09OD"), _vary(id=13, CLUE_CD="1AB"), _vary(id=14, CLUE_CD=None),
        _vary(id=15, OCCURN_CD=30003001), _vary(id=16, OCCURN_CD=None), _vary(id=17, CLUE_CD="010"),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    assert sorted(r.id for r in clean.outage_rows(df).collect()) == [1, 16, 17]
    counts = [r.rows_left for r in clean.stage_counts(df).orderBy("stage_no").collect()]
    assert counts == [17, 15, 13, 9, 4, 3]


def test_filters_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([GOOD], SCHEMA).write.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    plan = clean.outage_rows(spark.read.parquet(str(tmp_path / "t")))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(DOWNSTREAM_CUST_QTY,0)" in plan and "StringStartsWith(CLUE_CD,0)" in plan


def test_still_out_takes_null_and_sentinel(spark):
    df = spark.sql("SELECT * FROM VALUES (1, NULL), (2, TIMESTAMP '1900-01-01'), (3, TIMESTAMP '2024-01-01 05:00:00') AS t(id, ENERGIZED_DATETIME)")
    assert sorted(r.id for r in clean.still_out(df).collect()) == [1, 2]


def test_require_rows(spark):
    df = spark.range(3)
    assert clean.require_rows(df, "none") is df
    with pytest.raises(ValueError, match="no outages"):
        clean.require_rows(df.where("id > 9"), "no outages")


def test_column_hygiene(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["Unnamed: 0", "_c0", "a", "PRIORITY_VAL_1.0"])
    assert clean.underscore_names(clean.drop_junk_columns(df)).columns == ["a", "PRIORITY_VAL_1_0"]


def test_negative_to_null_and_defaults(spark):
    df = spark.createDataFrame([(1, -1.0), (2, 0.0), (3, None)], "id int, x double")
    assert [r.x for r in clean.negative_to_null(df, "x").orderBy("id").collect()] == [None, 0.0, None]
    both = clean.default_columns(spark.createDataFrame([(7, 1.0, 2.0)], "CUST_QTY int, KVA_VAL double, DOWNSTREAM_KVA_VAL double")).first()
    assert (both.DOWNSTREAM_CUST_QTY, both.KVA_VAL) == (7, 2.0)
    assert clean.drop_any_null(df).count() == 2

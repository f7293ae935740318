import hashlib
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from loadloom import functions as fn
from loadloom.operators import columns


def test_calendar_counts_monday_as_zero(spark):
    days = [(datetime(2024, 1, d, 23, 59),) for d in range(1, 8)]  # Monday 1st to Sunday 7th
    df = spark.createDataFrame(days, "t timestamp")
    rows = df.select(*[c.alias(n) for n, c in fn.calendar_parts("t").items()]).orderBy("Day").collect()
    assert [r["DayOfWeek"] for r in rows] == [0, 1, 2, 3, 4, 5, 6]
    assert [r["IsWeekend"] for r in rows] == [0, 0, 0, 0, 0, 1, 1]
    assert {(r["Hour"], r["Month"]) for r in rows} == {(23, 1)}


def test_epoch_key_is_seconds_rounded_down(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:07.9' AS t UNION ALL SELECT timestamp_ntz'1969-12-31 23:59:58.5'")
    assert {r[0] for r in df.select(fn.epoch_key("t")).collect()} == {"1704067207", "-2"}


def test_parse_time_without_padding(spark):
    df = spark.createDataFrame([("1/2/2017 0:10",)], "s string")
    got = df.select(fn.parse_time("s", "M/d/yyyy H:mm").cast("timestamp_ntz")).first()[0]
    assert got == datetime(2017, 1, 2, 0, 10)


def test_load_stamp_is_the_given_moment(spark):
    at = datetime(2024, 5, 6, 7, 8, 9, 123456, tzinfo=timezone.utc)
    got = spark.range(2).select(fn.load_stamp(at).cast("timestamp_ntz").alias("s")).distinct().collect()
    assert [r[0] for r in got] == [at.replace(tzinfo=None)]


def test_parity_matches_the_whole_digest(spark):
    ids = [str(1704067200 + 600 * i) for i in range(200)]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    got = {r[0]: r[1] for r in df.select("id", fn.digest_parity(fn.text_digest("id"))).collect()}
    assert got == {i: int(hashlib.md5(i.encode()).hexdigest(), 16) % 2 for i in ids}


def test_product_is_null_when_a_factor_is(spark):
    df = spark.createDataFrame([(2.0, 3.0, 4.0), (2.0, None, 4.0)], "a double, b double, c double")
    assert [r[0] for r in df.select(fn.product("a", "b", "c")).collect()] == [24.0, None]


def test_whole_cuts_towards_zero_but_keeps_near_integers(spark):
    df = spark.createDataFrame([(1.9,), (-1.9,), (0.4,), (0.99999999999,)], "x double")
    assert [r[0] for r in df.select(fn.whole("x")).collect()] == [1, -1, 0, 1]


def test_indicators_unknown_and_null_give_zeros(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (9,), (None,)], "c int")
    cols = fn.indicators("c", [0, 1, 2])
    assert list(cols) == ["c_1", "c_2"]
    rows = df.select(*[v.alias(k) for k, v in cols.items()]).collect()
    assert [tuple(r) for r in rows] == [(0, 0), (1, 0), (0, 1), (0, 0), (0, 0)]
    assert list(fn.indicators("c", [0, 1], drop_first=False)) == ["c_0", "c_1"]


def test_steps_of_ten_minutes(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-02-28 23:55:00' AS t")
    assert df.select(fn.step_after("t", 1)).first()[0] == datetime(2024, 2, 29, 0, 5)


def test_clean_names_collapses_and_trims(spark):
    df = spark.range(1).select(
        F.lit(1).alias("Zone 1  Power Consumption"), F.lit(2).alias(" Wind\tSpeed "), F.lit(3).alias("Humidity")
    )
    assert columns.clean_names(df).columns == ["Zone_1_Power_Consumption", "Wind_Speed", "Humidity"]


def test_fan_out_and_stacking(spark):
    df = spark.sql("SELECT array(1.0D, 2.0D) AS p")
    assert tuple(df.select(*columns.fan_out("p", ["a", "b", "c"])).first()) == (1.0, 2.0, None)
    one, two = spark.sql("SELECT 1 AS x, 2 AS y"), spark.sql("SELECT 3 AS y, 4 AS z")
    assert {tuple(r) for r in columns.stack_by_name(one, two).select("x", "y", "z").collect()} == {
        (1, 2, None),
        (None, 3, 4),
    }
    assert [tuple(r) for r in columns.stack_by_position(one, two).collect()] == [(1, 2), (3, 4)]


def test_without_ignores_unknown_names(spark):
    df = spark.sql("SELECT 1 AS a, 2 AS b, 3 AS c")
    assert columns.without(df, ["b", "nope"]).columns == ["a", "c"]


def test_other_time_zones_are_refused(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        for make in (fn.calendar_parts, fn.epoch_key):
            with pytest.raises(RuntimeError, match="UTC"):
                make("t")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")

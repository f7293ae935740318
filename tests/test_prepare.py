import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loadloom import names
from loadloom.operators import prepare
from loadloom.plans import prepare_data


def profile_of(df, **kw):
    return {r["column"]: r for r in prepare.fit(df, **kw).collect()}


def test_statistics_ignore_missing_and_scale_after_filling(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,), (float("nan"),)], "x double")
    got = profile_of(df, numeric=["x"], categories=[])["x"]
    filled = [1.0, 2.0, 4.0, 7 / 3, 7 / 3]
    deviation = math.sqrt(sum((v - 7 / 3) ** 2 for v in filled) / 5)
    assert got["mean"] == pytest.approx(7 / 3)
    assert got["scale"] == pytest.approx(deviation)


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(5.0, None), (5.0, None)], "x double, y double")
    got = profile_of(df, numeric=["x", "y"], categories=[])
    assert (got["x"]["mean"], got["x"]["scale"]) == (5.0, 1.0)
    assert (got["y"]["mean"], got["y"]["scale"]) == (None, 1.0)
    out = prepare.apply(df, prepare.fit(df, ["x", "y"], []), keep=[]).collect()
    assert [tuple(r) for r in out] == [(0.0, None), (0.0, None)]


def test_found_levels_count_missing_as_minus_one(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "c int")
    assert profile_of(df, numeric=[], categories=["c"], domains=None)["c"]["levels"] == [-1, 1, 3]
    out = prepare.apply(df, prepare.fit(df, [], ["c"], None), keep=[])
    assert out.columns == ["c_1", "c_3"]
    assert sorted(tuple(r) for r in out.collect()) == [(0, 0), (0, 1), (1, 0)]


def test_too_many_levels_is_an_error(spark):
    df = spark.range(50).select(F.col("id").cast("int").alias("c"), F.lit(1).alias("d"))
    with pytest.raises(Exception, match="more than 10 levels"):
        prepare.levels_of(df, ["c", "d"], max_levels=10).collect()


def test_prepared_columns_and_values(spark, hourly):
    out = prepare_data.prepared(prepare_data.raw_readings(hourly))
    assert out.columns == [names.KEY, names.TIME, *names.TARGETS, *names.MODEL_INPUTS]
    assert out.count() == 217
    stats = out.agg(F.avg("Temperature"), F.stddev_pop("Temperature")).first()
    assert stats[0] == pytest.approx(0, abs=1e-9) and stats[1] == pytest.approx(1)
    assert {r[0] for r in out.select("Hour").distinct().collect()} == {-1, 0, 1}
    weekdays = out.agg(*[F.sum(c) for c in names.INDICATORS]).first()
    assert all(v > 0 for v in weekdays)


def test_scaled_calendar_can_be_kept(spark, hourly):
    out = prepare_data.prepared(prepare_data.raw_readings(hourly), truncate_calendar=False)
    assert dict(out.dtypes)["Hour"] == "double"
    assert out.select("Hour").distinct().count() == 24


def test_batch_without_a_weekday_keeps_all_columns(spark, hourly):
    raw = prepare_data.raw_readings(hourly).filter("DayOfWeek <> 3")
    assert set(names.INDICATORS) <= set(prepare_data.prepared(raw).columns)
    with pytest.raises(ValueError, match="DayOfWeek_3"):
        prepare_data.prepared(raw, domains=None)


def test_profile_of_another_batch_can_be_used(spark, hourly):
    raw = prepare_data.raw_readings(hourly)
    profile = prepare.fit(raw.filter("Temperature < 15"))
    assert prepare_data.prepared(raw, profile).agg(F.avg("Temperature")).first()[0] > 0.5


def test_messy_source_columns(spark):
    start = datetime(2024, 1, 1)
    rows = [((start + timedelta(hours=i)).strftime("%-m/%-d/%Y %-H:%M"), *[float(i)] * 8, None) for i in range(48)]
    header = ["DateTime", "Temperature", "Humidity", "Wind Speed", "general diffuse flows", "diffuse flows",
              "Zone 1 Power Consumption", "Zone 2  Power Consumption", "Zone 3  Power Consumption"]
    schema = ", ".join(f"`{h}` {'string' if h == 'DateTime' else 'double'}" for h in header) + ", _rescued_data string"
    raw = prepare_data.raw_readings(spark.createDataFrame(rows, schema), "M/d/yyyy H:mm")
    assert names.LEFTOVER not in raw.columns
    out = prepare_data.prepared(raw)
    assert out.orderBy(names.TIME).first()[names.KEY] == "1704067200"


def test_parts_keep_time_order_and_sizes(spark, hourly):
    train, test = prepare_data.prepared_parts(prepare_data.raw_readings(hourly))
    assert (train.count(), test.count()) == (173, 44)
    assert train.columns == test.columns
    assert train.agg(F.max(names.TIME)).first()[0] < test.agg(F.min(names.TIME)).first()[0]


def test_fit_on_train_differs_from_fit_on_all(spark, hourly):
    raw = prepare_data.raw_readings(hourly)
    sound, _ = prepare_data.prepared_parts(raw, fit_on="train")
    parity, _ = prepare_data.prepared_parts(raw)
    assert sound.agg(F.avg("Humidity")).first()[0] == pytest.approx(0, abs=1e-9)
    assert abs(parity.agg(F.avg("Humidity")).first()[0]) > 1e-6


def test_store_parts_appends_with_one_stamp(spark, hourly):
    train, test = prepare_data.prepared_parts(prepare_data.raw_readings(hourly))
    from loadloom.session import scratch_path

    tag = scratch_path(spark, "t").rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS d_{tag} LOCATION '{scratch_path(spark, 'db')}'")
    tables = f"d_{tag}.train_set", f"d_{tag}.test_set"
    prepare_data.store_parts(train, test, *tables)
    prepare_data.store_parts(train, test, *tables)
    assert [spark.table(t).count() for t in tables] == [346, 88]
    stamps = spark.table(tables[0]).unionByName(spark.table(tables[1])).select(names.STAMP).distinct().count()
    assert stamps == 2


def test_stored_files_cover_separate_stretches_of_time(spark, sf):
    from loadloom.registry.inputs import readings
    from loadloom.session import scratch_path

    tag = scratch_path(spark, "t").rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE o_{tag} LOCATION '{scratch_path(spark, 'db')}'")
    train, test = prepare_data.prepared_parts(prepare_data.raw_readings(readings(spark, sf)))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        prepare_data.store_parts(train.repartition(3), test, f"o_{tag}.train_set", f"o_{tag}.test_set")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    stored = spark.table(f"o_{tag}.train_set")
    files = stored.groupBy(F.input_file_name().alias("f")).agg(F.min(names.TIME), F.max(names.TIME))
    spans = sorted((r[1], r[2]) for r in files.collect())
    assert len(spans) > 1
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_apply_is_a_single_projection_over_the_scan(spark, sf):
    from conftest import plan_of

    from loadloom.registry.inputs import readings

    raw = prepare_data.raw_readings(readings(spark, sf))
    plan = plan_of(prepare_data.prepared(raw))
    assert "Exchange" not in plan and "Join" not in plan and "Python" not in plan

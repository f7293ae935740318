import math
import random
from datetime import datetime, timedelta

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from loadloom.operators import ranking
from loadloom.registry.inputs import readings


@pytest.fixture
def tiny_bins(monkeypatch):
    """Few bins and no direct look-ups, so that every refining step runs."""
    monkeypatch.setattr(ranking, "BINS", 4)
    monkeypatch.setattr(ranking, "DIRECT", 2)


def rows_with_ties(n, seed, share=3):
    """A third of the rows share one time; some times and keys are missing; keys are not of one length."""
    rng = random.Random(seed)
    start = datetime(2020, 1, 1)
    keys = rng.sample(["", "é", "éa", "éb", "ÿ", "日本", "日本語", "z", "zz"] + [str(i) for i in range(10 * n)], n)
    rows = []
    for i in range(n):
        t = datetime(2020, 6, 1) if i % share == 0 else start + timedelta(seconds=rng.randrange(10**7))
        rows.append((None if i % 17 == 5 else t, None if i == 7 else keys[i]))
    rng.shuffle(rows)
    return rows


def in_order(rows):
    far = datetime(9999, 1, 1)
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or far, r[1] is None, r[1] or ""))


@pytest.mark.parametrize("rank", [1, 5, 17, 30, 33, 55, 56, 57, 58, 60])
def test_first_rows_are_those_of_a_full_sort(spark, tiny_bins, rank):
    rows = rows_with_ties(60, seed=rank)
    df = spark.createDataFrame(rows, "t timestamp_ntz, k string")
    cut = ranking.cut_at(df, rank, "t", "k")
    expected = in_order(rows)
    assert set(map(tuple, df.filter(cut.first).collect())) == set(expected[:rank])
    assert set(map(tuple, df.filter(cut.rest).collect())) == set(expected[rank:])


@pytest.mark.parametrize("kind", ["bigint", "int", "date", "timestamp"])
def test_value_at_rank_of_numbers_and_times(spark, tiny_bins, kind):
    rng = random.Random(3)
    numbers = [rng.choice([rng.randrange(-2000, 20000), 77]) for _ in range(100)]
    df = spark.createDataFrame([(n,) for n in numbers], "n int")
    column = {
        "bigint": F.col("n").cast("bigint") * 400_000_000_000_000,
        "int": F.col("n"),
        "date": F.date_from_unix_date("n"),
        "timestamp": F.timestamp_micros(F.col("n").cast("bigint") * 1_000_003),
    }[kind]
    scale = {"bigint": 400_000_000_000_000, "int": 1, "date": 1, "timestamp": 1_000_003}[kind]
    df = df.select(column.alias("v"))
    for rank in (1, 20, 50, 99, 100):
        place = ranking.value_at_rank(df, "v", rank)
        value = sorted(numbers)[rank - 1]
        assert place.value == value * scale
        assert place.before == sum(n < value for n in numbers)
        assert place.ties == numbers.count(value)


def test_split_sizes_round_the_test_part_up(spark, hourly):
    keyed = hourly.withColumn("id", F.unix_seconds("DateTime").cast("string"))
    train, test = ranking.split_frames(keyed)
    assert (train.count(), test.count()) == (217 - math.ceil(0.2 * 217), 44)
    summary = {r["split"]: r for r in ranking.split_summary(ranking.temporal_split(keyed)).collect()}
    assert summary["train"]["rows"] == 173 and summary["test"]["rows"] == 44
    assert summary["train"]["last_time"] < summary["test"]["first_time"]


@pytest.mark.parametrize("size, parts", [(0.0, (5, 0)), (1.0, (0, 5)), (0.5, (2, 3))])
def test_split_extremes(spark, size, parts):
    df = spark.range(5).select(F.timestamp_seconds("id").alias("t"), F.col("id").alias("k"))
    train, test = ranking.split_frames(df, size, "t", "k")
    assert (train.count(), test.count()) == parts


def test_split_of_nothing(spark):
    df = spark.createDataFrame([], "t timestamp, k string")
    assert ranking.temporal_split(df, 0.2, "t", "k").count() == 0


def test_one_time_for_all_rows(spark, tiny_bins):
    df = spark.range(100).select(F.lit(datetime(2020, 1, 1)).alias("t"), F.col("id").cast("string").alias("k"))
    train, test = ranking.split_frames(df, 0.2, "t", "k")
    ordered = sorted(str(i) for i in range(100))
    assert {r.k for r in train.collect()} == set(ordered[:80])
    assert {r.k for r in test.collect()} == set(ordered[80:])


def test_rows_equal_in_time_and_key_are_still_divided(spark, tiny_bins):
    df = spark.range(100).select(F.lit(datetime(2020, 1, 1)).alias("t"), F.lit("same").alias("k"), "id")
    train, test = ranking.split_frames(df, 0.2, "t", "k")
    assert (train.count(), test.count()) == (80, 20)
    assert {r.id for r in train.collect()} | {r.id for r in test.collect()} == set(range(100))


def test_copies_of_one_row_are_divided_by_number(spark, tiny_bins, no_broadcast):
    early = [(datetime(2019, 1, 1), str(i), None) for i in range(5)]
    rows = early + [(datetime(2020, 1, 1), "same", 1.5)] * 10 + [(datetime(2021, 1, 1), "x", 2.0)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, k string, x double")
    train, test = ranking.split_frames(df, 0.5, "t", "k")
    assert sorted(map(repr, map(tuple, train.collect()))) == sorted(map(repr, early + [rows[5]] * 3))
    assert sorted(map(repr, map(tuple, test.collect()))) == sorted(map(repr, [rows[5]] * 7 + rows[-1:]))
    labelled = ranking.temporal_split(df, 0.5, "t", "k")
    assert labelled.columns == ["t", "k", "x", "split"]
    assert {r["split"]: r["count"] for r in labelled.groupBy("split").count().collect()} == {"train": 8, "test": 8}
    assert ranking.rows_between(df, 6, 8, "t", "k").count() == 2


def test_slices_by_position(spark, monkeypatch):
    rows = rows_with_ties(60, seed=1)
    df = spark.createDataFrame(rows, "t timestamp_ntz, k string")
    expected = in_order(rows)
    for start, stop in [(0, 1), (1, 2), (10, 40), (50, 100), (5, 5)]:
        got = ranking.in_time_order(ranking.rows_between(df, start, stop, "t", "k"), "t", "k")
        assert [tuple(r) for r in got.collect()] == expected[start:stop]
        monkeypatch.setattr(ranking, "DIRECT", 0)
        looked_closer = {tuple(r) for r in ranking.rows_between(df, start, stop, "t", "k").collect()}
        monkeypatch.undo()
        assert looked_closer == set(expected[start:stop])


def test_slices_of_tied_rows_nest(spark):
    df = spark.range(30).select(F.lit(datetime(2020, 1, 1)).alias("t"), F.lit("same").alias("k"), "id")
    slices = [{r["id"] for r in ranking.rows_between(df, 0, n, "t", "k").collect()} for n in (0, 3, 10, 11, 30)]
    assert [len(s) for s in slices] == [0, 3, 10, 11, 30] and all(a <= b for a, b in zip(slices, slices[1:]))


@pytest.mark.parametrize("kind", ["decimal(12,3)", "decimal(5,0)", "binary", "bigint"])
def test_keys_of_other_kinds_order_the_ties(spark, tiny_bins, kind):
    key = F.encode(F.lpad(F.col("id").cast("string"), 3, "0"), "UTF-8") if kind == "binary" else (F.col("id") - 20).cast(kind)
    df = spark.range(50).select(F.lit(datetime(2020, 1, 1)).alias("t"), key.alias("k"), "id").repartition(3)
    train, test = ranking.split_frames(df, 0.2, "t", "k")
    assert sorted(r["id"] for r in train.collect()) == list(range(40))
    assert sorted(r["id"] for r in test.collect()) == list(range(40, 50))


def test_latest_of_many_rows_is_not_one_task(spark):
    df = spark.range(30_000).select(F.timestamp_seconds(F.col("id") % 20_000).alias("t"), F.col("id").alias("k"))
    last = ranking.latest(df, 12_000, "t", "k")
    assert "TakeOrdered" not in plan_of(last)
    want = sorted(((i % 20_000, i) for i in range(30_000)))[-12_000:]
    assert [r["k"] for r in last.collect()] == [i for _, i in want]
    first = ranking.earliest(df, 12_000, "t", "k")
    assert [r["k"] for r in first.collect()] == [i for _, i in sorted(((i % 20_000, i) for i in range(30_000)))[:12_000]]
    assert ranking.latest(df, 0, "t", "k").count() == ranking.earliest(df, 0, "t", "k").count() == 0


def test_latest_and_earliest(spark, hourly):
    keyed = hourly.withColumn("id", F.unix_seconds("DateTime").cast("string"))
    last = [r["DateTime"] for r in ranking.latest(keyed, 3).collect()]
    assert last == sorted(last) and last[-1] == datetime(2023, 1, 10)
    assert ranking.earliest(keyed, 1).first()["DateTime"] == datetime(2023, 1, 1)


def test_split_moves_no_row_and_filters_in_the_scan(spark, sf):
    train, test = ranking.split_frames(readings(spark, sf))
    for part in (train, test):
        plan = plan_of(part)
        assert "Exchange" not in plan and "Window" not in plan and "Sort" not in plan
        assert "PushedFilters: []" not in plan


def test_unorderable_column_is_refused(spark):
    with pytest.raises(TypeError):
        ranking.value_at_rank(spark.sql("SELECT 1.0D AS x"), "x", 1)


def test_rows_with_equal_hashes_are_told_apart_by_their_text(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(ranking, "row_hash", lambda df: F.lit(7).cast("bigint"))
    rows = [("k", 5, f"v{i % 7}") for i in range(30)]
    df = spark.createDataFrame(rows, "id string, DateTime int, v string").withColumn("DateTime", F.timestamp_seconds("DateTime"))
    want = sorted(v for *_, v in rows)
    for n in (1, 4, 5, 6, 17, 29):
        got = sorted(r["v"] for r in ranking.rows_between(df, 0, n).collect())
        assert got == want[:n]

import math
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from loadloom import names
from loadloom.operators import sampling
from loadloom.operators.synthetic import continue_series, moments
from loadloom.plans import prepare_data
from loadloom.session import scratch_path


@pytest.mark.parametrize("n", [1, 10, 1000, 5000])
def test_exactly_n_rows(spark, n):
    assert sampling.sample_exactly(spark.range(1000), n, seed=n).count() == n


def test_a_block_leaves_nothing_behind(spark):
    root = Path(scratch_path(spark, "x")).parent
    before = set(root.glob("draws-*"))
    with sampling.exact_sample(spark.range(100), 500) as rows:
        assert rows.count() == 500
    assert set(root.glob("draws-*")) == before


def test_columns_share_no_random_stream(spark):
    df = spark.range(1000).select(F.timestamp_seconds("id").alias("DateTime"), *[(F.col("id") * k).cast("double").alias(f"c{k}") for k in (1, 2, 3)])
    rows = continue_series(df.repartition(4), ["c1", "c2", "c3"], rows=4000).collect()
    found = {m["column"]: m for m in moments(df, ["c1", "c2", "c3"]).collect()}
    drawn = [{round((r[c] - found[c]["mean"]) / found[c]["deviation"], 9) for r in rows} for c in ("c1", "c2", "c3")]
    assert all(len(d) > 3990 for d in drawn) and not drawn[0] & drawn[1] and not drawn[1] & drawn[2] and not drawn[0] & drawn[2]


def test_draws_are_uneven_as_chance_has_it(spark):
    out = sampling.sample_exactly(spark.range(50), 2000, seed=4)
    counts = {r["id"]: r["count"] for r in out.groupBy("id").count().collect()}
    assert sum(counts.values()) == 2000 and set(counts) == set(range(50))
    # chi-square with 49 degrees of freedom
    chi = sum((c - 40) ** 2 / 40 for c in counts.values())
    assert 20 < chi < 95


def test_draws_are_with_replacement_and_even(spark):
    out = sampling.sample_exactly(spark.range(100), 10_000, seed=9)
    counts = [r["count"] for r in out.groupBy("id").count().collect()]
    assert len(counts) == 100 and max(counts) > 100
    assert sum((c - 100) ** 2 / 100 for c in counts) < 160


def test_seed_decides(spark):
    a, b, c = (sorted(r[0] for r in sampling.sample_exactly(spark.range(1000), 50, s).collect()) for s in (1, 1, 2))
    assert a == b and a != c


def test_empty(spark):
    assert sampling.sample_exactly(spark.range(10), 0).count() == 0
    with pytest.raises(ValueError):
        sampling.sample_exactly(spark.range(0), 3)


def test_continued_series_has_grid_and_moments(spark, hourly):
    out = continue_series(hourly, ["Temperature", "Humidity"], rows=4000, seed=3)
    last = hourly.agg(F.max("DateTime")).first()[0]
    first, end, n = out.agg(F.min("DateTime"), F.max("DateTime"), F.count_distinct("DateTime")).first()
    assert n == 4000
    assert (first - last).total_seconds() == 600 and (end - last).total_seconds() == 600 * 4000
    wanted = {r["column"]: r for r in moments(hourly, ["Temperature", "Humidity"]).collect()}
    for r in moments(out, ["Temperature", "Humidity"]).collect():
        w = wanted[r["column"]]
        assert r["mean"] == pytest.approx(w["mean"], abs=5 * w["deviation"] / math.sqrt(4000))
        assert r["deviation"] == pytest.approx(w["deviation"], rel=0.1)
    corr = out.agg(F.corr("Temperature", "Humidity")).first()[0]
    assert abs(corr) < 0.1


def test_continued_series_after_another_frame(spark, hourly):
    marked = spark.sql("SELECT timestamp'2030-01-01 00:00:00' AS DateTime")
    out = continue_series(hourly, ["Temperature"], rows=2, marked=marked)
    assert sorted(r[0] for r in out.select("DateTime").collect()) == [
        datetime(2030, 1, 1, 0, 10),
        datetime(2030, 1, 1, 0, 20),
    ]


def test_synthetic_batch_is_ready_for_the_source_table(spark, hourly):
    out = prepare_data.synthetic_batch(hourly, hourly, rows=1008)
    assert set(out.columns) == {names.KEY, names.TIME, names.STAMP, *names.TARGETS, *names.MODEL_INPUTS}
    assert out.count() == 1008 == out.select(names.KEY).distinct().count()
    assert out.agg(F.min(names.TIME)).first()[0] == datetime(2023, 1, 10, 0, 10)

import math
import random
from datetime import datetime, timedelta

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from loadloom.operators import prepare, states
from loadloom.session import scratch_path

DDL = "t timestamp, x double, y int, k int, s string"


def rows_of(n, seed=1, start=0):
    rng = random.Random(seed)
    pick = lambda *v: rng.choice(v)
    return [
        (datetime(2024, 1, 1) + timedelta(hours=start + i), pick(None, math.nan, rng.gauss(1e6, 1.0), rng.gauss(1e6, 1.0)), pick(None, 1, 2, 3), pick(None, 1, 5), pick("a", "b", None))
        for i in range(n)
    ]


def as_rows(df):
    return {r["column"]: r.asDict() for r in df.collect()}


def close(a, b):
    for c in a.keys() | b.keys():
        for f in a[c].keys() & b[c].keys():
            if isinstance(a[c][f], float):
                assert a[c][f] == pytest.approx(b[c][f], rel=1e-9), (c, f)
            else:
                assert a[c][f] == b[c][f], (c, f)


@pytest.mark.parametrize("cuts", [(100,), (1, 2, 299), (0, 150), (50, 100, 150, 200)])
def test_merged_states_equal_the_state_of_all_rows(spark, cuts):
    rows = rows_of(300)
    parts = [rows[a:b] for a, b in zip((0, *cuts), (*cuts, 300), strict=True)]
    numeric, categories = ["x", "y"], ["k", "s"]
    whole = states.state_of(spark.createDataFrame(rows, DDL), numeric, categories)
    merged = states.merged(*[states.state_of(spark.createDataFrame(p, DDL), numeric, categories) for p in parts])
    close(as_rows(whole), as_rows(merged))
    pairwise = states.state_of(spark.createDataFrame(parts[0], DDL), numeric, categories)
    for p in parts[1:]:
        pairwise = states.merged(states.state_of(spark.createDataFrame(p, DDL), numeric, categories), pairwise)
    close(as_rows(whole), as_rows(pairwise))


def test_profile_equals_the_full_fit(spark):
    df = spark.createDataFrame(rows_of(200), DDL)
    a, b = df.limit(0), df
    state = states.merged(states.state_of(a, ["x", "y"], ["k", "s"]), states.state_of(b, ["x", "y"], ["k", "s"]))
    want = as_rows(prepare.fit(df, ["x", "y"], ["k", "s"], domains=None))
    close(want, as_rows(states.profile_of(state, None)))
    declared = as_rows(states.profile_of(state, {"k": [1, 2]}))
    assert declared["k"]["levels"] == [1, 2] and declared["s"]["labels"] == ["a", "b"]
    got = prepare.apply(df, states.profile_of(state, None), ["t"], ()).columns
    assert got == ["t", "x", "y", "k_1", "k_5", "s_b"]
    moments = as_rows(states.moments_of(state))
    assert moments["y"]["deviation"] == pytest.approx(df.agg(F.stddev_samp("y")).first()[0])


def test_constant_empty_and_too_many_levels(spark):
    df = spark.createDataFrame([(None, 2.0, None, 7, None)] * 3, DDL)
    profile = as_rows(states.profile_of(states.merged(states.state_of(df, ["x", "y"], ["k"]), states.state_of(df, ["x", "y"], ["k"])), None))
    assert profile["x"]["scale"] == 1.0 and profile["x"]["mean"] == 2.0 and profile["y"]["mean"] is None and profile["k"]["levels"] == [7]
    many = spark.range(20).selectExpr("cast(id as int) AS k", "cast(id as string) AS s")
    for c in ("k", "s"):
        with pytest.raises(Exception, match="more than 15 levels"):
            states.state_of(many, [], [c], 15).collect()
        halves = [states.state_of(many.where(f"k {op} 10"), [], [c], 15) for op in ("<", ">=")]
        with pytest.raises(Exception, match="more than 15 levels"):
            states.merged(*halves, max_levels=15).collect()


def test_a_stored_state_takes_in_new_rows_only(spark):
    tag = scratch_path(spark, "db").rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE s_{tag} LOCATION '{scratch_path(spark, 'db')}'")
    name, path = f"s_{tag}.state", scratch_path(spark, "source")
    rows = rows_of(300)
    fold = lambda: states.fold_new(spark, name, spark.read.parquet(path), ["x", "y"], ["k", "s"], "t")
    spark.createDataFrame(rows[:100], DDL).write.parquet(path)
    assert fold() == 100 and fold() == 0
    spark.createDataFrame(rows[100:] + [(None, 1e9, 1, 1, "z")], DDL).write.mode("append").parquet(path)
    assert fold() == 200 and fold() == 0
    stored = spark.table(name)
    close(as_rows(states.state_of(spark.createDataFrame(rows, DDL), ["x", "y"], ["k", "s"])), as_rows(stored.drop(states.UPTO)))


def test_the_filter_on_time_reaches_the_scan(spark, monkeypatch):
    tag = scratch_path(spark, "db").rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE p_{tag} LOCATION '{scratch_path(spark, 'db')}'")
    name, path = f"p_{tag}.state", scratch_path(spark, "source")
    spark.createDataFrame(rows_of(50), DDL).write.parquet(path)
    seen = []
    real = states.state_of
    monkeypatch.setattr(states, "state_of", lambda df, *a: (seen.append(df), real(df, *a))[1])
    states.fold_new(spark, name, spark.read.parquet(path), ["x"], time="t")
    spark.createDataFrame(rows_of(5, start=100), DDL).write.mode("append").parquet(path)
    states.fold_new(spark, name, spark.read.parquet(path), ["x"], time="t")
    assert "GreaterThan(t," in plan_of(seen[1])

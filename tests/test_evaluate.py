import random

import pytest
from conftest import plan_of
from pyspark.ml.evaluation import RegressionEvaluator

from loadloom.operators import evaluate


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(1)
    rows = [(str(i), rng.gauss(100, 20), rng.gauss(100, 20), 7.0, 7.0, 8.0) for i in range(300)]
    rows.append(("gap", 5.0, None, 7.0, 7.0, 8.0))
    return spark.createDataFrame(rows, "id string, y double, p double, c double, exact double, off double")


PAIRS = {"one": ("y", "p"), "flat": ("c", "exact"), "flat_off": ("c", "off")}


def test_metrics_match_sparks_own(spark, scored):
    got = {r["target"]: r for r in evaluate.metrics_per_target(scored, PAIRS).collect()}
    full = scored.filter("p is not null")
    for metric in ("mse", "rmse", "mae", "r2"):
        theirs = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=metric).evaluate(full)
        assert got["one"][metric] == pytest.approx(theirs)
    assert got["one"]["rows"] == 300
    assert (got["flat"]["r2"], got["flat"]["mse"]) == (1.0, 0.0)
    assert (got["flat_off"]["r2"], got["flat_off"]["mse"]) == (0.0, 1.0)


def test_uniform_average(spark, scored):
    per = evaluate.metrics_per_target(scored, PAIRS).collect()
    got = evaluate.metrics_uniform(scored, PAIRS).first()
    for metric in ("mse", "mae", "r2"):
        assert got[metric] == pytest.approx(sum(r[metric] for r in per) / 3)


def test_all_metrics_in_one_pass(spark, scored):
    assert plan_of(evaluate.metrics_per_target(scored, PAIRS)).count("Exchange") == 1


def test_empty_frame_has_no_metrics(spark, scored):
    got = evaluate.metrics_per_target(scored.limit(0), {"one": ("y", "p")}).first()
    assert got["rows"] == 0 and got["mse"] is None and got["r2"] is None
    assert evaluate.champion_challenger(scored.limit(0), "y", "p", "off").first()["promote"] is False


def test_only_a_strictly_smaller_error_promotes(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0.0), (1.0, 3.0, 3.0)], "y double, o double, n double")
    tie = evaluate.champion_challenger(df, "y", "o", "n").first()
    assert tie["mae_old"] == tie["mae_new"] == 1.5 and tie["promote"] is False
    better = evaluate.champion_challenger(df.filter("o = 3"), "y", "o", "y").first()
    assert better["promote"] is True and better["rmse_old"] == 2.0


def test_axis_range_covers_both(spark):
    df = spark.createDataFrame([(1.0, 5.0), (9.0, None)], "y double, p double")
    assert tuple(evaluate.axis_range(df, {"t": ("y", "p")}).first()) == ("t", 1.0, 9.0)


def test_long_pairs_needs_no_shuffle(spark, scored):
    long = evaluate.long_pairs(scored, PAIRS, ["id"])
    assert long.count() == 3 * 301 and "Exchange" not in plan_of(long)


def test_importance_order_and_zero(spark):
    df = spark.createDataFrame(
        [("b", "t1", 0.5), ("b", "t2", 0.25), ("a", "t1", 0.25), ("a", "t2", 0.5), ("c", "t1", 0.25), ("c", "t2", 0.25)],
        "feature string, target string, importance double",
    )
    mean = evaluate.mean_importance(df)
    assert sum(r["importance"] for r in mean.collect()) == pytest.approx(1.0)
    assert [r["feature"] for r in evaluate.top_features(mean, 2).collect()] == ["a", "b"]
    assert evaluate.top_features(mean, 0).count() == 0
    assert evaluate.top_features(mean, 10).count() == 3


def test_chart_points_equal_brute_force_and_are_bounded(spark):
    rng = random.Random(3)
    values = [None, float("nan"), 1.0, 2.0, 2.0, -5.0, 7.5]
    rows = [(None if rng.random() < 0.05 else rng.randrange(500), rng.choice(values), rng.choice(values)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "s int, y double, p double").selectExpr("timestamp_seconds(s) AS t", "s", "y", "p")
    got = evaluate.chart_points(df, {"one": ("y", "p"), "two": ("p", "y")}, 16, "t")
    want = {}
    dated = [r for r in rows if r[0] is not None]
    first, width = min(r[0] for r in dated) * 10**6, None
    width = (max(r[0] for r in dated) * 10**6 - first) // 16 + 1
    for target, order in (("one", (1, 2)), ("two", (2, 1))):
        for series, c in zip(("actual", "predicted"), order, strict=True):
            for r in dated:
                if r[c] is not None and r[c] == r[c]:
                    want.setdefault((target, series, (r[0] * 10**6 - first) // width), []).append((r[0], r[c]))
    found = {(r["target"], r["series"], r["pixel"]): r for r in got.collect()}
    assert found.keys() == want.keys() and len(found) <= 4 * 16
    at = lambda r, n: (int(r[f"{n}_time"].timestamp()), r[f"{n}_value"])
    for key, points in want.items():
        r = found[key]
        assert r["points"] == len(points)
        assert at(r, "first") == min(points) and at(r, "last") == max(points)
        assert at(r, "low") == min(points, key=lambda x: (x[1], x[0])) and at(r, "high") == max(points, key=lambda x: (x[1], -x[0]))


def test_chart_points_of_one_instant_and_of_nothing(spark):
    df = spark.createDataFrame([(5, 1.0, 2.0), (5, 3.0, None)], "s int, y double, p double").selectExpr("timestamp_seconds(s) AS t", "y", "p")
    got = evaluate.chart_points(df, {"one": ("y", "p")}, 100, "t").collect()
    assert sorted((r["series"], r["pixel"], r["low_value"], r["high_value"]) for r in got) == [("actual", 0, 1.0, 3.0), ("predicted", 0, 2.0, 2.0)]
    assert evaluate.chart_points(df.limit(0), {"one": ("y", "p")}, 100, "t").count() == 0
    with pytest.raises(ValueError, match="pixels"):
        evaluate.chart_points(df, {"one": ("y", "p")}, 0, "t")

import pytest
from conftest import counting_reads
from pyspark.sql import functions as F

from loadloom import names
from loadloom.operators import evaluate, models, routing
from loadloom.operators.lookup import WEATHER_FEATURE, Lookup
from loadloom.plans import prepare_data, serving, training

PAIRS = {t: (t, p) for t, p in zip(names.TARGETS, names.PREDICTED, strict=True)}


@pytest.fixture(scope="module")
def parts(spark, hourly):
    """The targets follow the features, so that a model has something to learn."""
    raw = hourly.withColumns(
        {
            names.TARGETS[0]: 200 + 5 * F.col("Temperature"),
            names.TARGETS[1]: 100 + F.col("Humidity") * 2,
            names.TARGETS[2]: 300 - F.col("Wind_Speed") * 4,
        }
    )
    train, test = prepare_data.prepared_parts(prepare_data.raw_readings(raw))
    return train.cache(), test.cache()


@pytest.fixture(scope="module")
def forest(parts):
    return models.fit_per_target(parts[0], models.Forest(8, 5))


def test_scores_every_row_and_leaves_no_helper_column(parts, forest):
    scored = forest.score(parts[1])
    assert scored.columns == [*parts[1].columns, *names.PREDICTED]
    assert scored.count() == parts[1].count()
    assert scored.filter(F.col(names.PREDICTED[0]).isNull()).count() == 0


def test_better_than_the_mean(parts, forest):
    for r in evaluate.metrics_per_target(forest.score(parts[1]), PAIRS).collect():
        assert r["mse"] >= 0 and 0.3 < r["r2"] <= 1


def test_importances_sum_to_one_and_find_the_cause(parts, forest):
    rows = forest.importances(parts[0])
    assert rows.count() == len(names.MODEL_INPUTS) * 3
    mean = evaluate.mean_importance(rows).collect()
    assert sum(r["importance"] for r in mean) == pytest.approx(1, abs=1e-6)
    assert all(0 <= r["importance"] <= 1 for r in mean)
    first = rows.filter(F.col("target") == names.TARGETS[0]).orderBy(F.desc("importance")).first()
    assert first["feature"] == "Temperature"


def test_saved_model_scores_the_same(spark, parts, forest, tmp_path):
    forest.save(str(tmp_path / "m"))
    again = models.TargetModels.load(str(tmp_path / "m"), forest.features, forest.outputs)
    a = forest.score(parts[1]).select("id", *names.PREDICTED).orderBy("id").collect()
    assert a == again.score(parts[1]).select("id", *names.PREDICTED).orderBy("id").collect()


def test_input_column_order_does_not_matter(parts, forest):
    turned = parts[1].select(*reversed(parts[1].columns))
    a = forest.score(parts[1]).select("id", *names.PREDICTED).orderBy("id").collect()
    assert a == forest.score(turned).select("id", *names.PREDICTED).orderBy("id").collect()


def test_encoded_inputs_are_named_per_level(parts):
    fitted = models.fit_per_target(parts[0], models.Forest(2, 2), encode=names.INDICATORS)
    got = fitted.importances(parts[0])
    found = {r[0] for r in got.select("feature").distinct().collect()}
    assert {"Temperature", "DayOfWeek_1_0", "DayOfWeek_1_1", "IsWeekend_1_1"} <= found
    assert got.count() == 3 * (8 + 2 * 7)
    vector = fitted.regressors()[0].featureImportances
    assert vector.size == 8 + 2 * 7


def test_boosting_parameters_reach_the_estimator():
    gbt = models.Boosting(0.02, 17, 6).estimator("y", "p")
    assert (gbt.getStepSize(), gbt.getMaxIter(), gbt.getMaxDepth(), gbt.getSeed()) == (0.02, 17, 6, 42)
    forest = models.Forest(9, 4).estimator("y", "p")
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getFeatureSubsetStrategy()) == (9, 4, "all")


def test_train_and_judge_with_looked_up_features(parts):
    train, test = parts
    features = train.select("id", *names.FLOWS)
    out = training.train_and_judge(train, test, features, models.Boosting(0.5, 3, 3), names.TARGETS[:1], ["p"])
    row = out.metrics.first()
    assert row["r2"] > 0.3
    worse = models.fit_per_target(
        training.training_frame(train, features), models.Forest(1, 1), training.FEATURES, names.TARGETS[:1], ["p"]
    )
    assert training.compare_models(test, worse, out.models).first()["promote"] is True
    assert training.compare_models(test, out.models, out.models).first()["promote"] is False


def test_variants_one_row_each(parts):
    variants = {"A": models.Boosting(0.5, 2, 1), "B": models.Boosting(0.5, 2, 5)}
    rows = {r["variant"]: r for r in models.compare_variants(*parts, variants).collect()}
    assert set(rows) == {"A", "B"} and rows["B"]["mse"] < rows["A"]["mse"]
    assert rows["A"]["parameters"]["max_depth"] == "1"


def test_variants_share_one_matrix_and_give_what_each_alone_gives(spark, parts):
    train, test = parts
    rows, read = counting_reads(train)
    variants = {"A": models.Forest(3, 2), "B": models.Forest(3, 4), "C": models.Boosting(0.5, 2, 2)}
    got = {r["variant"]: r for r in models.compare_variants(rows, test, variants).collect()}
    assert read.value == train.count()
    for name, model in variants.items():
        alone = models.fit_per_target(train, model).score(test)
        want = evaluate.metrics_uniform(alone, {t: (t, o) for t, o in zip(names.TARGETS, names.PREDICTED, strict=True)}).first()
        for metric in ("mse", "mae", "r2"):
            assert got[name][metric] == pytest.approx(want[metric])
    with models.assembled(train) as matrix:
        fitted = models.fit_variants(matrix, variants, parallelism=5)
    assert list(fitted) == list(variants) and fitted["B"].score(test).count() == test.count()
    assert fitted["B"].importances(test).count() == len(names.MODEL_INPUTS) * 3


def test_prediction_table_and_routing(parts, forest):
    out = serving.prediction_table(*parts, forest.score)
    assert out.columns == ["id", *names.WEATHER, *names.PREDICTED]
    assert out.count() == 217
    other = models.fit_per_target(parts[0], models.Forest(1, 1))
    routed = routing.route_scored(parts[1], forest.score, other.score)
    assert routed.count() == parts[1].count()
    expected = {r["id"]: r["model"] for r in routing.assign(parts[1].select("id")).collect()}
    assert {r["id"]: r["model"] for r in routed.collect()} == expected
    assert set(expected.values()) == {"Model A", "Model B"}


def test_score_batch_fills_in_what_is_missing(parts):
    train, test = parts
    frame = training.training_frame(train, train.select("id", *names.FLOWS), key_checked=True)
    fitted = models.fit_per_target(frame, models.Forest(3, 4), training.FEATURES, names.TARGETS[:1], ["p"])
    full = fitted.score(training.testing_frame(test)).select("id", "p")
    given = test.drop(*names.WEATHER, *names.FLOWS)
    source = Lookup(test, [*names.WEATHER, *names.FLOWS])
    filled = training.score_batch(fitted, given, [source], [WEATHER_FEATURE]).select("id", "p")
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, filled.collect()))
    # Columns at hand win over the table.
    kept = training.score_batch(fitted, test, [source], [WEATHER_FEATURE])
    assert sorted(map(tuple, kept.select("id", "p").collect())) == sorted(map(tuple, full.collect()))

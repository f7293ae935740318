import json

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from loadloom import names
from loadloom.operators import arrow, lookup, routing
from loadloom.operators.arrow import ArrowFunction, ModelWrapper
from loadloom.registry.inputs import readings

INTERACTION = ArrowFunction(
    "loadloom_arrow_interaction",
    {"temperature": "double", "humidity": "double", "wind_speed": "double"},
    "double",
    lambda t, h, w: pc.multiply(pc.multiply(t, h), w),
)


def test_interaction_equals_its_sql_form(spark, sf):
    rows = readings(spark, sf).select(names.KEY, *names.WEATHER)
    bound = INTERACTION.create(spark).bind(lookup.WEATHER_FEATURE.bindings)
    got = rows.withColumn("x", bound)
    want = lookup.assemble(rows, functions=[lookup.WEATHER_FEATURE])
    assert got.join(want, names.KEY).where(~F.col("x").eqNullSafe(F.col(names.INTERACTION))).isEmpty()
    assert got.where("x is null").count() > 0
    assert "ArrowEvalPython" in plan_of(got) and "BatchEvalPython" not in plan_of(got)
    by_name = rows.selectExpr("loadloom_arrow_interaction(Temperature, Humidity, Wind_Speed) AS x").agg(F.sum("x")).first()[0]
    assert by_name == pytest.approx(got.agg(F.sum("x")).first()[0])


def test_arguments_are_typed_and_bound_by_name(spark):
    power = ArrowFunction("loadloom_power", {"base": "double", "exponent": "int"}, "bigint", pc.power)
    df = spark.createDataFrame([("2", 3), ("3", 2), (None, 1)], "e string, b int")
    assert [r[0] for r in df.select(power.bind({"exponent": "e", "base": "b"})).collect()] == [9, 8, None]
    with pytest.raises(ValueError, match="exponent"):
        power.bind({"base": "b"})


def _linear():
    """Functions that travel to the workers by value."""

    def load(source):
        with open(json.loads(source)["loads"], "a") as f:
            f.write("x\n")
        return json.loads(source)["weights"]

    def predict(model, columns):
        total = pc.add(pc.multiply(columns["a"], model["a"]), pc.multiply(columns["b"], model["b"]))
        return [total, pc.negate(total)]

    return load, predict


def test_a_model_is_loaded_once_a_worker_and_scores_all_batches(spark, tmp_path):
    loads = tmp_path / "loads"
    source = json.dumps({"weights": {"a": 2.0, "b": 10.0}, "loads": str(loads)})
    model = ModelWrapper("linear", source, *_linear(), {"a": "double", "b": "double"}, ["up", "down"])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        df = spark.range(0, 2000, 1, 4).selectExpr("id", "id AS left", "cast(1 as int) AS b", "'x' AS up_")
        for _ in range(2):
            got = model.score(df, {"a": "left"}).agg(F.sum("up"), F.sum("down"), F.count("up_")).first()
            assert tuple(got) == (2.0 * sum(range(2000)) + 20000, -2.0 * sum(range(2000)) - 20000, 2000)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(loads.read_text().split()) <= 8  # 80 batches on 4 cores
    assert model.score(df.limit(0), {"a": "left"}).columns == ["id", "left", "b", "up_", "up", "down"]


def test_routed_wrappers_equal_their_sql(spark, sf):
    """A/B routing over two wrapped models gives what the scaled columns give."""
    rows = readings(spark, sf).select("id", "Humidity")

    def wrapped(factor):
        return ModelWrapper("scale", str(factor), float, lambda m, c: [pc.multiply(c["Humidity"], m)], {"Humidity": "double"}, ["Prediction"])

    got = routing.route_scored(rows, wrapped(1.3).score, wrapped(-2).score, outputs=["Prediction"])
    want = routing.assign(rows).withColumn("want", F.when(F.col("model") == routing.MODEL_A, F.col("Humidity") * 1.3).otherwise(F.col("Humidity") * -2))
    both = got.join(want.select("id", "want", F.col("model").alias("chosen")), "id")
    assert both.where("abs(Prediction - want) > 1e-9 or model <> chosen").isEmpty() and both.count() == rows.count()


def test_kept_models_are_bounded():
    arrow._LOADED.clear()
    for n in range(10):
        assert arrow.loaded(str(n), float) == n
    assert len(arrow._LOADED) == arrow.MODELS_KEPT
    arrow._LOADED.clear()
    assert isinstance(arrow.pa_type("array<int>"), pa.ListType)

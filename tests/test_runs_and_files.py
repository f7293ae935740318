from datetime import datetime

from pyspark.sql import functions as F

from loadloom import names
from loadloom.operators import routing
from loadloom.sources import files, runlog


def test_run_log_appends_and_finds_the_latest(spark, tmp_path):
    path = str(tmp_path / "runs")
    for i, sha in enumerate(["x", "y", "x"]):
        runlog.log_run(
            spark, path, f"r{i}", "exp", {"git_sha": sha}, {"depth": 6}, {"mse": float(i)}, datetime(2024, 1, 1 + i)
        )
    runs = runlog.read_runs(spark, path)
    assert runlog.latest_run(runs, {"git_sha": "x"}).first()["run_id"] == "r2"
    assert runlog.latest_run(runs, {"git_sha": "x"}).first()["params"] == {"depth": "6"}
    assert runlog.latest_run(runs, {"git_sha": "x"}, "other").count() == 0
    assert runlog.latest_run(runs, {"git_sha": "z"}).count() == 0
    assert runlog.search_runs(runs, {"git_sha": "x"}).count() == 2
    assert runlog.search_experiments(runs, {"git_sha": "y"}).first()["runs"] == 1


def test_records_in_both_layouts(spark):
    df = spark.createDataFrame([("a", 1, 0.5), ("b", None, None)], "id string, n int, x double")
    text = [r[0] for r in files.records(df, df.columns).collect()]
    assert text == ['{"id":"a","n":1,"x":0.5}', '{"id":"b","n":null,"x":null}']
    assert files.from_records(files.records(df, df.columns), df.schema).collect() == df.collect()
    lists = files.column_split(df, df.columns).agg(F.collect_list("values").alias("data"))
    assert sorted(files.from_column_split(lists, df.columns, df.schema).collect()) == sorted(df.collect())


def test_csv_with_blank_names(spark, tmp_path):
    (tmp_path / "r.csv").write_text("DateTime,Wind Speed\n1/2/2017 0:10,1.5\n1/2/2017 13:00,\n")
    schema = spark.sql("SELECT '' AS DateTime, 0.0D AS `Wind Speed`").schema
    df = files.read_readings_csv(spark, str(tmp_path / "r.csv"), schema)
    assert df.columns == [names.TIME, "Wind_Speed"]
    rows = df.select(F.col(names.TIME).cast("timestamp_ntz"), "Wind_Speed").collect()
    assert [tuple(r) for r in rows] == [(datetime(2017, 1, 2, 0, 10), 1.5), (datetime(2017, 1, 2, 13, 0), None)]


def test_routing_columns(spark):
    df = spark.createDataFrame([("1", 1.0, 2.0), ("2", 1.0, 2.0), ("3", 1.0, 2.0)], "id string, a double, b double")
    out = routing.route(df, "a", "b")
    assert out.columns == ["id", "Prediction", "model"]
    for r in out.collect():
        assert r["Prediction"] == (1.0 if r["model"] == "Model A" else 2.0)
    scaled = routing.rescale(df, ["a", "b"]).first()
    assert (scaled["a"], scaled["b"]) == (1.3, 2.6)

import pytest
from conftest import counting_reads
from pyspark.sql import types as T

from loadloom import names
from loadloom.operators import contracts, keys, ranking
from loadloom.session import scratch_path

SCHEMA = T.StructType([T.StructField("a", T.DoubleType()), T.StructField("n", T.IntegerType(), False)])


@pytest.fixture
def text(spark):
    rows = [("k1", "1.5", "3"), ("k2", "x", "4.0"), ("k3", None, None), ("k4", "NaN", "y")]
    return spark.createDataFrame(rows, "id string, a string, n string")


def test_coerce_casts_and_keeps_other_columns(spark, text):
    got = {r["id"]: (r["a"], r["n"]) for r in contracts.coerce(text, SCHEMA, lenient=True).collect()}
    assert got["k1"] == (1.5, 3)
    assert got["k2"] == (None, 4)
    assert got["k3"] == (None, None)


def test_strict_coerce_fails_on_a_bad_value(spark, text):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cast"):
        contracts.coerce(text, SCHEMA).collect()


def test_violations_name_column_and_value(spark, text):
    got = {tuple(r) for r in contracts.violations(text, SCHEMA, ["id"]).collect()}
    assert got == {("k2", "a", "x"), ("k3", "n", None), ("k4", "n", "y")}


def test_nothing_to_check_gives_no_rows(spark):
    df = spark.createDataFrame([("k", 1.0)], "id string, a double")
    schema = T.StructType([T.StructField("a", T.DoubleType())])
    assert contracts.violations(df, schema, ["id"]).count() == 0


def test_missing_column_is_an_error(spark):
    df = spark.createDataFrame([("k", 1.0)], "id string, a double")
    with pytest.raises(ValueError, match="missing"):
        contracts.coerce(df, SCHEMA)


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (2.0,)], "a double")
    schema = T.StructType([T.StructField("a", T.DoubleType())])
    assert [r[0] for r in contracts.coerce(df, schema).collect()] == [None, 2.0]


def test_column_report(spark, text):
    extra = T.StructType([*SCHEMA.fields, T.StructField("gone", T.LongType())])
    rows = {r["column"]: r for r in contracts.column_report(text, extra).collect()}
    assert (rows["a"]["rows"], rows["a"]["present"], rows["a"]["uncastable"]) == (4, 3, 1)
    assert (rows["gone"]["found"], rows["gone"]["present"]) == (False, 0)


def test_schema_differences():
    wider = T.StructType([*names.PREPARED_SCHEMA.fields, T.StructField("x", T.LongType())])
    assert contracts.schema_differences(wider, names.PREPARED_SCHEMA) == {"x": ("bigint", None)}


def test_key_violations_and_assertion(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "id string")
    assert {tuple(r) for r in keys.key_violations(df, ["id"]).collect()} == {("a", 2), (None, 1)}
    with pytest.raises(ValueError, match="not a key"):
        keys.assert_key(df, ["id"])
    good = df.filter("id = 'b'")
    assert keys.assert_key(good, ["id"]) is good


def test_a_write_counts_for_the_report_in_its_own_pass(spark, text):
    rows, read = counting_reads(text)
    observed, counts = contracts.reported(rows, SCHEMA)
    path = scratch_path(spark, "observed")
    contracts.coerce(observed, SCHEMA, lenient=True).write.parquet(path)
    got = sorted(map(tuple, counts.report().collect()))
    assert got == sorted(map(tuple, contracts.column_report(text, SCHEMA).collect()))
    assert read.value == 4 and spark.read.parquet(path).count() == 4


def test_report_of_an_empty_write_and_of_missing_columns(spark, text):
    observed, counts = contracts.reported(text.drop("a").limit(0), SCHEMA)
    observed.write.parquet(scratch_path(spark, "observed"))
    assert sorted(map(tuple, counts.report().collect())) == [("a", "double", False, 0, 0, 0), ("n", "int", True, 0, 0, 0)]


def test_split_is_summarised_by_the_write(spark):
    df = spark.range(100).selectExpr("cast(id as string) AS id", "timestamp_seconds(id * 60) AS DateTime")
    split = ranking.temporal_split(df, 0.25)
    rows, read = counting_reads(split)
    observed, counts = ranking.summarised_split(rows)
    observed.write.partitionBy("split").parquet(scratch_path(spark, "split"))
    assert sorted(map(tuple, counts.report().collect())) == sorted(map(tuple, ranking.split_summary(split).collect()))
    assert read.value == 100

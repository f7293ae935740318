"""The given tables seen as load-series tables. Every frame is a projection of a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadloom import names


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def readings(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` as readings: key, time, five measures (one with gaps), three targets."""
    k = F.get_json_object("props", "$.k").cast("double")
    value = F.col("value")
    return table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.col("ts").alias("DateTime"),
        F.when(F.col("event_id") % 17 != 0, value).alias("Temperature"),
        k.alias("Humidity"),
        F.col("user_id").cast("double").alias("Wind_Speed"),
        (value * 0.5).alias("general_diffuse_flows"),
        (F.col("event_id") % 100).cast("double").alias("diffuse_flows"),
        (1000 + 3 * value + 2 * k).alias("Zone_1_Power_Consumption"),
        (500 + value + F.col("user_id")).alias("Zone_2_Power_Consumption"),
        (250 + k).alias("Zone_3_Power_Consumption"),
    )


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Readings with fixed predictions: an old and a new one for the first target, one for each of the others."""
    number = F.col("id").cast("bigint")
    z1, z2, z3 = (F.col(t) for t in names.TARGETS)
    return readings(spark, sf).withColumns(
        {
            "prediction_old": z1 + number % 7 - 3,
            "prediction_new": z1 + number % 5 - 2,
            "prediction_2": z2 * 0.9 + 10,
            "prediction_3": z3 + F.col("Temperature"),
        }
    )


PAIRS = {
    "Zone_1_Power_Consumption": ("Zone_1_Power_Consumption", "prediction_new"),
    "Zone_2_Power_Consumption": ("Zone_2_Power_Consumption", "prediction_2"),
    "Zone_3_Power_Consumption": ("Zone_3_Power_Consumption", "prediction_3"),
}

# Measures as they may arrive in text files, with words in place of some numbers.
TEXT_SCHEMA = T.StructType(
    [
        T.StructField("Temperature", T.DoubleType()),
        T.StructField("Hour", T.IntegerType()),
        T.StructField("Zone_1_Power_Consumption", T.DoubleType(), False),
    ]
)


def text_readings(spark: SparkSession, sf: str) -> DataFrame:
    """Readings whose temperature and hour are text, some of it not a number."""
    base = readings(spark, sf)
    return base.select(
        "id",
        F.when(F.col("Humidity") < 5, "n/a").otherwise(F.col("Temperature").cast("string")).alias("Temperature"),
        F.when(F.col("Humidity") >= 95, "noon").otherwise(F.hour("DateTime").cast("string")).alias("Hour"),
        F.when(F.col("Humidity") != 50, F.col("Zone_1_Power_Consumption")).alias("Zone_1_Power_Consumption"),
    )


def order_runs(spark: SparkSession, sf: str) -> DataFrame:
    """``orders`` as a log of runs: the priority is the experiment, the status a tag, the price a metric."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.col("o_orderpriority").alias("experiment"),
        F.col("o_orderdate").alias("started"),
        F.create_map(F.lit("branch"), F.col("o_orderstatus")).alias("tags"),
        F.create_map(F.lit("customer"), F.col("o_custkey").cast("string")).alias("params"),
        F.create_map(F.lit("price"), F.col("o_totalprice")).alias("metrics"),
    )

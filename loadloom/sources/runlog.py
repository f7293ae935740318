"""Training runs as rows of an append-only table."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("experiment", T.StringType(), False),
        T.StructField("started", T.TimestampType(), False),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    ]
)


def log_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    experiment: str,
    tags: Mapping[str, str] | None = None,
    params: Mapping[str, object] | None = None,
    metrics: Mapping[str, float] | None = None,
    started: datetime | None = None,
) -> None:
    """Append one run."""
    row = (
        run_id,
        experiment,
        started or datetime.now(timezone.utc),
        dict(tags or {}),
        {k: str(v) for k, v in (params or {}).items()},
        {k: float(v) for k, v in (metrics or {}).items()},
    )
    spark.createDataFrame([row], RUN_SCHEMA).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def search_runs(runs: DataFrame, tags: Mapping[str, str], experiment: str | None = None) -> DataFrame:
    """Runs that carry all the given tags."""
    found = runs if experiment is None else runs.filter(F.col("experiment") == experiment)
    for name, value in tags.items():
        found = found.filter(F.col("tags")[name] == value)
    return found


def latest_run(runs: DataFrame, tags: Mapping[str, str], experiment: str | None = None) -> DataFrame:
    """The newest matching run, ties by id; no row if none matches."""
    return search_runs(runs, tags, experiment).orderBy(F.desc("started"), F.desc("run_id")).limit(1)


def search_experiments(runs: DataFrame, tags: Mapping[str, str]) -> DataFrame:
    """Experiments with a run that carries the tags: name, number of such runs, newest start."""
    return (
        search_runs(runs, tags)
        .groupBy("experiment")
        .agg(F.count(F.lit(1)).alias("runs"), F.max("started").alias("last_started"))
    )

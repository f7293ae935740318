import random
import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from loadloom import names
from loadloom.session import build_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "loadloom-tests",
        "local[4]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def no_broadcast(spark):
    """Every frame counts as too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def sf():
    return SF


def hourly_rows(count=217, start=datetime(2023, 1, 1), seed=42):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        rows.append(
            (
                start + timedelta(hours=i),
                rng.uniform(0, 30),
                rng.uniform(30, 90),
                rng.uniform(0, 20),
                rng.uniform(0, 100),
                rng.uniform(0, 100),
                *[rng.uniform(100, 500) for _ in range(3)],
            )
        )
    return rows


RAW_COLUMNS = [names.TIME, *names.WEATHER, *names.FLOWS, *names.TARGETS]


@pytest.fixture(scope="session")
def hourly(spark):
    """217 hourly rows, nothing missing."""
    schema = "DateTime timestamp, " + ", ".join(f"{c} double" for c in RAW_COLUMNS[1:])
    return spark.createDataFrame(hourly_rows(), schema)


def plan_of(df):
    """The physical plan; of one that has run, the final form only."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def counting_reads(df):
    """``df``, and an accumulator of the rows that its scans deliver."""
    seen = df.sparkSession.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema), seen

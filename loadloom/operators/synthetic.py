"""Rows that continue a series with its own moments."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadloom import names
from loadloom.functions import step_after


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A4: ``column, mean, deviation`` (sample deviation), all columns in one pass."""
    aggs, rows = [], []
    for i, c in enumerate(columns):
        aggs += [F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}")]
        rows.append(
            F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("deviation"))
        )
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def time_grid(df: DataFrame, rows: int = 1008, minutes: int = 10, time: str = names.TIME) -> DataFrame:
    """``rows`` timestamps at a fixed step after the last one of the frame."""
    last = df.agg(F.max(time).alias("last")).scalar()
    return df.sparkSession.range(1, rows + 1).select(
        F.col("id").alias("step"), step_after(last, F.col("id"), minutes).alias(time)
    )


def normal(number: Column, seed: int, column: str) -> Column:
    """A standard normal value for each number, from a digest: the same in every run and on any partitioning, and other
    columns and seeds give independent ones.

    52 bits each of the digest's two ends are two uniform numbers, which Box and Muller's transformation turns into a normal one.
    """
    digest = F.md5(F.concat_ws("/", F.lit(str(seed)), F.lit(column), number.cast("string")))
    bits = lambda hexadecimal: F.conv(hexadecimal, 16, 10).cast("bigint")
    radius = F.sqrt(-2 * F.log((bits(F.left(digest, F.lit(13))) + 1) / F.lit(2.0**52)))
    return radius * F.cos(bits(F.right(digest, F.lit(13))) / F.lit(2.0**52) * (2 * math.pi))


def continue_series(
    df: DataFrame,
    columns: Sequence[str],
    rows: int = 1008,
    marked: DataFrame | None = None,
    minutes: int = 10,
    seed: int = 0,
    time: str = names.TIME,
) -> DataFrame:
    """New rows on a grid after the series, each column normal with its own moments.

    The grid starts after the last time of ``marked`` where that is given. The moments are one pass and enter the plan
    as literals; rows are generated where they are used, and a run with the same seed gives the same rows.
    """
    found = {r["column"]: r for r in moments(df, columns).collect()}
    values = []
    for c in columns:
        mean, deviation = F.lit(found[c]["mean"]).cast("double"), F.lit(found[c]["deviation"]).cast("double")
        values.append((normal(F.col("step"), seed, c) * deviation + mean).alias(c))
    return time_grid(df if marked is None else marked, rows, minutes, time).select(time, *values)

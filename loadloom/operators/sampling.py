"""Exactly n rows drawn with replacement."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadloom.operators.columns import unused
from loadloom.operators.ranking import value_at_rank
from loadloom.session import remove, remove_at_end, scratch_path


@contextmanager
def exact_sample(df: DataFrame, n: int, seed: int = 0) -> Iterator[DataFrame]:
    """``sample_exactly`` for the length of a block; its stored draws are removed at the end."""
    kept, path = _drawn(df, n, seed)
    try:
        yield kept
    finally:
        if path:
            remove(df.sparkSession, path)


def sample_exactly(df: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """``n`` independent uniform draws of rows, in no order.

    The draws are kept below the shared scratch folder until the driver ends; ``exact_sample`` removes them earlier, and of
    stored files ``positions.draw`` takes draws that are kept nowhere.
    """
    kept, path = _drawn(df, n, seed)
    if path:
        remove_at_end(df.sparkSession, path)
    return kept


def _drawn(df: DataFrame, n: int, seed: int) -> tuple[DataFrame, str | None]:
    """The draws and where they are kept.

    Spark's sampling with replacement gives every row its own Poisson number of copies: a random number of independent
    uniform draws in all. Asking for slightly more than ``n`` and keeping a random ``n`` of them leaves exactly that
    many independent draws, in one narrow scan. Rows are neither numbered nor moved.
    """
    size, number = df.count(), unused("_draw", df)
    if n <= 0 or size == 0:
        if n > 0:
            raise ValueError("cannot draw from an empty frame")
        return df.limit(0), None
    while True:
        # Eight deviations above n: falling short has a probability below 1e-14, and is then retried.
        expected = n + 8 * math.sqrt(n) + 16
        draws = df.sample(withReplacement=True, fraction=expected / size, seed=seed)
        numbered = draws.withColumn(number, F.shiftrightunsigned(F.xxhash64(F.rand(seed + 1)), 1))
        # The draws are a small part of the frame; storing them fixes their number and order for the steps below.
        path = scratch_path(df.sparkSession, "draws")
        numbered.write.parquet(path)
        stored = df.sparkSession.read.schema(numbered.schema).parquet(path)
        if stored.count() >= n:
            break
        remove(df.sparkSession, path)
        seed += 2
    last = value_at_rank(stored, number, n)
    kept = stored.filter(F.col(number) <= F.lit(last.value))
    surplus = last.before + last.ties - n
    if surplus:
        # Equal 63-bit draw numbers: all but practically impossible, resolved among those few rows.
        tied = stored.filter(F.col(number) == F.lit(last.value)).limit(last.ties - surplus)
        kept = stored.filter(F.col(number) < F.lit(last.value)).unionAll(tied)
    return kept.drop(number), path

"""Counts that come from a write's own pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation


@dataclass(frozen=True)
class Counted:
    """Counts of an observed frame, there once an action on it has finished."""

    observation: Observation
    one: DataFrame
    finish: Callable[[DataFrame], DataFrame]

    def report(self) -> DataFrame:
        """Waits for the first action on the observed frame, and returns what it counted."""
        found = self.observation.get
        row = tuple(found[c] for c in self.one.columns)
        return self.finish(self.one.sparkSession.createDataFrame([row], self.one.schema))


def counted(df: DataFrame, aggs: Sequence[Column], finish: Callable[[DataFrame], DataFrame] = lambda sums: sums) -> tuple[DataFrame, Counted]:
    """``df`` with aggregates that its next action computes as it goes, such as the write of its rows.

    ``finish`` makes the report of the one row of aggregates. The counts are those of rows that pass this point of the plan: a
    ``limit`` above it may stop them short, and a frame that an action reads twice is counted by the first that finishes.
    """
    observation = Observation()
    return df.observe(observation, *aggs), Counted(observation, df.limit(0).agg(*aggs), finish)

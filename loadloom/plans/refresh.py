"""Incremental refresh of train, test and feature tables by high-water mark."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadloom import names
from loadloom.functions.literals import to_literal, to_number
from loadloom.operators.keys import assert_key, unseen_rows
from loadloom.operators.skew import key_columns
from loadloom.sources.tables import insert_select, overwrite


def newer_than_mark(source: DataFrame, marked: DataFrame, time: str = names.TIME) -> DataFrame:
    """A1 + P6: rows strictly after the latest time of ``marked``; none if that frame is empty.

    The mark is a scalar subquery: it is computed once, and the scan of ``source`` gets it as a pushed filter.
    """
    mark = marked.agg(F.max(time).cast(source.schema[time].dataType).alias("mark")).scalar()
    return source.filter(F.col(time) > mark)


@dataclass(frozen=True)
class Refresh:
    """What a refresh would store. ``train`` holds the whole new table, the ``added`` frames what is new."""

    refreshed: bool
    train: DataFrame
    test: DataFrame
    train_added: DataFrame
    features_added: DataFrame


def plan_refresh(
    source: DataFrame,
    train: DataFrame,
    test: DataFrame,
    features: DataFrame,
    feature_columns: Sequence[str] = tuple(names.FEATURE_TABLE_SCHEMA.names),
    key: str | Sequence[str] = names.KEY,
    time: str = names.TIME,
) -> Refresh:
    """The old test rows join train, newer source rows become the test set and join the feature table.

    Keys already present are not added again, so a run repeated after a crash changes nothing. An empty test table takes
    the mark of train, which then holds all of its rows; if train is empty as well, nothing is refreshed.

    Known keys are looked for only among stored rows of the batch's own time range, since a row stored by an earlier try
    has the same time; the scans skip everything outside it.
    """
    first, mark = _range(test, time)
    if mark is None:
        first = mark = _mark(train, time)
    newer = None if mark is None else source.filter(F.col(time) > to_literal(mark, source.schema[time].dataType))
    if newer is None or newer.isEmpty():
        return Refresh(False, train, test, train.limit(0), features.limit(0))
    dtype = train.schema[time].dataType
    known = train.filter(F.col(time).between(to_literal(first, dtype), to_literal(mark, dtype)))
    train_added = _not_in(test, known, key)
    known = features.filter(F.col(time) > to_literal(mark, features.schema[time].dataType)) if time in features.columns else features
    features_added = _not_in(newer.select(*feature_columns), known, key)
    return Refresh(True, train.unionByName(train_added), newer, train_added, features_added)


def late_rows(
    source: DataFrame, train: DataFrame, test: DataFrame, key: str = names.KEY, time: str = names.TIME
) -> DataFrame:
    """Source rows at or before the mark that no table has seen: a refresh passes them over, here they can be counted."""
    mark = _mark(test, time)
    if mark is None:
        return source.limit(0)
    old = source.filter(F.col(time) <= to_literal(mark, source.schema[time].dataType))
    return unseen_rows(old, train.select(key).unionByName(test.select(key)), key)


def _range(df: DataFrame, time: str) -> tuple[int | None, int | None]:
    dtype = df.schema[time].dataType
    return tuple(df.agg(to_number(F.min(time), dtype), to_number(F.max(time), dtype)).first())


def _mark(df: DataFrame, time: str) -> int | None:
    return df.agg(to_number(F.max(time), df.schema[time].dataType)).first()[0]


def refresh_summary(
    source: DataFrame, train: DataFrame, test: DataFrame, time: str = names.TIME, key: str | Sequence[str] = names.KEY
) -> DataFrame:
    """One row: rows before and after, and the ``refreshed`` flag, from one aggregate and one count of new keys."""
    moved = unseen_rows(test, train, key).agg(F.count(F.lit(1)).alias("moved")).scalar()
    mark = test.agg(F.max(time).alias("mark"))
    newer = F.col(time) > mark.scalar()
    tagged = (
        train.select(F.lit("train").alias("part"), F.lit(False).alias("newer"))
        .unionAll(test.select(F.lit("test"), F.lit(False)))
        .unionAll(source.select(F.lit("source"), newer))
    )
    counts = tagged.agg(
        F.count_if(F.col("part") == "train").alias("train_before"),
        F.count_if(F.col("part") == "test").alias("test_before"),
        F.count_if((F.col("part") == "source") & F.col("newer")).alias("newer"),
    )
    refreshed = F.col("newer") > 0
    return counts.select(
        refreshed.cast("int").alias("refreshed"),
        "train_before",
        (F.col("train_before") + F.when(refreshed, moved).otherwise(0)).alias("train_after"),
        "test_before",
        F.when(refreshed, F.col("newer")).otherwise(F.col("test_before")).alias("test_after"),
    )


def _not_in(new: DataFrame, known: DataFrame, key: str) -> DataFrame:
    # Normally nothing of the time range is stored yet, and nothing needs to be joined.
    return new if known.isEmpty() else unseen_rows(new, known, key)


def run_refresh(
    spark: SparkSession,
    source_table: str,
    train_table: str,
    test_table: str,
    feature_table: str,
    key: str | Sequence[str] = names.KEY,
    time: str = names.TIME,
) -> int:
    """Refresh stored tables; returns 1 if anything was refreshed, else 0.

    ``plan_refresh`` plus writes. The test table is replaced last, by one switch of its location: until then its mark stands, and
    a run after a crash finds the same rows again and skips those already stored; readers find the old test rows or the new
    ones, never none. Skipping goes by key, so a batch with a NULL or repeated key is refused before anything is written.
    """
    test = spark.table(test_table)
    features = spark.table(feature_table)
    plan = plan_refresh(spark.table(source_table), spark.table(train_table), test, features, features.columns, key, time)
    if not plan.refreshed:
        return 0
    assert_key(plan.test, key_columns(key))
    assert_key(test, key_columns(key))
    plan.train_added.select(*spark.table(train_table).columns).write.insertInto(train_table)
    insert_select(plan.features_added, feature_table, features.columns)
    overwrite(plan.test.select(*test.columns), test_table)
    return 1

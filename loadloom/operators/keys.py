"""Key checks and keyed frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadloom.operators.columns import unused
from loadloom.operators.skew import fits_broadcast, key_columns, skew_safe_join
from loadloom.session import remove_at_end, scratch_path


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are NULL or occur more than once, with their number of copies.

    Counts are combined before the shuffle, so a key that holds much of the table travels as one row per task.
    """
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter((F.col("copies") > 1) | any_null)


def assert_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Fail unless the columns are a primary key; returns the frame unchanged."""
    bad = key_violations(df, keys).limit(5).collect()
    if bad:
        raise ValueError(f"{keys} is not a key, for example: {[r.asDict() for r in bad]}")
    return df


def divide_by_key(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a key of their own, and rows whose key is NULL in a column or occurs more than once.

    The offending keys are counted before the shuffle, once, when this is called, and kept below the shared scratch folder until
    the driver ends. Rows are then joined to those few keys, so a key that a third of the table shares is one row there, and where
    they fit a broadcast no row of the frame moves.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "bad_keys")
    violations = key_violations(df, keys).select(*keys)
    violations.write.parquet(path)
    remove_at_end(spark, path)
    theirs = [unused(f"_bad_{k}", df) for k in keys]
    bad = spark.read.schema(violations.schema).parquet(path)
    named = bad.select(*[F.col(k).alias(t) for k, t in zip(keys, theirs, strict=True)])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(t)) for k, t in zip(keys, theirs, strict=True)])
    present = reduce(and_, [F.col(k).isNotNull() for k in keys])
    good = skew_safe_join(df.filter(present), bad.filter(present), keys, "left_anti")
    return good.select(*[F.col(f"`{c}`") for c in df.columns]), df.join(named, same, "left_semi")


def guarded(df: DataFrame, keys: list[str], columns: Mapping[str, Column], name: str) -> DataFrame:
    """The given columns, failing at run time on a repeated or NULL key.

    The running row number needs the frame hashed and sorted by its key, which a sort-merge join on that key needs
    anyway: the check adds no shuffle and no sort, and holds one row at a time.
    """
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    message = F.lit(f"{name}: key ({', '.join(keys)}) is NULL or repeated")
    place = unused("_nth", df)
    numbered = df.withColumn(place, nth)
    return numbered.select(
        *keys,
        *[
            F.when((F.col(place) > 1) | any_null, F.raise_error(message)).otherwise(c).alias(n)
            for n, c in columns.items()
        ],
    )


def unseen_rows(new: DataFrame, existing: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key (one column or several) the other frame lacks. Only its key columns are read.

    A small batch is broadcast to that scan; a large one meets the distinct keys, formed before the shuffle. A key with a
    NULL in it equals no other, so such rows always stay.
    """
    stored = existing.select(*key_columns(key))
    return skew_safe_join(new, stored if fits_broadcast(new) else stored.distinct(), key, "left_anti")


def align_on_key(
    base: DataFrame, others: Mapping[str, DataFrame], key: str, base_columns: list[str], value: str = "prediction"
) -> DataFrame:
    """Inner join of keyed frames of numbers, as one grouping.

    Each frame adds its rows to a union, and one aggregate per key brings the columns together: one shuffle for any
    number of frames, combined before it. A key repeated in one frame fails the job rather than multiplying rows.
    Output: key, ``base_columns``, and ``<value>_<name>`` per other frame.
    """
    outs = [*base_columns, *[f"{value}_{name}" for name in others]]
    types = {c: base.schema[c].dataType for c in base_columns}
    types |= {f"{value}_{name}": frame.schema[value].dataType for name, frame in others.items()}

    def branch(frame: DataFrame, source: int, own: dict[str, Column]) -> DataFrame:
        return frame.select(
            key, F.lit(source).alias("_source"), *[own.get(c, F.lit(None).cast(types[c])).alias(c) for c in outs]
        )

    rows = branch(base, 0, {c: F.col(c) for c in base_columns})
    for i, (name, frame) in enumerate(others.items(), start=1):
        rows = rows.unionAll(branch(frame, i, {f"{value}_{name}": F.col(value)}))
    sources = range(len(others) + 1)
    grouped = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.max(c).alias(c) for c in outs],
        *[F.count_if(F.col("_source") == s).alias(f"_n{s}") for s in sources],
    )
    copies = F.greatest(*[F.col(f"_n{s}") for s in sources])
    everywhere = F.least(*[F.col(f"_n{s}") for s in sources]) >= 1
    checked = F.when(copies > 1, F.raise_error(F.lit(f"{key} is repeated within one of the joined frames")))
    return grouped.filter(everywhere).select(
        key, *[checked.otherwise(F.col(c)).alias(c) for c in outs]
    )

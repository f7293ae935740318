"""Preparation as two steps: ``fit`` takes the statistics, ``apply`` uses them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadloom import names
from loadloom.functions import calendar_parts, fill, indicators, standardise, whole
from loadloom.operators.contracts import nan_to_null

# Stands for a missing category.
MISSING_LEVEL = -1


def with_calendar(df: DataFrame, time: str = names.TIME) -> DataFrame:
    """F2-F4 as columns."""
    return df.withColumns(calendar_parts(time))


def fit(
    df: DataFrame,
    numeric: Sequence[str] = tuple(names.NUMERIC_FEATURES),
    categories: Sequence[str] = tuple(names.CATEGORIES),
    domains: Mapping[str, list[int]] | None = names.DOMAINS,
    max_levels: int = 1000,
) -> DataFrame:
    """The profile of a frame, one row per column: ``column, mean, scale, levels``.

    ``mean`` ignores missing values and is also what fills them. ``scale`` is the population deviation after filling:
    with m of n values present it is the deviation of the present ones times sqrt(m / n), so one pass gives both. A
    constant column gets scale 1. ``levels`` are the declared ones, or without a declaration those found in the frame
    (a missing value counts as level -1). Categories that are text have theirs in ``labels``, a column that is there
    only if some category is text (a missing value is then no level).
    """
    text = [c for c in categories if isinstance(df.schema[c].dataType, T.StringType)]
    values = nan_to_null(df, list(numeric))
    aggs = [F.count(F.lit(1)).alias("n")]
    rows = []
    for i, c in enumerate(numeric):
        x = values[c].cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}"), F.count(x).alias(f"c{i}")]
        deviation = F.col(f"s{i}") * F.sqrt(F.col(f"c{i}") / F.col("n"))
        scale = F.when(deviation > 0, deviation).otherwise(1.0)
        rows.append(_profile_row(c, F.col(f"m{i}"), scale, F.lit(None)))
    declared = {} if domains is None else domains
    undeclared = [c for c in categories if c not in text and c not in declared]
    for c in categories:
        if c not in undeclared and c not in text:
            levels = F.array(*[F.lit(int(v)) for v in domains[c]])
            rows.append(_profile_row(c, F.lit(None), F.lit(None), levels))
    kind = "array<struct<column:string,mean:double,scale:double,levels:array<int>>>"
    profile = df.agg(*aggs).select(F.inline(F.array(*rows).cast(kind)))
    if undeclared:
        profile = profile.unionByName(_found_levels(df, undeclared, max_levels))
    if text:
        profile = profile.withColumn("labels", F.lit(None).cast("array<string>"))
        profile = profile.unionByName(_text_levels(df, text, declared, max_levels), allowMissingColumns=True)
    return profile


def _text_levels(df: DataFrame, categories: Sequence[str], declared: Mapping[str, list], max_levels: int) -> DataFrame:
    """A7 for text: the declared labels, or the sorted ones found, at most ``max_levels`` per column."""
    given = [F.struct(F.lit(c).alias("column"), F.array(*[F.lit(str(v)) for v in declared[c]]).alias("labels")) for c in categories if c in declared]
    sought = [c for c in categories if c not in declared]
    kind = "array<struct<column:string,labels:array<string>>>"
    out = df.sparkSession.range(1).select(F.inline(F.array(*given).cast(kind)))
    if sought:
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("label")) for c in sought])
        # If the limit cuts anything off, some column has more labels than allowed and the check below fires.
        found = df.select(F.inline(pairs)).where("label is not null").distinct().limit(max_levels * len(sought) + 1)
        labels = found.groupBy("column").agg(F.array_sort(F.collect_list("label")).alias("labels"))
        message = F.concat(F.col("column"), F.lit(f" has more than {max_levels} levels"))
        checked = F.when(F.size("labels") > max_levels, F.raise_error(message)).otherwise(F.col("labels"))
        out = out.unionByName(labels.select("column", checked.alias("labels")))
    return out


def fixed(profile: DataFrame) -> DataFrame:
    """The profile with its values: the fit runs once, here, and every later use gets the same statistics.

    It has one row per column of the fitted frame and can be stored like any small table.
    """
    return profile.sparkSession.createDataFrame(profile.collect(), profile.schema)


def _profile_row(column, mean, scale, levels):
    return F.struct(
        F.lit(column).alias("column"),
        mean.cast("double").alias("mean"),
        scale.cast("double").alias("scale"),
        levels.cast("array<int>").alias("levels"),
    )


def _found_levels(df: DataFrame, categories: Sequence[str], max_levels: int) -> DataFrame:
    """The sorted levels of each column.

    Distinct values are formed before the shuffle and at most ``max_levels`` per column are gathered; more than that is
    an error, since each level becomes a column.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), fill(F.col(c).cast("int"), MISSING_LEVEL).alias("level")) for c in categories]
    )
    # If the limit cuts anything off, some column has more levels than allowed and the check below fires.
    found = df.select(F.inline(pairs)).distinct().limit(max_levels * len(categories) + 1)
    levels = found.groupBy("column").agg(F.array_sort(F.collect_list("level")).alias("levels"))
    message = F.concat(F.col("column"), F.lit(f" has more than {max_levels} levels"))
    return levels.select(
        "column",
        F.lit(None).cast("double").alias("mean"),
        F.lit(None).cast("double").alias("scale"),
        F.when(F.size("levels") > max_levels, F.raise_error(message)).otherwise(F.col("levels")).alias("levels"),
    )


def levels_of(df: DataFrame, categories: Sequence[str], max_levels: int = 1000) -> DataFrame:
    """A7 on its own: ``column, levels``."""
    return _found_levels(df, categories, max_levels).select("column", "levels")


def apply(
    df: DataFrame,
    profile: DataFrame,
    keep: Sequence[str] = (names.KEY, names.TIME, *names.TARGETS),
    cut_to_whole: Sequence[str] = tuple(names.CALENDAR),
) -> DataFrame:
    """Fill, standardise and encode by a profile; ``keep`` columns pass unchanged.

    The profile (one row per column of the frame) is read once and enters the plan as literals, so the result is one
    projection over the scan. Columns in ``cut_to_whole`` are cut to integers after standardising, as the stored tables
    have it; pass an empty list to keep the scaled values.
    """
    return df.select(*keep, *_prepared(df, profile, cut_to_whole))


def _is_category(entry: Mapping) -> bool:
    return entry["levels"] is not None or entry.get("labels") is not None


def _prepared(df: DataFrame, profile: DataFrame, cut_to_whole: Sequence[str]) -> list:
    # Numeric columns first, in profile order, then categories by name.
    entries = [e.asDict() for e in profile.collect()]
    entries.sort(key=lambda e: (_is_category(e), e["column"] if _is_category(e) else ""))
    numeric = [e["column"] for e in entries if not _is_category(e)]
    values = nan_to_null(df, numeric)
    out = []
    for e in entries:
        c = e["column"]
        if not _is_category(e):
            x = standardise(fill(values[c].cast("double"), F.lit(e["mean"]).cast("double")), e["mean"], e["scale"])
            out.append((whole(x) if c in cut_to_whole else x).alias(c))
        elif e.get("labels") is not None:
            out += [col.alias(n) for n, col in indicators(c, e["labels"]).items()]
        else:
            source = fill(F.col(c).cast("int"), MISSING_LEVEL)
            out += [col.alias(n) for n, col in indicators(c, e["levels"], source=source).items()]
    return out

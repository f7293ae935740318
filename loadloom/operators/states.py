"""Mergeable statistics of columns: a state per batch, merged without the rows it came from.

A state has one row per column: ``column, rows, present, mean, m2, low, high, levels, labels``. ``m2`` is the sum of squared
deviations from ``mean``; states of disjoint sets of rows merge exactly, in any order, so a refresh scans its new rows alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadloom import names
from loadloom.functions import fill
from loadloom.operators.contracts import nan_to_null
from loadloom.operators.prepare import MISSING_LEVEL
from loadloom.sources import tables

STATE = (
    "column string, rows bigint, present bigint, mean double, m2 double, low double, high double, levels array<int>, "
    "labels array<string>"
)
UPTO = "upto"


def state_of(
    df: DataFrame, numeric: Sequence[str] = tuple(names.NUMERIC_FEATURES), categories: Sequence[str] = tuple(names.CATEGORIES),
    max_levels: int = 1000,
) -> DataFrame:
    """The state of a frame: numbers in one aggregate, levels of categories in a second, narrow one.

    NaN counts as missing. A missing whole-number category is level -1, a missing text no level. More than ``max_levels`` levels
    are an error, since each becomes a column.
    """
    values = nan_to_null(df, list(numeric))
    aggs, rows = [F.count(F.lit(1)).alias("n")], []
    none, fields = F.lit(None), T.StructType.fromDDL(STATE).names
    for i, c in enumerate(numeric):
        x = values[c].cast("double")
        aggs += [F.count(x).alias(f"c{i}"), F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}"), F.min(x).alias(f"a{i}"), F.max(x).alias(f"b{i}")]
        squares = F.col(f"v{i}") * F.col(f"c{i}")
        values_of = (F.lit(c), F.col("n"), F.col(f"c{i}"), F.col(f"m{i}"), squares, F.col(f"a{i}"), F.col(f"b{i}"), none, none)
        rows.append(F.struct(*[v.alias(f) for v, f in zip(values_of, fields, strict=True)]))
    kind = f"array<struct<{STATE.replace(' ', ':').replace(',:', ',')}>>"
    out = df.agg(*aggs).select(F.inline(F.array(*rows).cast(kind)))
    return out.unionByName(_category_states(df, categories, max_levels)) if categories else out


def _category_states(df: DataFrame, categories: Sequence[str], max_levels: int) -> DataFrame:
    text = {c for c in categories if isinstance(df.schema[c].dataType, T.StringType)}
    null = {True: F.lit(None).cast("string"), False: F.lit(None).cast("int")}
    pairs = []
    for c in categories:
        level = null[False] if c in text else fill(F.col(c).cast("int"), MISSING_LEVEL)
        label = F.col(c) if c in text else null[True]
        pairs.append(F.struct(F.lit(c).alias("column"), level.alias("level"), label.alias("label")))
    # Counts per level are combined before the shuffle; rows of a column are their sum.
    counts = df.select(F.inline(F.array(*pairs))).groupBy("column", "level", "label").agg(F.count(F.lit(1)).alias("n"))
    found = counts.groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when((F.col("level") != MISSING_LEVEL) | F.col("label").isNotNull(), F.col("n")).otherwise(0)).alias("present"),
        F.count_if(F.col("level").isNotNull() | F.col("label").isNotNull()).alias("many"),
        F.array_sort(F.collect_list("level")).alias("levels"),
        F.array_sort(F.collect_list("label")).alias("labels"),
    )
    return _checked_levels(found, max_levels)


def _checked_levels(found: DataFrame, max_levels: int) -> DataFrame:
    message = F.concat(F.col("column"), F.lit(f" has more than {max_levels} levels"))
    refused = F.when(F.col("many") > max_levels, F.raise_error(message))
    # Also where a column has no levels at all, one of the two lists tells its kind.
    levels = F.when(F.size("levels") > 0, F.col("levels"))
    labels = F.when(F.size("levels") == 0, F.col("labels"))
    empty = F.lit(None).cast("double")
    return found.select(
        "column", "rows", "present", empty.alias("mean"), empty.alias("m2"), empty.alias("low"), empty.alias("high"),
        refused.otherwise(levels).alias("levels"), labels.alias("labels"),
    )


def merged(*states: DataFrame, max_levels: int = 1000) -> DataFrame:
    """The state of all rows behind the given ones."""
    union = states[0]
    for s in states[1:]:
        union = union.unionByName(s)
    one = F.struct("present", "mean", "m2")
    sums = union.groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.sum("present").alias("present"),
        F.sum(F.col("present") * F.col("mean")).alias("total"),
        F.collect_list(F.when(F.col("mean").isNotNull(), one)).alias("parts"),  # one per state
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.max(F.col("m2").isNotNull() | (F.col("levels").isNull() & F.col("labels").isNull())).alias("number"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("levels")))).alias("levels"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("labels")))).alias("labels"),
    )
    mean = F.when(F.col("present") > 0, F.col("total") / F.col("present"))
    sums = sums.withColumn("mean", F.when(F.size("parts") > 0, mean))
    # Deviations are moved to the common mean; sums of squares would lose their digits.
    moved = F.aggregate("parts", F.lit(0.0), lambda a, s: a + s["m2"] + s["present"] * (s["mean"] - F.col("mean")) * (s["mean"] - F.col("mean")))
    many = F.greatest(F.size("levels"), F.size("labels"))
    message = F.concat(F.col("column"), F.lit(f" has more than {max_levels} levels"))
    refused = F.when(many > max_levels, F.raise_error(message))
    return sums.select(
        "column", "rows", "present", "mean", F.when(F.size("parts") > 0, moved).alias("m2"), "low", "high",
        F.when(F.size("levels") > 0, refused.otherwise(F.col("levels"))).alias("levels"),
        F.when(~F.col("number") & (F.size("levels") == 0), refused.otherwise(F.col("labels"))).alias("labels"),
    )


def profile_of(state: DataFrame, domains: Mapping[str, list[int]] | None = names.DOMAINS) -> DataFrame:
    """What ``prepare.fit`` gives for the same rows, from their state. Declared levels replace those found."""
    # With m of n values present and the others filled by the mean, the squared deviations are those of the m.
    deviation = F.sqrt(F.col("m2") / F.col("rows"))
    number = F.col("levels").isNull() & F.col("labels").isNull()
    declared = F.lit(None).cast("array<int>")
    for c, levels in (domains or {}).items():
        declared = F.when(F.col("column") == c, F.array(*[F.lit(int(v)) for v in levels])).otherwise(declared)
    return state.select(
        "column", "mean", F.when(number, F.when(deviation > 0, deviation).otherwise(1.0)).alias("scale"),
        F.when(F.col("labels").isNull(), F.coalesce(declared, F.col("levels"))).alias("levels"), "labels",
    )


def moments_of(state: DataFrame) -> DataFrame:
    """A4: ``column, mean, deviation`` (of a sample) of the numbers of a state."""
    spread = F.when(F.col("present") > 1, F.sqrt(F.col("m2") / (F.col("present") - 1)))
    return state.where("levels is null and labels is null").select("column", "mean", spread.alias("deviation"))


def fold_new(
    spark: SparkSession, table: str, source: DataFrame, numeric: Sequence[str], categories: Sequence[str] = (),
    time: str = names.TIME, path: str | None = None, max_levels: int = 1000,
) -> int:
    """Brings a stored state up to date with rows of ``source`` later than it has seen; returns how many rows it added.

    The latest time seen is kept with the state and replaced with it in one step, so a run repeated after a crash adds nothing
    twice. The filter on time reaches the scan. Rows that come late, with a time already seen, are passed over, and rows without
    a time never count.
    """
    stored = spark.table(table) if spark.catalog.tableExists(table) else None
    seen = None if stored is None else stored.agg(F.max(UPTO)).first()[0]
    rows = source.filter(F.col(time).isNotNull())
    rows = rows if seen is None else rows.filter(F.col(time) > F.lit(seen).cast(source.schema[time].dataType))
    latest: datetime | None = rows.agg(F.max(time).cast("timestamp")).first()[0]
    if latest is None:
        return 0
    rows = rows.filter(F.col(time) <= F.lit(latest).cast(source.schema[time].dataType))  # not what arrives meanwhile
    new = spark.createDataFrame(state_of(rows, numeric, categories, max_levels).collect(), STATE)  # a row per column
    whole = new if stored is None else merged(stored.drop(UPTO), new, max_levels=max_levels)
    tables.overwrite(whole.withColumn(UPTO, F.lit(latest)).coalesce(1), table, path)
    return new.agg(F.max("rows")).first()[0]

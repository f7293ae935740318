"""M1: a declared, coercing schema, and a report of what does not fit it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadloom.operators.counting import Counted, counted

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)


def missing_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    present = set(df.columns)
    return [f.name for f in schema.fields if f.name not in present]


def nan_to_null(df: DataFrame, columns: list[str]) -> dict[str, Column]:
    """NaN counts as missing; only floating columns can hold one."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return {
        c: F.when(~F.isnan(c), F.col(c)) if isinstance(types[c], _FLOATING) else F.col(c) for c in columns
    }


def coerce(df: DataFrame, schema: T.StructType, lenient: bool = False) -> DataFrame:
    """Cast the declared columns, keep the others, turn NaN into NULL.

    A missing column is an error at once. A value that cannot be cast fails the job, or becomes NULL when ``lenient``;
    ``violations`` lists such values.
    """
    lacking = missing_columns(df, schema)
    if lacking:
        raise ValueError(f"columns missing from the frame: {lacking}")
    cleaned = nan_to_null(df, schema.names)
    return df.withColumns({f.name: _cast(df, f, cleaned[f.name], lenient) for f in schema.fields})


def _cast(df: DataFrame, field: T.StructField, value: Column, lenient: bool) -> Column:
    if df.schema[field.name].dataType == field.dataType:
        return value
    if isinstance(df.schema[field.name].dataType, T.StringType) and isinstance(field.dataType, _WHOLE):
        # '3.0' is a whole number in the source files. Through DECIMAL, since DOUBLE would blur long ones; a fraction that
        # is not zero, or more digits than the type holds, is a violation.
        number = value.try_cast("decimal(38,9)")
        found = F.coalesce(
            value.try_cast(field.dataType), F.when(number == F.floor(number), number).try_cast(field.dataType)
        )
        return found if lenient else F.coalesce(found, value.cast(field.dataType))
    return value.try_cast(field.dataType) if lenient else value.cast(field.dataType)


def violations(df: DataFrame, schema: T.StructType, key: list[str]) -> DataFrame:
    """One row per value that is present but cannot be coerced: key, column, value.

    A NOT NULL field also reports its NULLs. The frame is read once; only rows with a fault are unfolded.
    """
    lacking = missing_columns(df, schema)
    if lacking:
        raise ValueError(f"columns missing from the frame: {lacking}")
    cleaned = nan_to_null(df, schema.names)
    faults, any_bad = [], F.lit(False)
    for field in schema.fields:
        value = cleaned[field.name]
        same = df.schema[field.name].dataType == field.dataType
        if same and field.nullable:
            continue
        bad = F.lit(False) if same else value.isNotNull() & _cast(df, field, value, True).isNull()
        if not field.nullable:
            bad = bad | value.isNull()
        any_bad = any_bad | bad
        faults.append(
            F.when(bad, F.struct(F.lit(field.name).alias("column"), F.col(field.name).cast("string").alias("value")))
        )
    if not faults:
        empty = F.array().cast("array<struct<column:string,value:string>>")
        return df.select(*key, F.inline(empty))
    return df.filter(any_bad).select(*key, F.inline(F.filter(F.array(*faults), lambda x: x.isNotNull())))


def _report(df: DataFrame, schema: T.StructType) -> tuple[list[Column], list[Column]]:
    """Aggregates over the frame, and a row per declared column made of them."""
    lacking = missing_columns(df, schema)
    cleaned = nan_to_null(df, [n for n in schema.names if n not in lacking])
    aggs, rows = [F.count(F.lit(1)).alias("rows")], []
    for i, field in enumerate(schema.fields):
        if field.name in lacking:
            present, bad = F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
        else:
            value = cleaned[field.name]
            aggs += [
                F.count(value).alias(f"p{i}"),
                F.count_if(value.isNotNull() & _cast(df, field, value, True).isNull()).alias(f"b{i}"),
            ]
            present, bad = F.col(f"p{i}"), F.col(f"b{i}")
        rows.append(
            F.struct(
                F.lit(field.name).alias("column"),
                F.lit(field.dataType.simpleString()).alias("declared"),
                F.lit(field.name not in lacking).alias("found"),
                F.col("rows"),
                present.alias("present"),
                bad.alias("uncastable"),
            )
        )
    return aggs, rows


def column_report(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per declared column: rows, values present, values that cannot be coerced. One pass."""
    aggs, rows = _report(df, schema)
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def reported(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, Counted]:
    """The frame, and the ``column_report`` of the rows that its first action reads: no pass of its own."""
    aggs, rows = _report(df, schema)
    return counted(df, aggs, lambda sums: sums.select(F.inline(F.array(*rows))))


def schema_differences(actual: T.StructType, declared: T.StructType) -> dict[str, tuple[str | None, str | None]]:
    """Names whose types differ, as (actual, declared) type names; None where a side lacks the column."""
    a = {f.name: f.dataType.simpleString() for f in actual.fields}
    d = {f.name: f.dataType.simpleString() for f in declared.fields}
    return {n: (a.get(n), d.get(n)) for n in {**a, **d} if a.get(n) != d.get(n)}

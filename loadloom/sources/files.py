"""Text files and JSON records."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadloom import names
from loadloom.functions import parse_time
from loadloom.operators.columns import clean_names


def read_readings_csv(
    spark: SparkSession, path: str, schema: T.StructType, time_format: str = "M/d/yyyy H:mm"
) -> DataFrame:
    """A CSV of readings with a header: declared types, cleaned names, parsed time. No inference pass."""
    df = clean_names(spark.read.csv(path, header=True, schema=schema, enforceSchema=False))
    if isinstance(df.schema[names.TIME].dataType, T.StringType):
        df = df.withColumn(names.TIME, parse_time(names.TIME, time_format))
    return df


def as_record(df: DataFrame, columns: list[str]) -> Column:
    """A row as a JSON object."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def records(df: DataFrame, columns: list[str], into: str = "record") -> DataFrame:
    """One JSON object per row."""
    return df.select(as_record(df, columns).alias(into))


def from_records(df: DataFrame, schema: T.StructType, record: str = "record") -> DataFrame:
    """S15 back: typed columns from JSON objects."""
    return df.select(F.from_json(record, schema).alias("_r")).select("_r.*")


def from_column_split(df: DataFrame, columns: list[str], types: T.StructType, data: str = "data") -> DataFrame:
    """S15 back, for the layout of one column list and an array of value lists, all values as text."""
    rows = df.select(F.explode(data).alias("_v"))
    return rows.select(
        *[F.get("_v", F.lit(i)).cast(types[c].dataType).alias(c) for i, c in enumerate(columns)]
    )


def column_document(df: DataFrame, columns: list[str], keep: Sequence[str] = (), into: str = "document") -> DataFrame:
    """Each row as the object ``{"columns": [...], "data": [[...]]}``, values with their JSON types, beside ``keep``."""
    values = [F.to_json(F.struct(F.col(c).alias("v")), {"ignoreNullFields": "false"}) for c in columns]
    plain = [F.substring(v, 6, F.length(v) - 6) for v in values]  # what {"v":...} holds
    head = F.lit(json.dumps({"columns": list(columns)}, separators=(",", ":"))[:-1] + ',"data":[[')
    return df.select(*keep, F.concat(head, F.concat_ws(",", *plain), F.lit("]]}")).alias(into))


def from_column_document(df: DataFrame, schema: T.StructType, document: str = "document") -> DataFrame:
    """S15 back: a row for each value list, with the columns of ``schema`` taken by name from the document's own list."""
    kind = "columns array<string>, data array<array<string>>"
    opened = df.select(F.from_json(document, kind).alias("_d")).select("_d.columns", F.explode("_d.data").alias("_v"))
    at = {f.name: F.array_position("columns", f.name).cast("int") - 1 for f in schema.fields}
    return opened.select(*[F.when(at[f.name] >= 0, F.get("_v", at[f.name])).cast(f.dataType).alias(f.name) for f in schema.fields])


def column_split(df: DataFrame, columns: list[str], into: str = "values") -> DataFrame:
    """Each row as the list of its values in column order, as text; the column list is the header."""
    return df.select(F.array(*[F.col(c).cast("string") for c in columns]).alias(into))

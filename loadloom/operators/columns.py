"""Projections over whole frames (P1, P2, P5, P9, P11, P14, X1, X2, F4 mapping)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unused(name: str, *frames: DataFrame) -> str:
    """A column name like ``name`` that none of the frames has, so that users may call their columns as they like."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def clean_names(df: DataFrame) -> DataFrame:
    """P5: runs of blanks in a name become one underscore, blanks at the ends go."""
    return df.toDF(*["_".join(name.split()) for name in df.columns])


def without(df: DataFrame, excluded: Iterable[str]) -> DataFrame:
    """All columns but the named ones, in order; unknown names are ignored."""
    excluded = set(excluded)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in excluded])


def features_and_labels(df: DataFrame, features: list[str], labels: list[str]) -> tuple[DataFrame, DataFrame]:
    """The model inputs and the targets as two projections of one frame."""
    return df.select(*features), df.select(*labels)


def to_double(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One projection for all casts."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def fan_out(array: Column | str, names: list[str]) -> list[Column]:
    """Elements of an array as named columns."""
    array = F.col(array) if isinstance(array, str) else array
    return [F.get(array, F.lit(i)).alias(name) for i, name in enumerate(names)]


def stack_by_position(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of both, columns matched by position."""
    return first.unionAll(second)


def stack_by_name(*frames: DataFrame) -> DataFrame:
    """Rows of all, columns matched by name; a column one side lacks is NULL there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """P3."""
    return df.withColumnsRenamed(dict(names))

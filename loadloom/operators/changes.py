"""The change set between two versions of a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadloom import names
from loadloom.operators.keys import guarded
from loadloom.operators.skew import key_columns


def change_set(old: DataFrame, new: DataFrame, columns: Sequence[str], key: str | Sequence[str] = names.KEY) -> DataFrame:
    """Keys that were inserted, updated or deleted: key columns, ``change``, and each column before and after.

    One sort-merge join; both sides fail on a repeated key, at no extra shuffle. Two NULLs count as equal, and so do maps with
    the same entries in any order.
    """
    keys = key_columns(key)
    before = {c: F.col(c) for c in columns}
    there = {"_there": F.lit(True)}
    left = guarded(old, keys, {f"old_{c}": v for c, v in before.items()} | {"_old": there["_there"]}, "old version")
    right = guarded(new, keys, {f"new_{c}": v for c, v in before.items()} | {"_new": there["_there"]}, "new version")
    both = left.join(right, keys, "full_outer")
    same = F.lit(True)
    for c in columns:
        is_map = isinstance(old.schema[c].dataType, T.MapType)
        sides = [F.array_sort(F.map_entries(f"{s}_{c}")) if is_map else F.col(f"{s}_{c}") for s in ("old", "new")]
        same = same & sides[0].eqNullSafe(sides[1])
    change = (
        F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "delete").when(~same, "update")
    )
    return both.withColumn("change", change).filter(F.col("change").isNotNull()).drop("_old", "_new")


def as_updates(changes: DataFrame, columns: Sequence[str], version: Column, key: str | Sequence[str] = names.KEY) -> DataFrame:
    """A change set as rows for the keyed sync (T2): key columns, new values, ``version`` and ``deleted``."""
    values = [F.col(f"new_{c}").alias(c) for c in columns]
    return changes.select(*key_columns(key), *values, version.alias("version"), (F.col("change") == "delete").alias("deleted"))

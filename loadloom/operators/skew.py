"""Equi-joins of a possibly skewed frame with a frame that holds each key once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadloom.operators.columns import unused

# A key is hot when it holds more than this share of the rows (at most 1/share keys can) and at least so many of them
# that one task would feel it. It is cut into pieces of about a quarter of that, so that pieces spread evenly over tasks.
# Milder skew is left to the adaptive join.
HOT_SHARE = 0.001
HOT_ROWS = 100_000
PIECES = 4


def key_columns(key: str | Sequence[str]) -> list[str]:
    """One or several key columns as a list."""
    return [key] if isinstance(key, str) else list(key)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the planner's size estimate of the frame is within the session's broadcast threshold."""
    if not hasattr(df, "_jdf"):
        return False  # no estimate over a remote session: take the way that works for any size
    session = df.sparkSession
    limit = session._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return 0 <= int(size) <= int(limit)


@dataclass(frozen=True)
class Skew:
    """Rows of each hot key, by the hash of its columns, and rows without a key."""

    rows: Mapping[int, int]
    without_key: int = 0

    def __bool__(self) -> bool:
        return bool(self.rows) or self.without_key > HOT_ROWS


def _no_key(keys: Sequence[str]) -> Column:
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return missing


def skew_of(df: DataFrame, key: str | Sequence[str], share: float = HOT_SHARE) -> Skew:
    """The hot keys of a frame, by one counting sketch of fixed size per task over its key columns.

    The sketch only steers salting, so an estimate is enough; no key is shuffled.
    """
    keys = key_columns(key)
    if any(isinstance(df.schema[k].dataType, T.MapType) for k in keys):
        return Skew({})
    most = round(1 / share)
    row = (
        df.select(F.when(~_no_key(keys), F.xxhash64(*keys)).alias("_key"))
        .agg(
            F.expr(f"approx_top_k(_key, {most}, {most * 10}) FILTER (WHERE _key IS NOT NULL)").alias("top"),
            F.count("_key").alias("n"),
            F.count_if(F.col("_key").isNull()).alias("without"),
        )
        .first()
    )
    least = max(share * row["n"], HOT_ROWS)
    return Skew({e["item"]: e["count"] for e in row["top"] or [] if e["count"] > least}, row["without"])


def narrowed_to(table: DataFrame, wanted: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The rows of ``table`` whose key occurs in ``wanted``.

    For a ``wanted`` that fits a broadcast the planner sends its keys to the scan of ``table``; there is no hint, so
    the planner's own size limits hold.
    """
    keys = key_columns(key)
    return table.join(wanted.select(*keys).distinct(), keys, "left_semi")


def skew_safe_join(
    left: DataFrame, right: DataFrame, key: str | Sequence[str], how: str, skew: Skew | None = None
) -> DataFrame:
    """Join ``left`` to a frame with unique keys (``left``, ``left_anti``, ``left_semi`` or ``inner``).

    By the planner's size estimates:

    * a right side that fits a broadcast is left to the planner, and no row of ``left`` moves;
    * a small ``left`` is broadcast to the scan of the right side, so that only matching rows of it are shuffled;
    * otherwise hot keys of ``left`` are spread over as many pieces as their rows need and only those keys are repeated
      on the right; rows without a key are spread likewise, and every other row is joined as usual.

    ``skew`` is that of the key columns of ``left`` where the caller knows it; else it is found here.
    """
    if how not in ("left", "left_anti", "left_semi", "inner"):
        raise ValueError(how)
    keys = key_columns(key)
    if fits_broadcast(right):
        return left.join(right, keys, how)
    if fits_broadcast(left):
        return left.join(narrowed_to(right, left, keys), keys, how)
    if [left.schema[k].dataType for k in keys] != [right.schema[k].dataType for k in keys]:
        return left.join(right, keys, how)  # hashes of a key differ by type; left to the adaptive join
    skew = skew_of(left, keys) if skew is None else skew
    if not skew:
        return left.join(right, keys, how)
    number = F.coalesce(F.try_element_at(_pieces(skew), F.xxhash64(*keys)), F.lit(1))
    without = F.lit(_pieces_of(skew.without_key))
    # The salt depends on the row and the number of its task's partition: rows equal in every column part too, and a task
    # that runs again sends its rows to the same places whatever order they come in.
    spread = F.xxhash64(*[F.col(c) for c in _hashable(left)], F.spark_partition_id())
    salt = unused("_salt", left, right)
    salted = left.withColumn(salt, F.pmod(spread, F.when(_no_key(keys), without).otherwise(number)).cast("int"))
    repeated = right.withColumn(salt, F.explode(F.sequence(F.lit(0), number - 1)))
    return salted.join(repeated, [*keys, salt], how).drop(salt)


def _pieces_of(rows: int) -> int:
    return max(1, -(-rows * PIECES // HOT_ROWS))


def _pieces(skew: Skew) -> Column:
    flat = [F.lit(v) for key, rows in skew.rows.items() for v in (key, _pieces_of(rows))]
    return F.create_map(*flat).cast("map<bigint,int>")


def _hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]

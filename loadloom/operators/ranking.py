"""Order by time and key: exact positions, the temporal split, slices, first and last rows.

A position is found from counts alone. Each step counts rows per bin of the remaining range (at most a thousand or so
bins, combined before the shuffle), keeps the one bin that holds the position and looks closer. Two or three narrow
scans of one column suffice for any size, a timestamp shared by a third of the rows is only a large count, and rows are
then told apart by a plain comparison that reaches the file scan. Nothing is sorted, shuffled or numbered.

Order: time ascending, then key ascending, then a hash of the row; missing values come last.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadloom import names
from loadloom.functions.literals import has_number, to_literal, to_number
from loadloom.operators.counting import Counted, counted

BINS = 1024
# With this many rows or fewer left in a bin, their distinct values are fetched.
DIRECT = 10_000


@dataclass(frozen=True)
class Place:
    """The value at a position, how many rows sort before it, how many share it, and the position itself."""

    value: Any
    before: int
    ties: int
    rank: int


def _pick(counts: list[tuple[Any, int]], rank: int, before: int) -> Place:
    for value, n in sorted(counts):
        if before + n >= rank:
            return Place(value, before, n, rank)
        before += n
    raise ValueError(f"position {rank} is past the end")


def value_at_rank(df: DataFrame, column: str, rank: int | Callable[[int], int]) -> Place:
    """The value of ``column`` at a 1-based position in ascending order, missing values last.

    The position may depend on the number of rows, which is found on the way; a position before the first or past the
    last row is moved there. Times, dates and decimals come back as numbers (micros, days, without the point). Works for
    times, dates, integers, decimals of up to 18 digits, text and bytes.
    """
    dtype = df.schema[column].dataType
    rows = df.select(column)
    number = has_number(dtype)
    if not number and not isinstance(dtype, (T.StringType, T.BinaryType)):
        raise TypeError(f"cannot order by {column}: {dtype.simpleString()}")
    v = to_number(F.col(column), dtype) if number else F.lit(None)
    total, count, lo, hi = rows.agg(F.count(F.lit(1)), F.count(column), F.min(v), F.max(v)).first()
    asked = rank(total) if callable(rank) else rank
    if total == 0 or asked <= 0:
        return Place(None, 0, 0, 0)
    asked = min(asked, total)
    if asked > count:
        return Place(None, count, total - count, asked)
    if number:
        return _number_at_rank(rows, column, dtype, asked, count, lo, hi)
    return _text_at_rank(rows, column, dtype, asked, count)


def _number_at_rank(
    rows: DataFrame, column: str, dtype: T.DataType, rank: int, count: int, lo: int, hi: int
) -> Place:
    v = to_number(F.col(column), dtype)
    before, inside = 0, rows
    while lo < hi:
        inside = rows.filter(F.col(column).between(to_literal(lo, dtype), to_literal(hi, dtype)))
        if count <= DIRECT:
            return _pick([tuple(r) for r in inside.groupBy(v.alias("v")).count().collect()], rank, before)
        width = (hi - lo) // BINS + 1
        bins = (
            inside.withColumn("v", v)
            .groupBy(F.expr(f"v div {width}L").alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            .collect()
        )
        for b in sorted(bins, key=lambda r: r["bin"]):
            if before + b["n"] >= rank:
                count, lo, hi = b["n"], b["lo"], b["hi"]
                break
            before += b["n"]
    return Place(lo, before, count, rank)


def _text_at_rank(rows: DataFrame, column: str, dtype: T.DataType, rank: int, count: int) -> Place:
    binary = isinstance(dtype, T.BinaryType)
    text = F.col(column) if binary else F.encode(F.col(column), "UTF-8")
    before, prefix, inside = 0, b"", rows.filter(F.col(column).isNotNull())
    while True:
        if count <= DIRECT:
            found = [(bytes(v) if binary else v, n) for v, n in inside.groupBy(column).count().collect()]
            return _pick(found, rank, before)
        # Two more bytes at a time: byte order is text order, and the number of pairs is bounded.
        pair = F.hex(F.substring(text, len(prefix) + 1, 2)).alias("pair")
        for p, n in sorted(tuple(r) for r in inside.groupBy(pair).count().collect()):
            if before + n >= rank:
                count = n
                break
            before += n
        prefix += bytes.fromhex(p)
        if len(p) < 4:
            return Place(prefix if binary else prefix.decode("UTF-8"), before, count, rank)
        within = F.hex(F.substring(text, 1, len(prefix))) == F.lit(prefix.hex().upper())
        if not binary:
            within = F.col(column).startswith(prefix.decode("UTF-8", "ignore")) & within
        inside = rows.filter(within)


@dataclass(frozen=True)
class Cut:
    """Two filters that divide a frame at a position, and the copies of one row that the position falls among.

    ``first`` and ``rest`` are plain comparisons, so each reaches the scan, and no row passes both. ``copies`` of a row
    equal in every column pass neither; ``copies_first`` of them belong to the first part.
    """

    first: Column
    rest: Column
    same: Column | None = None
    copies: int = 0
    copies_first: int = 0


def cut_at(
    df: DataFrame, rank: int | Callable[[int], int], time: str = names.TIME, key: str = names.KEY
) -> Cut:
    """Divides a frame after its first ``rank`` rows in time and key order.

    Rows equal in time and key are ordered by a hash of the whole row, and rows that differ with equal hashes by their text; what is
    still equal then is a set of copies.
    """
    at = value_at_rank(df, time, rank)
    if at.rank == 0:
        return Cut(F.lit(False), F.lit(True))
    first, same, rest = _sides(F.col(time), df.schema[time].dataType, at)
    if at.before + at.ties == at.rank:
        return Cut(first | same, rest)
    text = F.to_json(F.struct(*df.columns))
    for column, dtype in ((F.col(key), df.schema[key].dataType), (row_hash(df), T.LongType()), (text, T.StringType())):
        if column is text and df.filter(same).select(text).distinct().limit(2).count() == 1:
            break
        tied = df.filter(same).select(column.alias("v"))
        at = value_at_rank(tied, "v", at.rank - at.before)
        earlier, equal, later = _sides(column, dtype, at)
        first, rest, same = first | (same & earlier), rest | (same & later), same & equal
        if at.before + at.ties == at.rank:
            return Cut(first | same, rest)
    return Cut(first, rest, same, at.ties, at.rank - at.before)


def _sides(c: Column, dtype: T.DataType, at: Place) -> tuple[Column, Column, Column]:
    """Before, at and after a place, missing values last; none of them NULL on the rows it must pass."""
    if at.value is None:
        return c.isNotNull(), c.isNull(), F.lit(False)
    here = to_literal(at.value, dtype) if has_number(dtype) else F.lit(at.value)
    return c < here, c == here, (c > here) | c.isNull()


def row_hash(df: DataFrame) -> Column:
    """A hash over all columns, whatever their types."""
    # Half the range, so that differences of two hashes stay within a LONG.
    values = [F.to_json(f.name) if isinstance(f.dataType, T.MapType) else F.col(f.name) for f in df.schema.fields]
    return F.shiftrightunsigned(F.xxhash64(*values), 1)


def _copies(df: DataFrame, cut: Cut) -> DataFrame:
    """The copies at the cut, numbered from 0 in ``_nth``: the one row, generated wherever the range is."""
    one = df.filter(cut.same).limit(1).select(F.struct(*df.columns)).scalar()
    return df.sparkSession.range(cut.copies).select(F.col("id").alias("_nth"), one.alias("_row")).select(
        "_nth", "_row.*"
    )


def _part(df: DataFrame, cut: Cut, first: bool) -> DataFrame:
    rows = df.filter(cut.first if first else cut.rest)
    if not cut.copies:
        return rows
    mine = F.col("_nth") < cut.copies_first if first else F.col("_nth") >= cut.copies_first
    return rows.unionByName(_copies(df, cut).filter(mine).drop("_nth"))


def _train_rows(test_size: float) -> Callable[[int], int]:
    # The test part gets its share of the rows rounded up.
    return lambda n: n - math.ceil(test_size * n)


def temporal_split(
    df: DataFrame, test_size: float = 0.2, time: str = names.TIME, key: str = names.KEY
) -> DataFrame:
    """A ``split`` column, ``train`` for the earlier rows and ``test`` for the later ones."""
    cut = cut_at(df, _train_rows(test_size), time, key)
    if not cut.copies:
        return df.withColumn("split", F.when(cut.first, "train").otherwise("test"))
    rows = df.filter(cut.first | cut.rest).withColumn("split", F.when(cut.first, "train").otherwise("test"))
    place = F.when(F.col("_nth") < cut.copies_first, "train").otherwise("test")
    return rows.unionByName(_copies(df, cut).withColumn("split", place).drop("_nth"))


def split_frames(
    df: DataFrame, test_size: float = 0.2, time: str = names.TIME, key: str = names.KEY
) -> tuple[DataFrame, DataFrame]:
    """W1 as two frames."""
    cut = cut_at(df, _train_rows(test_size), time, key)
    return _part(df, cut, True), _part(df, cut, False)


def split_summary(df: DataFrame, time: str = names.TIME) -> DataFrame:
    """Rows and time range of each part."""
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.min(time).alias("first_time"), F.max(time).alias("last_time")
    )


def summarised_split(df: DataFrame, time: str = names.TIME) -> tuple[DataFrame, Counted]:
    """The frame, and the ``split_summary`` of the rows that its first action reads (the write of the parts, say)."""
    aggs, rows = [], []
    for i, part in enumerate(("train", "test")):
        mine = F.col("split") == part
        at = F.when(mine, F.col(time))
        aggs += [F.count_if(mine).alias(f"n{i}"), F.min(at).alias(f"a{i}"), F.max(at).alias(f"b{i}")]
        rows.append(F.struct(F.lit(part).alias("split"), F.col(f"n{i}").alias("rows"), F.col(f"a{i}").alias("first_time"), F.col(f"b{i}").alias("last_time")))
    return counted(df, aggs, lambda sums: sums.select(F.inline(F.array(*rows))).where("rows > 0"))


def rows_between(
    df: DataFrame, start: int, stop: int, time: str = names.TIME, key: str = names.KEY
) -> DataFrame:
    """Rows at positions ``start`` (0-based) up to, not including, ``stop``, in the order of ``cut_at``.

    Which rows they are does not depend on how many; the frame itself is not sorted (``in_time_order`` does that).
    """
    if stop <= start:
        return df.limit(0)
    upto = _part(df, cut_at(df, stop, time, key), True)
    return _part(upto, cut_at(upto, start, time, key), False) if start > 0 else upto


def in_time_order(df: DataFrame, time: str = names.TIME, key: str = names.KEY) -> DataFrame:
    """O1: a range-partitioned sort; the key spreads rows that share a timestamp."""
    return df.orderBy(F.asc_nulls_last(time), F.asc_nulls_last(key))


def latest(df: DataFrame, n: int = 5, time: str = names.TIME, key: str = names.KEY) -> DataFrame:
    """O2: the last ``n`` of the rows that have a time, oldest first: cut off by counts, then sorted by ranges."""
    dated = df.filter(F.col(time).isNotNull())
    if n <= 0:
        return dated.limit(0)
    return in_time_order(_part(dated, cut_at(dated, lambda rows: max(0, rows - n), time, key), False), time, key)


def earliest(df: DataFrame, n: int = 5, time: str = names.TIME, key: str = names.KEY) -> DataFrame:
    """O3: the first ``n`` rows, oldest first: cut off by counts, then sorted by ranges."""
    if n <= 0:
        return df.limit(0)
    return in_time_order(_part(df, cut_at(df, n, time, key), True), time, key)

"""Times, dates and integers as plain numbers, and back as literals of a column's own type.

A comparison with a literal of the column's type reaches the file scan; one that needs a cast of the column does not.
Going through numbers keeps the driver's local time zone out of it.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIMES = (T.TimestampType, T.TimestampNTZType)
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def has_number(dtype: T.DataType) -> bool:
    """Whether ``to_number`` takes the type: times, dates, integers and decimals of up to 18 digits."""
    small = isinstance(dtype, T.DecimalType) and dtype.precision <= 18
    return small or isinstance(dtype, (*TIMES, T.DateType, *WHOLE))


def to_number(c: Column, dtype: T.DataType) -> Column:
    """Micros for times, days for dates, the value itself for integers, without its point for decimals."""
    if isinstance(dtype, T.DecimalType):
        return (c.cast(T.DecimalType(38, dtype.scale)) * F.lit(10**dtype.scale)).cast("long")
    if isinstance(dtype, TIMES):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("long")
    return c.cast("long")


def to_literal(value: int, dtype: T.DataType) -> Column:
    """The inverse of ``to_number``, as a literal."""
    if isinstance(dtype, TIMES):
        return F.timestamp_micros(F.lit(value)).cast(dtype)
    if isinstance(dtype, T.DateType):
        return F.date_from_unix_date(F.lit(value).cast("int"))
    if isinstance(dtype, T.DecimalType):
        return F.lit(Decimal(value).scaleb(-dtype.scale)).cast(dtype)
    return F.lit(value).cast(dtype)

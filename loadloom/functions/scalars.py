"""Numeric, indicator and digest expressions."""

from __future__ import annotations

from functools import reduce
from operator import mul

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal places kept before a scaled value is cut to an integer: a distributed mean may differ in its last bits from
# run to run, and a value next to a whole number must not change side because of that.
CUT_PLACES = 9


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def absolute_error(actual: Column | str, predicted: Column | str) -> Column:
    """F7."""
    return F.abs(_c(actual) - _c(predicted))


def product(*columns: Column | str) -> Column:
    """F8: NULL as soon as one factor is NULL."""
    return reduce(mul, [_c(c).cast("double") for c in columns])


def scaled(prediction: Column | str, factor: float = 1.3) -> Column:
    """F9."""
    return _c(prediction) * F.lit(float(factor))


def text_digest(c: Column | str) -> Column:
    """MD5 of the text form, in hex."""
    return F.md5(_c(c).cast("string"))


def digest_parity(digest: Column | str) -> Column:
    """the digest as a number, modulo 2. The last hex digit decides, 16 being even."""
    return F.conv(F.right(_c(digest), F.lit(1)), 16, 10).cast("int") % F.lit(2)


def standardise(c: Column | str, mean: Column | float, scale: Column | float) -> Column:
    """F13."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v).cast("double")
    return (_c(c) - as_col(mean)) / as_col(scale)


def fill(c: Column | str, value: Column | float | int) -> Column:
    """value in place of NULL."""
    return F.coalesce(_c(c), value if isinstance(value, Column) else F.lit(value))


def indicators(name: str, levels: list, drop_first: bool = True, source: Column | None = None) -> dict[str, Column]:
    """One 0/1 column per level; a value outside the levels, or NULL, gives all zeros."""
    c = F.col(name) if source is None else source
    kept = levels[1:] if drop_first else levels
    return {f"{name}_{level}": c.eqNullSafe(F.lit(level)).cast("int") for level in kept}


def whole(c: Column | str) -> Column:
    """towards zero."""
    return F.round(_c(c), CUT_PLACES).cast("int")

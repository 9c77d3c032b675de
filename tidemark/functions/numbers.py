"""Exact decimal arithmetic used by the money and quantity rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dec(c: Column, scale: int = 2, precision: int = 18) -> Column:
    return c.cast(f"decimal({precision},{scale})")


def truncate(c: Column, scale: int) -> Column:
    """Cut to ``scale`` digits toward zero. Expects a decimal column."""
    return F.sign(c).cast("int") * F.floor(F.abs(c), F.lit(scale))


def ratio(num: Column, den: Column) -> Column:
    """Quotient, null where the divisor is zero."""
    return F.try_divide(num, den)


def exact_sum(c: Column, scale: int = 2) -> Column:
    """Order-independent sum of a floating column, returned as a double."""
    return F.sum(dec(c, scale)).cast("double")


def number_or_null(c: Column, kind: str = "bigint") -> Column:
    return c.try_cast(kind)

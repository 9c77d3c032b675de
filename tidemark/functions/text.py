"""Text helpers whose semantics differ between SQL dialects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def matches_fully(c: Column, pattern: str) -> Column:
    """Regular-expression match of the whole string (``rlike`` only searches)."""
    return c.rlike(f"^(?:{pattern})$")


def find(needle: str, c: Column, start: int = 1) -> Column:
    """1-based position of ``needle`` in ``c`` from ``start`` on, 0 when absent."""
    return F.locate(needle, c, start)


def last_part(c: Column, sep: str) -> Column:
    """Part after the last separator."""
    return F.split_part(c, F.lit(sep), F.lit(-1))


def remove(c: Column, needle: str) -> Column:
    return F.replace(c, F.lit(needle), F.lit(""))


def pad_left(c: Column, width: int, fill: str) -> Column:
    """Left padding that never cuts a longer text."""
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, fill))


def null_if_sentinel(c: Column, sentinels: Sequence[object]) -> Column:
    """Null where the value is one of the stand-ins for "no value"."""
    return F.when(~c.isin(list(sentinels)), c)


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def parse_flag(c: Column) -> Column:
    """Y/N, 1/0, true/false texts as a boolean; anything else is False."""
    return F.coalesce(c.try_cast("boolean"), F.lit(False))

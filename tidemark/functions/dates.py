"""Date arithmetic, keys, sentinels and local time."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN_END = "9999-12-31"


def day(value: str | dt.date | Column) -> Column:
    """A date literal, or the column itself as a date."""
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)).cast("date")


def instant(value: str | dt.datetime | Column) -> Column:
    """A wall-clock literal (no zone, so no session setting changes it), or the column."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp_ntz")


def date_key(c: Column) -> Column:
    """YYYYMMDD as an integer."""
    return F.date_format(c, "yyyyMMdd").cast("int")


def first_of(c: Column, unit: str) -> Column:
    return F.trunc(c, unit)


def last_of(c: Column, unit: str) -> Column:
    """Last day of the month, quarter or year."""
    months = {"month": 1, "quarter": 3, "year": 12}[unit.lower()]
    return F.date_sub(F.add_months(F.trunc(c, unit), months), 1)


def parse_any(c: Column, formats: Sequence[str]) -> Column:
    """Timestamp from text written in one of several layouts; null if none fits."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def clamp_date(c: Column, floor: str, default: str) -> Column:
    """Dates before ``floor`` become ``floor``; null becomes ``default``."""
    return F.coalesce(F.when(c.isNotNull(), F.greatest(c.cast("date"), day(floor))), day(default))


def start_years_back(asof: str | Column, years: int) -> Column:
    """First day of the year ``years`` years before ``asof``."""
    return F.trunc(F.add_months(day(asof), -12 * years), "year")


def to_zone(ts: Column, zone: str) -> Column:
    """UTC wall-clock time as wall-clock time of ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts.cast("timestamp_ntz"))


def local_day(ts: Column, zone: str) -> Column:
    return to_zone(ts, zone).cast("date")

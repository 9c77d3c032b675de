"""Design-win funnel: roles, revenue formulas, daily snapshot."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import object_key
from tidemark.functions.numbers import truncate
from tidemark.operators.reshape import pivot_max
from tidemark.operators.snapshots import carry_forward, freeze


def percent(c: Column) -> Column:
    """``'35%'`` or ``'35'`` as 0.35; missing counts as all of it."""
    return (F.regexp_replace(F.coalesce(c, F.lit("100")), "%", "").cast("decimal(10,2)") / 100).cast("decimal(7,4)")


def unit_price(price: Column, rate: Column) -> Column:
    """Price in the base currency, cut to six digits; a missing rate is one."""
    return truncate(F.try_divide(price.cast("decimal(20,6)"), F.coalesce(rate, F.lit(1)).cast("decimal(18,6)")), 6)


def revenue(boards: Column, per_board: Column, price: Column, share: Column) -> Column:
    """Yearly boards times parts per board times price times own share, to the cent.

    Up to 10^13 parts the product is exact before it is rounded. Beyond that it is held with 38 digits, of
    which six are decimals; up to 10^10 parts per board and 10^20 parts nothing overflows.
    """
    price, share = price.cast("decimal(14,6)"), share.cast("decimal(7,4)")
    few = (boards.try_cast("decimal(15,2)") * per_board.try_cast("decimal(6,0)")).try_cast("decimal(15,2)")
    many = (boards.cast("decimal(20,2)") * per_board.cast("decimal(10,0)")).cast("decimal(22,2)")
    return F.coalesce(F.round(few * price * share, 2), F.round(many * price * share, 2))


def roles(mapping: DataFrame, key: str, names: Mapping[str, str]) -> DataFrame:
    """One user per role of each registration."""
    return pivot_max(mapping, [key], "classification", "user_id", names)


def daily_snapshot(
    delta: DataFrame,
    stored: DataFrame,
    key: str,
    day_col: str,
    today: Column,
    frozen: list[str],
    source: str,
) -> DataFrame:
    """Today's snapshot: today's rows with first-touch values frozen, and the latest
    stored rows that did not change, all keyed by (item, day, source)."""
    before = stored.where(F.col(day_col) < today)
    last = before.where(F.col(day_col) == before.agg(F.max(day_col)).scalar())
    fresh = freeze(delta, last, [key], frozen)
    rows = carry_forward(fresh, stored, [key], day_col, today)
    return rows.withColumn("funnel_key", object_key({"COL1": F.col(key), "COL2": F.col(day_col), "COL3": F.lit(source)}))

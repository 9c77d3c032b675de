"""Currency conversion in exact decimals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import truncate


def convert(amount: Column, rate: Column, scale: int = 4) -> Column:
    """``amount / rate`` cut (not rounded) to ``scale`` digits; null for a missing or zero rate."""
    quotient = F.try_divide(amount.cast("decimal(18,2)"), rate.cast("decimal(18,6)"))
    return truncate(quotient, scale)


def convert_amounts(
    facts: DataFrame, rates: DataFrame, amount: str, month: str, currency: str, targets: dict[str, str]
) -> DataFrame:
    """Add one converted amount per target currency (``output name -> currency``).

    The rates of all targets are put side by side, one row per month and source
    currency, so one lookup serves them all and never multiplies facts.
    """
    wide = rates.groupBy(F.col("month").alias("_m"), F.col("from_cur").alias("_c")).agg(
        *[F.max(F.when(F.col("to_cur") == cur, F.col("rate"))).alias(f"_r_{name}") for name, cur in targets.items()]
    )
    joined = facts.join(wide, (F.col(month) == F.col("_m")) & (F.col(currency) == F.col("_c")), "left")
    return joined.select(
        *facts.columns, *[convert(F.col(amount), F.col(f"_r_{name}")).alias(name) for name in targets]
    )

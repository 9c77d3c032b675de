"""Roll-ups of measures to calendar periods."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import dec


def rollup_to(
    facts: DataFrame,
    calendar: DataFrame,
    date: str,
    period: str,
    keys: Sequence[str],
    measures: Mapping[str, Column],
    scale: int = 2,
) -> DataFrame:
    """Sum measures by keys and calendar period.

    Facts are first summed by key and day, where the map side already removes
    most rows, and only those sums meet the calendar. Sums are exact decimals,
    returned as doubles. A day outside the calendar keeps a null period.
    """
    daily = facts.groupBy(*keys, F.col(date).cast("date").alias("_day")).agg(
        *[F.sum(dec(c, scale)).alias(n) for n, c in measures.items()]
    )
    side = calendar.select(F.col("calendar_date").alias("_cal"), period)
    return (
        daily.join(side, F.col("_day") == F.col("_cal"), "left")
        .groupBy(*keys, period)
        .agg(*[F.sum(n).cast("double").alias(n) for n in measures])
    )


def classify(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """Label of the first rule that holds."""
    out = F
    for cond, label in rules:
        out = out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))

"""A running count with a floor at zero and resets.

Rows are +1 (open), -1 (close, not below zero) or reset to zero. A run of such
steps is the map ``x -> max(x + a, l)``: ``a`` is the plain sum, ``l`` the result
when starting from zero. A reset makes the map constant. These maps compose, so
each range of a key is reduced to (a, l, constant?) and the starting count of a
range follows from the ranges before it, without walking row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.timeline import CHUNK, deal, with_carry


def floored_counter(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    step: Column,
    reset: Column,
    out: str,
    *,
    reset_to: Column | None = None,
    ranged: bool = False,
    ranges: int | None = None,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Count after each row, starting from zero.

    ``step`` is an integer. ``reset`` is a boolean that is never null; such a row
    sets the count to ``reset_to`` (zero by default, never negative).
    """
    keys, order = list(keys), list(order)
    parts = [*keys, CHUNK]
    steps = df.withColumn("_reset", reset.cast("int")).withColumn(
        "_step", F.when(reset, F.lit(0) if reset_to is None else reset_to).otherwise(step).cast("bigint")
    )

    def upto(cols, by):
        return Window.partitionBy(*cols).orderBy(*by).rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )

    # Within the range: segment after each reset, running sum, and its lowest point.
    seg = [*parts, "_seg"]

    def counted(some: DataFrame) -> DataFrame:
        return (
            some.withColumn("_seg", F.sum("_reset").over(upto(parts, order)))
            .withColumn("_a", F.sum("_step").over(upto(seg, order)))
            .withColumn("_low", F.least(F.min("_a").over(upto(seg, order)), F.lit(0)))
            .withColumn("_l", F.col("_a") - F.col("_low"))
        )

    rows, hot = deal(steps, keys, order, ranges, df if sized_by is None else sized_by) if ranged else (steps, None)
    if hot is None:
        return counted(rows.withColumn(CHUNK, F.lit(0))).select(*df.columns, F.col("_l").alias(out))

    local = counted(rows)
    end = F.max_by(F.struct("_seg", "_a", "_l"), F.struct(*order))
    ends = counted(hot).groupBy(*parts).agg(end.alias("_e")).select(*parts, "_e.*")
    # The same algebra over the ranges of a key: a range with a reset starts a segment
    # whose first value is a constant.
    seg2 = [*keys, "_s"]
    hard = F.col("_seg") > 0
    folded = (
        ends.withColumn("_s", F.sum(hard.cast("int")).over(upto(keys, [CHUNK])))
        .withColumn("_d", F.when(hard, F.col("_l")).otherwise(F.col("_a")))
        .withColumn("_sum", F.sum("_d").over(upto(seg2, [CHUNK])))
        # x_n = S_n + max(0, max_j (l_j - S_j)), S the sum of the segment so far.
        .withColumn("_lift", F.max(F.col("_l") - F.col("_sum")).over(upto(seg2, [CHUNK])))
        .withColumn("_x", F.col("_sum") + F.greatest(F.col("_lift"), F.lit(0)))
    )
    start = folded.select(
        *parts,
        F.coalesce(F.lag("_x").over(Window.partitionBy(*keys).orderBy(CHUNK)), F.lit(0)).alias("_x0"),
    )
    joined = with_carry(local, start, keys)
    value = F.when(F.col("_seg") > 0, F.col("_l")).otherwise(
        F.greatest(F.coalesce("_x0", F.lit(0)) + F.col("_a"), F.col("_l"))
    )
    return joined.select(*df.columns, value.alias(out))

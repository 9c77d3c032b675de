"""Choosing one row, or one batch, per key.

``row_number() = 1`` is the form Catalyst recognises: it puts a limit of one row
per key in front of the shuffle, so a key with billions of versions sends at
most one row per map task to its reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order``.

    State null placement in every term and end with a unique column; otherwise
    which of several equal rows survives is not defined.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def latest_batch(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """All rows that carry their key's newest ``ts``; ties are kept.

    The maximum is pre-aggregated on the map side and joined back. A window
    would send a whole key to one task; here a hot key is split by the skew join.
    Rows with a null ``ts`` are kept only for keys that have no other.
    """
    newest = df.groupBy(*keys).agg(F.max(ts).alias("_max"))
    on = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    on.append(F.col(f"l.{ts}").eqNullSafe(F.col("r._max")))
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return df.alias("l").join(newest.alias("r"), cond, "left_semi")


def latest_slice(df: DataFrame, column: str) -> DataFrame:
    """Rows at the overall largest value of ``column``."""
    top = df.agg(F.max(column).alias("top"))
    return df.where(F.col(column) == top.scalar())


def prefer_first(sources: Sequence[DataFrame], keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key over several sources; an earlier source always wins."""
    ranked = [s.withColumn("source_rank", F.lit(i + 1)) for i, s in enumerate(sources)]
    out = ranked[0]
    for r in ranked[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    return latest(out, keys, [F.col("source_rank").asc(), *order])

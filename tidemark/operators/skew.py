"""Joining rows to one row per key when a key may be hot.

Adaptive execution splits a hot partition of a sort-merge join only if both inputs
come straight from a shuffle. An input that was just grouped or deduplicated by the
join key needs no further shuffle, and the split is silently skipped: the hot key
stays in one task. Joining also on a hash of the key asks for a shuffle of the
grouped side too. That side has one row per key, so the extra shuffle is small, and
the rows of a hot key are then read by many tasks. Three bits of the hash do: the keys
are compared anyway, and a whole hash in each shuffled row does not compress.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPREAD = "_spread"


def spread(keys: Sequence[Column | str]) -> Column:
    return F.xxhash64(*keys).bitwiseAND(F.lit(7)).cast("tinyint").alias(SPREAD)


def attach(df: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``df`` to a relation with one row per key (aggregate, distinct, latest)."""
    keys = list(keys)
    left = df.select("*", spread(keys))
    right = per_key.select("*", spread(keys))
    return left.join(right, [*keys, SPREAD], how).drop(SPREAD)

"""Pivot, unpivot and token rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_max(
    df: DataFrame, keys: Sequence[str], name: str, value: str, names: Mapping[str, str]
) -> DataFrame:
    """Named values to columns. The names are given, so no extra pass looks for them."""
    cols = [F.max(F.when(F.col(name) == n, F.col(value))).alias(out) for out, n in names.items()]
    return df.groupBy(*keys).agg(*cols)


def unpivot(
    df: DataFrame, ids: Sequence[str], columns: Mapping[str, Column], name: str, value: str
) -> DataFrame:
    """Columns to rows; null values give no row. Narrow: one pass, no shuffle."""
    entries = [F.struct(F.lit(n).alias(name), c.alias(value)) for n, c in columns.items()]
    return (
        df.select(*ids, F.explode(F.array(*entries)).alias("_e"))
        .select(*ids, F.col("_e." + name), F.col("_e." + value))
        .where(F.col(value).isNotNull())
    )


def unpivot_pair(
    df: DataFrame,
    ids: Sequence[str],
    pairs: Mapping[str, tuple[Column, Column]],
    name: str,
    value: str,
    note: str,
) -> DataFrame:
    """Two parallel column groups to rows: a value with its description.

    Rows need a value; the description may be null.
    """
    entries = [
        F.struct(F.lit(n).alias(name), v.alias(value), d.alias(note)) for n, (v, d) in pairs.items()
    ]
    return (
        df.select(*ids, F.explode(F.array(*entries)).alias("_e"))
        .select(*ids, *[F.col("_e." + c) for c in (name, value, note)])
        .where(F.col(value).isNotNull())
    )


def pick_column(name: Column, mapping: Mapping[str, Column]) -> Column:
    """The column a reference row names; null for an unknown name."""
    out = F.lit(None)
    for n, c in reversed(list(mapping.items())):
        out = F.when(name == n, c).otherwise(out)
    return out


def explode_tokens(df: DataFrame, column: str, separators: str, out: str) -> DataFrame:
    """One row per non-empty token; ``separators`` is a regular expression."""
    return df.withColumn(out, F.explode(F.split(column, separators))).where(F.col(out) != "")

"""Change filters and periodic snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import day, local_day
from tidemark.functions.hashing import object_key
from tidemark.operators.dedup import latest


def changed(src: DataFrame, target: DataFrame, keys: Sequence[str], hash_col: str) -> DataFrame:
    """Source rows that are new or whose hash differs from the target's.

    Only the key and hash of the target are read. A null hash counts as no match
    on neither side: ``<>`` with null is not a difference.
    """
    t = target.select(*keys, F.col(hash_col).alias("_h"), F.lit(True).alias("_in"))
    joined = src.join(t, list(keys), "left")
    return joined.where(F.col("_in").isNull() | F.col("_h").isNull() | (F.col("_h") != F.col(hash_col))).select(
        *src.columns
    )


def current_weeks(calendar: DataFrame, now: Column, zone: str, week: str, date: str) -> DataFrame:
    """Week keys of the UTC day and of the local day; two of them around midnight."""
    utc = now.cast("date")
    return (
        calendar.where((F.col(date) == utc) | (F.col(date) == local_day(now, zone)))
        .select(week)
        .distinct()
    )


def weekly_snapshot(
    staging: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    weeks: Sequence[Column],
    week_col: str = "snapshot_week_key",
    key_col: str = "snapshot_key",
) -> DataFrame:
    """Newest row of each key, stamped with the current week(s) and keyed by both.

    ``weeks`` are one or two scalar columns; equal ones count once. Partition the
    snapshot table by the week so a re-run replaces that week only.
    """
    newest = latest(staging, keys, order)
    stamped = newest.withColumn(week_col, F.explode(F.array_distinct(F.array(*weeks))))
    return stamped.withColumn(
        key_col, object_key({"COL1": F.col(week_col), **{f"COL{i + 2}": F.col(k) for i, k in enumerate(keys)}})
    )


def carry_forward(
    delta: DataFrame, snapshots: DataFrame, keys: Sequence[str], day_col: str, today: str | Column
) -> DataFrame:
    """Today's snapshot: the delta, plus the latest snapshot's rows it does not replace."""
    today_c = F.lit(today) if not isinstance(today, Column) else today
    before = snapshots.where(F.col(day_col) < today_c)
    prev = before.where(F.col(day_col) == before.agg(F.max(day_col)).scalar())
    kept = prev.join(delta.select(*keys), list(keys), "left_anti").withColumn(day_col, today_c)
    return delta.withColumn(day_col, today_c).unionByName(kept, allowMissingColumns=True)


def freeze(delta: DataFrame, target: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Keep the target's value of ``cols`` once it is set."""
    t = target.select(*keys, *[F.col(c).alias("_t_" + c) for c in cols])
    joined = delta.join(t, list(keys), "left")
    return joined.select(
        *[F.coalesce(F.col("_t_" + c), F.col(c)).alias(c) if c in cols else F.col(c) for c in delta.columns]
    )


def archive(df: DataFrame, key_parts: Mapping[str, Column], asof: str, key_col: str = "archive_key") -> DataFrame:
    """Full copy of a dimension for one day. Write it partitioned by ``snapshot_date``."""
    return df.withColumn("snapshot_date", day(asof)).withColumn(
        key_col, object_key({**key_parts, "DAY": F.col("snapshot_date")})
    )


def daily_open_items(df: DataFrame, is_open: Column, asof: str, ages: Mapping[str, Column]) -> DataFrame:
    """Open items of a day with their ages in days since the given dates."""
    out = df.where(is_open).withColumn("snapshot_date", day(asof))
    for name, since in ages.items():
        out = out.withColumn(name, F.datediff(day(asof), since))
    return out

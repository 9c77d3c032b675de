"""Lead-time facts and the run bucket bridge."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.dedup import latest


def bucket_sequence(runs: DataFrame, run: str, out: str) -> DataFrame:
    """0 for the newest run, then -1, -2, …

    One row per planning run after the distinct, so a single window partition is
    enough: runs are dates, at most one per day.
    """
    w = Window.orderBy(F.col(run).desc())
    return runs.select(run).distinct().withColumn(out, 1 - F.row_number().over(w))


def leadtime_fact(staging: DataFrame, part: str, run: str, order) -> DataFrame:
    """Newest row per part and planning run."""
    return latest(staging, [part, run], order)


def with_buckets(fact: DataFrame, run: str) -> DataFrame:
    """The fact with the relative position of its run."""
    return fact.join(bucket_sequence(fact, run, "bucket"), run)

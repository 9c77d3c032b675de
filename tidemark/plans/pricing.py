"""Price worksheet history: two dated price sources as one time line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import day
from tidemark.functions.hashing import object_key
from tidemark.operators.history import merge_timelines, version_status


def price_history(book: DataFrame, points: DataFrame, asof: str, deleted: Column) -> DataFrame:
    """Versions with both prices, status and whether the part is in the book for the first time.

    ``book``: ``part_id, effective_from, effective_to, price_a``; ``points`` the
    same with ``price_b``.
    """
    named = book.withColumn("book_from", F.col("effective_from"))
    line = merge_timelines(
        named, points, "part_id", "effective_from", "effective_to", ["price_a", "book_from"], ["price_b"],
        ranged=True,
    )
    firsts = book.groupBy("part_id").agg(F.min("effective_from").alias("_first"))
    newest = book.agg(F.max("effective_from")).scalar()
    status = version_status(F.col("effective_from"), F.col("effective_to"), deleted, day(asof), newest)
    return line.join(firsts, "part_id", "left").select(
        object_key({"COL1": F.col("part_id"), "COL2": F.col("effective_from")}).alias("price_key"),
        "part_id",
        "effective_from",
        "effective_to",
        F.col("price_a").cast("double").alias("price_a"),
        F.col("price_b").cast("double").alias("price_b"),
        status.alias("status"),
        F.coalesce(F.col("book_from") == F.col("_first"), F.lit(False)).alias("is_first_price"),
    )

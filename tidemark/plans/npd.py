"""New-product age buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import OPEN_END, day

FIRST_DAY = "1990-01-01"
# Age bucket: years after the definition date it starts and ends (fixed values).
BUCKETS = [
    ("New Request", None, 0),
    ("0 to 3 years", 0, 3),
    ("3 to 5 years", 3, 5),
    ("5 to 7 years", 5, 7),
    ("7 to 10 years", 7, 10),
    ("Greater than 10 years", 10, None),
]


def start_date(defined: Column) -> Column:
    """31 December starts a day later; unknown or ancient dates start on 2 January 1990."""
    last_day = (F.month(defined) == 12) & (F.dayofmonth(defined) == 31)
    return F.when(
        defined > day(FIRST_DAY), F.when(last_day, F.date_add(defined, 1)).otherwise(defined)
    ).otherwise(day("1990-01-02"))


def bucket_timeline(parts: DataFrame, products: DataFrame) -> DataFrame:
    """Six dated buckets per part of either master.

    ``parts``: ``part_id, defined_on``; ``products``: ``part_id``. The buckets are a
    literal array exploded in place, so the only shuffle is the master merge.
    """
    both = parts.join(products, "part_id", "full_outer").withColumn("_s", start_date(F.col("defined_on")))
    s = F.col("_s")

    def after(years: int) -> Column:
        return F.add_months(s, 12 * years)

    rows = []
    for name, lo, hi in BUCKETS:
        begin = day(FIRST_DAY) if lo is None else after(lo) if lo else s
        end = day(OPEN_END) if hi is None else F.date_sub(after(hi), 1)
        rows.append(
            F.struct(F.lit(name).alias("npd_bucket"), begin.alias("effective_from"), end.alias("effective_to"))
        )
    return both.select("part_id", F.explode(F.array(*rows)).alias("_b")).select("part_id", "_b.*")

"""Type-2 history.

A history table is the source row plus ``valid_from`` (date), ``valid_to``
(timestamp, null while open), ``updated_at`` and ``version_id``. The source has
one row per key and run, dated by ``updated_at`` at day grain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import OPEN_END, day, instant
from tidemark.functions.hashing import version_id
from tidemark.operators.timeline import Step, deal, scan_dealt

HISTORY = ["valid_from", "valid_to", "updated_at", "version_id"]


def _dated(src: DataFrame, keys: Sequence[str], updated_at: Column) -> DataFrame:
    day = updated_at.cast("date")
    return (
        src.withColumn("valid_from", day)
        .withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))
        .withColumn("updated_at", day)
        .withColumn("version_id", version_id(*[F.col(k) for k in keys], day))
    )


def init(src: DataFrame, keys: Sequence[str], updated_at: Column) -> DataFrame:
    """First build: every row is open from its update date."""
    return _dated(src, keys, updated_at)


def apply(
    history: DataFrame,
    src: DataFrame,
    keys: Sequence[str],
    updated_at: Column,
    *,
    row_hash: str | None = None,
    check_cols: Sequence[str] | None = None,
    hard_deletes_at: str | None = None,
) -> DataFrame:
    """The history after one load.

    * key without an open row: the source row opens a version;
    * newer date (or, with ``check_cols``, any listed column differs, null-safe):
      the open row is closed the day before and a new version opens;
    * same date and another ``row_hash``: the open row is overwritten in place;
    * ``hard_deletes_at``: open rows whose key left the source close at that time.

    A version id that exists already is never inserted again, so a key closed by
    delete that returns with the same date stays closed.

    One full outer join of the open rows with the source; closed rows pass by.
    """
    keys = list(keys)
    payload = [c for c in src.columns if c not in keys]
    new = _dated(src, keys, updated_at)
    history = history.select(
        *history.columns,
        *[F.lit(None).cast(src.schema[c].dataType).alias(c) for c in payload if c not in history.columns],
    )
    gone_cols = [c for c in history.columns if c not in new.columns]
    added = [c for c in payload if c not in history.columns]
    cols = [*keys, *payload, *gone_cols, *HISTORY]

    def packed(df: DataFrame, name: str) -> DataFrame:
        have = set(df.columns)
        fields = [
            (F.col(c) if c in have else F.lit(None).cast(history.schema[c].dataType)).alias(c) for c in cols
        ]
        return df.select(*[F.col(k).alias(k) for k in keys], F.struct(*fields).alias(name))

    closed = history.where(F.col("valid_to").isNotNull()).select(*cols)
    open_rows = packed(history.where(F.col("valid_to").isNull()), "o")
    source = packed(new, "n")
    # Versions that exist and are closed: their ids must not open again.
    spent = closed.select(F.col("version_id").alias("_spent")).distinct()
    both = open_rows.join(source, keys, "full_outer").join(
        spent, F.col("n.version_id") == F.col("_spent"), "left"
    )

    o, n = F.col("o"), F.col("n")
    matched = o.isNotNull() & n.isNotNull()
    if check_cols is not None:
        differs = F.lit(bool(added))
        for c in check_cols:
            differs = differs | ~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
        newer = matched & differs
    else:
        newer = matched & (F.col("o.valid_from") < F.col("n.updated_at"))
    newer = F.coalesce(newer, F.lit(False))
    fresh = o.isNull() | newer
    opens = F.when(fresh & F.col("_spent").isNull(), n)

    end_of_old = F.date_sub(F.col("n.updated_at"), 1).cast("timestamp_ntz")
    kept = o
    if row_hash and check_cols is None:
        same_day = (F.col("o.valid_from") == F.col("n.updated_at")) & (
            F.col(f"o.{row_hash}") != F.col(f"n.{row_hash}")
        )
        kept = F.when(F.coalesce(matched & same_day, F.lit(False)), n).otherwise(kept)
    kept = F.when(newer, o.withField("valid_to", end_of_old)).otherwise(kept)
    if hard_deletes_at is not None:
        kept = F.when(
            o.isNotNull() & n.isNull(), o.withField("valid_to", instant(hard_deletes_at))
        ).otherwise(kept)
    rows = both.select(F.explode(F.array(kept, opens)).alias("r")).where(F.col("r").isNotNull())
    return closed.unionByName(rows.select("r.*"))


def expire_open(target: DataFrame, stage: DataFrame, keys: Sequence[str], start: str, end: str, status: str) -> DataFrame:
    """Close the open version before each newly staged one and mark it expired.

    The stage has one row per key; a target row is closed when it is open and
    starts earlier.
    """
    s = stage.select(*keys, F.col(start).alias("_next"))
    joined = target.join(s, list(keys), "left")
    hit = F.coalesce(
        (F.col(start) < F.col("_next")) & (F.col(end) >= F.col("_next")), F.lit(False)
    )
    return joined.select(
        *[
            F.when(hit, F.date_sub("_next", 1)).otherwise(F.col(c)).alias(c) if c == end
            else F.when(hit, F.lit("Expired")).otherwise(F.col(c)).alias(c) if c == status
            else F.col(c)
            for c in target.columns
        ]
    )


def merge_timelines(
    first: DataFrame,
    second: DataFrame,
    key: str,
    start: str,
    end: str,
    first_cols: Sequence[str],
    second_cols: Sequence[str],
    *,
    ranged: bool = False,
) -> DataFrame:
    """One time line from two effective-dated ones.

    Every change date of either source starts a version; it carries what each
    source had in force on that date. Both payloads are put on one line of dates and
    carried forward together, one pass where a range join per source is not linear.
    Versions of one source must not overlap.
    """
    def side(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
        return df.select(key, start, F.struct(F.col(end).alias("_end"), *cols).alias(name))

    line = side(first, first_cols, "_p1").unionByName(side(second, second_cols, "_p2"), allowMissingColumns=True)
    # dealt by key before rows of a date are put together: both need one sort, of a bounded number of rows
    rows, hot = deal(line, [key], [start]) if ranged else (line, None)

    def dates(some: DataFrame) -> DataFrame:
        by = [c for c in some.columns if c not in ("_p1", "_p2")]
        return some.groupBy(*by).agg(F.max("_p1").alias("_p1"), F.max("_p2").alias("_p2"))

    out = scan_dealt(
        dates(rows),
        None if hot is None else dates(hot),
        [key],
        [start],
        {"_a": Step("last", "_p1"), "_b": Step("last", "_p2"), "_next": Step("lead", start)},
    )

    def in_force(box: str, cols: Sequence[str]) -> list[Column]:
        live = F.col(start) <= F.col(box + "._end")
        return [F.when(live, F.col(f"{box}.{c}")).alias(c) for c in cols]

    return out.select(
        key,
        start,
        F.coalesce(F.date_sub("_next", 1), day(OPEN_END)).alias(end),
        *in_force("_a", first_cols),
        *in_force("_b", second_cols),
    )


def version_status(start: Column, end: Column, deleted: Column, asof: Column, staged_upto: Column) -> Column:
    """Staged, Current, Deleted or Expired, decided in this order."""
    return (
        F.when(start > asof, "Staged")
        .when((start <= staged_upto) & (end >= asof), "Current")
        .when(F.coalesce(deleted, F.lit(False)), "Deleted")
        .otherwise("Expired")
    )

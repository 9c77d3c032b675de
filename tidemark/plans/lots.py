"""Lot tracking: completed transactions, derived flags, hold counter, lot state, aging.

Lots are followed by transaction id, which grows with time. A lot with any number of
transactions is cut into ranges (see ``timeline``) and spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import date_key, local_day
from tidemark.functions.hashing import surrogate_key
from tidemark.operators import joins, timeline
from tidemark.operators.counter import floored_counter
from tidemark.operators.skew import attach
from tidemark.operators.snapshots import daily_open_items
from tidemark.operators.timeline import Step

MOVES = ["SplitLot", "CombineLot", "ConsumeLot"]
HOLD, RELEASE, RELEASE_ALL = "HoldLot", "ReleaseLot", "ReleaseAll"
CLOSED = ["CLOSED", "TERMINATED"]


def complete(txns: DataFrame) -> DataFrame:
    """Transactions with their net change, plus a generated row for the source lot of
    every split, combine and consume.

    ``txns``: ``txn_id, lot, txn_type, from_lot, location, boh, eoh, boh_from, eoh_from``.
    The generated row takes the source lot's state from its newest earlier
    transaction; without one there is no generated row.
    """
    own = txns.select(
        "txn_id", "lot", "txn_type", "location", "boh", "eoh",
        F.when(F.col("txn_type") == "CreateLot", F.col("eoh")).otherwise(F.col("eoh") - F.col("boh")).alias("net_change"),
        F.lit(None).cast(txns.schema["lot"].dataType).alias("to_lot"),
        F.lit(False).alias("is_generated"),
    )
    moves = txns.where(F.col("txn_type").isin(MOVES) & F.col("from_lot").isNotNull()).select(
        "txn_id", "txn_type", F.col("from_lot").alias("src"), F.col("lot").alias("to_lot"), "boh_from", "eoh_from"
    )
    states = txns.select(F.col("lot").alias("src"), F.col("txn_id").alias("src_txn"), F.col("location").alias("src_location"))
    matched = joins.asof_join(
        moves, states, ["src"], "txn_id", "src_txn", ["src_txn", "src_location"], allow_equal=False, ranged=True
    ).where(F.col("src_txn").isNotNull())
    made = matched.select(
        "txn_id", F.col("src").alias("lot"), "txn_type", F.col("src_location").alias("location"),
        F.col("boh_from").alias("boh"), F.col("eoh_from").alias("eoh"),
        (F.col("eoh_from") - F.col("boh_from")).alias("net_change"), "to_lot", F.lit(True).alias("is_generated"),
    )
    return own.unionByName(made)


def derive(txns: DataFrame, stored: DataFrame, stages: DataFrame) -> DataFrame:
    """Flags of each new transaction.

    ``txns``: ``txn_id, lot, txn_type, location, lot_state, lot_category, stage_set, at``;
    ``stored``: already derived ``lot, txn_id, location``; ``stages``: ``stage_set, country``.

    A move-in is a location other than the one before. For the first new row of a
    lot seen before, the one before is its newest stored location.
    ``hold_count`` is 1 inside a hold, 0 outside, and left open (null) for the hold
    and release rows themselves.
    """
    marked, steps, open_holds = joins.open_count(
        txns, ["lot"], "txn_id", F.col("txn_type") == HOLD, F.col("txn_type") == RELEASE
    )
    steps |= {"_before": Step("lag", "location"), "_before_id": Step("lag", "txn_id")}
    df = timeline.scan(marked, ["lot"], ["txn_id"], steps, ranged=True, sized_by=txns)
    df = df.withColumn("open_holds", open_holds)
    last = stored.groupBy("lot").agg(F.max_by("location", "txn_id").alias("_stored"))
    df = joins.enrich(attach(df, last, ["lot"]), [(stages, {"stage_set": "stage_set"}, {"country": "country"})])
    first = F.col("_before_id").isNull()
    came_from = F.when(first, F.col("_stored")).otherwise(F.col("_before"))
    marker = F.col("txn_type").isin(HOLD, RELEASE)
    return df.select(
        *txns.columns,
        "country",
        (F.col("lot_state") == "INTRANSIT").alias("is_in_transit"),
        (F.col("lot_state") == "WAIT").alias("is_hold"),
        (F.col("lot_category") == "REWORK").alias("is_rework"),
        F.when(~marker, (F.col("open_holds") > 0).cast("int")).alias("hold_count"),
        F.when(F.col("location") != came_from, F.col("at")).alias("move_in_at"),
    )


def hold_counts(derived: DataFrame) -> DataFrame:
    """Running hold count of hold and release rows.

    ``derived``: ``lot, txn_id, txn_type, reason, hold_count``. A run of such rows
    starts after a row of another type and continues from its count: a hold adds
    one, a release takes one off (not below zero), a release of all, or without a
    reason, sets zero. Runs at the very start of a lot are not counted.
    """
    df = timeline.scan(
        derived.select("lot", "txn_id", "txn_type", "reason", "hold_count"),
        ["lot"],
        ["txn_id"],
        {"_type": Step("lag", "txn_type"), "_count": Step("lag", "hold_count")},
        ranged=True,
    )
    rows = df.where(F.col("txn_type").isin(HOLD, RELEASE) & F.col("hold_count").isNull())
    seed = F.coalesce(~F.col("_type").isin(HOLD, RELEASE), F.lit(False))
    start = F.coalesce("_count", F.lit(0))
    one_off = (F.col("txn_type") == RELEASE) & F.coalesce(F.col("reason") != RELEASE_ALL, F.lit(False))
    cleared = (F.col("txn_type") == RELEASE) & ~one_off
    seeded = F.when(F.col("txn_type") == HOLD, start + 1).when(one_off & (start > 0), start - 1).otherwise(0)
    # Rows before the first seed of a lot carry a null marker through.
    rows = rows.withColumn("_seed", seed.cast("bigint"))
    rows = floored_counter(
        rows, ["lot"], ["txn_id"],
        F.when(F.col("txn_type") == HOLD, 1).otherwise(-1),
        (F.col("_seed") == 1) | cleared,
        "_n",
        reset_to=F.when(F.col("_seed") == 1, seeded).otherwise(0),
        ranged=True,
    )
    firsts = rows.where(F.col("_seed") == 1).groupBy("lot").agg(F.min("txn_id").alias("_from"))
    return (
        attach(rows, firsts, ["lot"], "inner")
        .where(F.col("txn_id") >= F.col("_from"))
        .select("lot", "txn_id", "txn_type", "reason", F.col("_n").cast("int").alias("hold_count"))
    )


def lot_state(txns: DataFrame, attributes: list[str], planned: list[str]) -> DataFrame:
    """One row per lot: last known attributes and the state of its newest transaction.

    ``txns``: ``lot, at, txn_id, location, lot_state, wafers, dies`` and the columns
    named in ``attributes`` (last non-null value over the whole lot) and ``planned``
    (largest value within the last unbroken stay at one location). All of it is
    aggregation by lot, combined on the map side; only the stay numbers need order.
    """
    order = ["at", "txn_id"]
    stays = timeline.change_event(txns, ["lot"], order, "location", "stay", ranged=True)
    active = ~((F.col("wafers") == 0) & (F.col("dies") == 0))
    per_stay = stays.groupBy("lot", "stay").agg(
        *[F.max(c).alias(c) for c in planned],
        *[F.max(F.when(F.col(c).isNotNull(), F.struct(*order, F.col(c).alias("v")))).alias(c) for c in [*attributes, "lot_state"]],
        F.max(F.struct(*order, "location", "wafers", "dies", active.alias("active"))).alias("_last"),
    )
    latest = F.max(F.struct("stay", "_last", *planned)).alias("_end")
    lots = per_stay.groupBy("lot").agg(
        latest, *[F.max(c).getField("v").alias(c) for c in [*attributes, "lot_state"]]
    )
    end = F.col("_end._last")
    is_active = end.getField("active")
    closed = F.col("lot_state").isin(CLOSED)
    repaired = (
        F.when(is_active & closed, F.lit(False))
        .when(~is_active & ~closed & (end.getField("wafers") != 0) & (end.getField("dies") != 0), F.lit(True))
        .otherwise(is_active)
    )
    return lots.select(
        "lot",
        end.getField("txn_id").alias("last_txn_id"),
        end.getField("at").alias("updated_at"),
        end.getField("location").alias("location"),
        F.col("_end.stay").alias("location_changes"),
        *[F.col("_end." + c).alias(c) for c in planned],
        "lot_state",
        *attributes,
        end.getField("wafers").alias("wafers"),
        repaired.alias("is_active"),
    )


def wip_aging(lots: DataFrame, asof: str, zone: str) -> DataFrame:
    """Active lots of a day with their hold and move ages in local days.

    ``lots``: ``lot, location, wafers, is_active, hold_at, moved_at``.
    """
    out = daily_open_items(
        lots, F.col("is_active"), asof,
        {"hold_age_days": local_day(F.col("hold_at"), zone), "move_age_days": local_day(F.col("moved_at"), zone)},
    )
    return out.select(
        "lot",
        date_key(F.col("snapshot_date")).alias("snapshot_date_key"),
        surrogate_key(F.col("lot")).alias("lot_key"),
        surrogate_key(F.col("location")).alias("location_key"),
        "wafers", "hold_age_days", "move_age_days",
    )

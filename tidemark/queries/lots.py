"""Lot tracking on events: user = lot, event type = transaction type and location."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import instant
from tidemark.plans import lots
from tidemark.queries.registry import Tables, query
from tidemark.session import cut_lineage

MAPPED_SQL = """t AS (SELECT event_id AS txn_id, user_id AS lot, ts AS tm,
  CASE event_type WHEN 'error' THEN 'HoldLot' WHEN 'purchase' THEN 'ReleaseLot' WHEN 'signup' THEN 'CreateLot' WHEN 'click' THEN 'SplitLot' ELSE 'MoveLot' END AS txn_type,
  CASE WHEN event_type = 'click' THEN CAST(regexp_extract(props, '[0-9]+') AS BIGINT) END AS from_lot, event_type AS location,
  CAST(value AS DECIMAL(18,2)) AS eoh, CAST(regexp_extract(props, '[0-9]+') AS DECIMAL(18,2)) AS boh, value FROM events)"""


def transactions(t: Tables) -> DataFrame:
    e = F.col("event_type")
    digits = F.regexp_substr("props", F.lit("[0-9]+"))
    kind = (
        F.when(e == "error", lots.HOLD).when(e == "purchase", lots.RELEASE).when(e == "signup", "CreateLot")
        .when(e == "click", "SplitLot").otherwise("MoveLot")
    )
    return t.events.select(
        F.col("event_id").alias("txn_id"), F.col("user_id").alias("lot"), F.col("ts").alias("at"), kind.alias("txn_type"),
        F.when(e == "click", digits.cast("bigint")).alias("from_lot"), e.alias("location"),
        F.col("value").cast("decimal(18,2)").alias("eoh"), digits.cast("decimal(18,2)").alias("boh"), "value",
    )


@query(
    "completed_transactions",
    f"""WITH {MAPPED_SQL},
g AS (SELECT * FROM (SELECT r.txn_id, s.lot, r.txn_type, s.location, r.boh, r.eoh, r.eoh - r.boh AS net_change, r.lot AS to_lot, true AS is_generated,
  ROW_NUMBER() OVER (PARTITION BY r.txn_id ORDER BY s.txn_id DESC) AS rn FROM t r JOIN t s ON r.from_lot = s.lot AND r.txn_id > s.txn_id WHERE r.txn_type = 'SplitLot') WHERE rn = 1)
SELECT txn_id, lot, txn_type, location, CAST(boh AS DOUBLE) AS boh, CAST(eoh AS DOUBLE) AS eoh,
  CAST(CASE WHEN txn_type = 'CreateLot' THEN eoh ELSE eoh - boh END AS DOUBLE) AS net_change, CAST(NULL AS BIGINT) AS to_lot, false AS is_generated FROM t
UNION ALL SELECT txn_id, lot, txn_type, location, CAST(boh AS DOUBLE), CAST(eoh AS DOUBLE), CAST(net_change AS DOUBLE), to_lot, is_generated FROM g""",
)
def completed_transactions(t: Tables) -> DataFrame:
    rows = transactions(t).select("*", F.col("boh").alias("boh_from"), F.col("eoh").alias("eoh_from"))
    out = lots.complete(rows)
    return out.select(
        "txn_id", "lot", "txn_type", "location", *[F.col(c).cast("double").alias(c) for c in ("boh", "eoh", "net_change")],
        "to_lot", "is_generated",
    )


CUT = "2024-01-10"
HOLDS_SQL = f"""n AS (SELECT *, CASE WHEN value > 8 THEN 'ReleaseAll' WHEN value >= 1 THEN 'Other' END AS reason,
    CASE location WHEN 'view' THEN 'WAIT' WHEN 'click' THEN 'INTRANSIT' ELSE 'RUN' END AS lot_state,
    CASE WHEN value < 2 THEN 'REWORK' ELSE 'NORMAL' END AS lot_category FROM t WHERE tm >= TIMESTAMP '{CUT}'),
fh AS (SELECT lot, min(txn_id) AS f FROM n WHERE txn_type = 'HoldLot' GROUP BY 1),
o AS (SELECT lot, txn_id AS a, ROW_NUMBER() OVER (PARTITION BY lot ORDER BY txn_id) AS rn FROM n WHERE txn_type = 'HoldLot'),
c AS (SELECT n.lot, txn_id AS b, ROW_NUMBER() OVER (PARTITION BY n.lot ORDER BY txn_id) AS rn FROM n JOIN fh ON n.lot = fh.lot WHERE txn_type = 'ReleaseLot' AND txn_id > f),
h AS (SELECT o.lot, a, b FROM o LEFT JOIN c ON o.lot = c.lot AND o.rn = c.rn),
d AS (SELECT n.*, CASE WHEN txn_type NOT IN ('HoldLot', 'ReleaseLot') THEN CASE WHEN EXISTS (SELECT 1 FROM h WHERE h.lot = n.lot AND n.txn_id > a AND (b IS NULL OR n.txn_id < b)) THEN 1 ELSE 0 END END AS hold_count,
  lag(location) OVER w AS pl, lag(txn_id) OVER w AS pid FROM n WINDOW w AS (PARTITION BY lot ORDER BY txn_id))"""


HOLDS_ALL_SQL = HOLDS_SQL.replace(f" WHERE tm >= TIMESTAMP '{CUT}'", "")


def mapped(rows: DataFrame) -> DataFrame:
    loc = F.col("location")
    return rows.select(
        "txn_id", "lot", "txn_type", "location", "at",
        F.when(F.col("value") > 8, lots.RELEASE_ALL).when(F.col("value") >= 1, "Other").alias("reason"),
        F.when(loc == "view", "WAIT").when(loc == "click", "INTRANSIT").otherwise("RUN").alias("lot_state"),
        F.when(F.col("value") < 2, "REWORK").otherwise("NORMAL").alias("lot_category"),
        loc.alias("stage_set"),
    )


def new_rows(t: Tables) -> DataFrame:
    return mapped(transactions(t).where(F.col("at") >= instant(CUT)))


def derived_rows(t: Tables) -> DataFrame:
    stored = transactions(t).where(F.col("at") < instant(CUT)).select("lot", "txn_id", "location")
    stages = t.region.select(
        F.when(F.col("r_regionkey") == 0, "view").when(F.col("r_regionkey") == 1, "click").otherwise(F.col("r_name")).alias("stage_set"),
        F.col("r_name").alias("country"),
    )
    return lots.derive(new_rows(t), stored, stages)


@query(
    "derived_events",
    f"""WITH {MAPPED_SQL}, {HOLDS_SQL},
st AS (SELECT lot, max_by(location, txn_id) AS sl FROM t WHERE tm < TIMESTAMP '{CUT}' GROUP BY 1),
stage AS (SELECT CASE r_regionkey WHEN 0 THEN 'view' WHEN 1 THEN 'click' ELSE r_name END AS stage_set, r_name AS country FROM region)
SELECT txn_id, d.lot, txn_type, country, lot_state = 'INTRANSIT' AS is_in_transit, lot_state = 'WAIT' AS is_hold, lot_category = 'REWORK' AS is_rework, hold_count,
  CASE WHEN location <> CASE WHEN pid IS NULL THEN sl ELSE pl END THEN strftime(tm, '%Y-%m-%d %H:%M:%S') END AS move_in_at
FROM d LEFT JOIN st ON d.lot = st.lot LEFT JOIN stage ON location = stage.stage_set""",
)
def derived_events(t: Tables) -> DataFrame:
    return derived_rows(t).select(
        "txn_id", "lot", "txn_type", "country", "is_in_transit", "is_hold", "is_rework", "hold_count",
        F.date_format("move_in_at", "yyyy-MM-dd HH:mm:ss").alias("move_in_at"),
    )


@query(
    "running_counter",
    f"""WITH RECURSIVE {MAPPED_SQL}, {HOLDS_ALL_SQL},
m AS (SELECT lot, txn_id, txn_type, reason, hold_count, lag(hold_count) OVER w AS pc, lag(txn_type) OVER w AS pt FROM d WINDOW w AS (PARTITION BY lot ORDER BY txn_id)),
q AS (SELECT *, CASE WHEN pt NOT IN ('HoldLot', 'ReleaseLot') THEN 1 ELSE 0 END AS seed, ROW_NUMBER() OVER (PARTITION BY lot ORDER BY txn_id) AS k
  FROM m WHERE txn_type IN ('HoldLot', 'ReleaseLot') AND hold_count IS NULL),
r AS (SELECT lot, txn_id, txn_type, reason, k, CASE WHEN txn_type = 'HoldLot' THEN coalesce(pc, 0) + 1 WHEN reason <> 'ReleaseAll' AND coalesce(pc, 0) > 0 THEN pc - 1 ELSE 0 END AS n FROM q WHERE seed = 1
  UNION ALL SELECT q.lot, q.txn_id, q.txn_type, q.reason, q.k, CASE WHEN q.txn_type = 'HoldLot' THEN r.n + 1 WHEN q.reason <> 'ReleaseAll' AND r.n > 0 THEN r.n - 1 ELSE 0 END
  FROM r JOIN q ON q.lot = r.lot AND q.k = r.k + 1 WHERE q.seed <> 1)
SELECT lot, txn_id, txn_type, reason, n AS hold_count FROM r""",
)
def running_counter(t: Tables) -> DataFrame:
    """A first load of all rows, nothing stored before; the derived rows are written once (checkpoint), then counted."""
    stored = transactions(t).select("lot", "txn_id", "location").where(F.lit(False))
    rows = lots.derive(mapped(transactions(t)), stored, empty_stages(t))
    return lots.hold_counts(cut_lineage(rows.select("lot", "txn_id", "txn_type", "reason", "hold_count")))


def empty_stages(t: Tables) -> DataFrame:
    return t.region.select(F.col("r_name").alias("stage_set"), F.col("r_name").alias("country"))


STATE_SQL = f"""{MAPPED_SQL},
x AS (SELECT *, CASE WHEN location = 'purchase' THEN 'CLOSED' WHEN location <> 'view' THEN 'RUN' END AS lot_state,
  CASE WHEN location = 'click' THEN value END AS click_value, CASE WHEN location = 'error' THEN tm END AS hold_at,
  CASE WHEN location <> lag(location) OVER w THEN tm END AS moved_at,
  CASE WHEN location <> lag(location) OVER w THEN 1 ELSE 0 END AS step, ROW_NUMBER() OVER (PARTITION BY lot ORDER BY tm DESC, txn_id DESC) AS rn
  FROM t WINDOW w AS (PARTITION BY lot ORDER BY tm, txn_id)),
y AS (SELECT *, sum(step) OVER (PARTITION BY lot ORDER BY tm, txn_id ROWS UNBOUNDED PRECEDING) AS stay FROM x),
z AS (SELECT *, max(value) OVER (PARTITION BY lot, stay) AS planned,
  last_value(lot_state IGNORE NULLS) OVER v AS ls, last_value(click_value IGNORE NULLS) OVER v AS click, last_value(hold_at IGNORE NULLS) OVER v AS held, last_value(moved_at IGNORE NULLS) OVER v AS moved
  FROM y WINDOW v AS (PARTITION BY lot ORDER BY tm, txn_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
st AS (SELECT lot, txn_id AS last_txn_id, location, stay AS location_changes, planned, ls AS lot_state, click AS click_value, held, moved, eoh AS wafers,
  CASE WHEN ls = 'CLOSED' THEN false ELSE NOT (eoh = 0 AND boh = 0) END AS is_active FROM z WHERE rn = 1)"""


def state(t: Tables) -> DataFrame:
    """Full history of all lots, reduced to one row each."""
    from tidemark.operators.timeline import Step, scan

    rows = transactions(t)
    loc = F.col("location")
    rows = scan(rows, ["lot"], ["at", "txn_id"], {"_pl": Step("lag", "location")}, ranged=True)
    rows = rows.select(
        "lot", "at", "txn_id", "location",
        F.when(loc == "purchase", "CLOSED").when(loc != "view", "RUN").alias("lot_state"),
        F.col("eoh").alias("wafers"), F.col("boh").alias("dies"),
        F.when(loc == "click", F.col("value")).alias("click_value"),
        F.when(loc == "error", F.col("at")).alias("hold_at"),
        F.when(loc != F.col("_pl"), F.col("at")).alias("moved_at"),
        F.col("value").alias("planned"),
    )
    return lots.lot_state(rows, ["click_value", "hold_at", "moved_at"], ["planned"])


@query(
    "entity_state",
    f"""WITH {STATE_SQL} SELECT lot, last_txn_id, location, location_changes, planned, lot_state, click_value, CAST(wafers AS DOUBLE) AS wafers, is_active,
  strftime(held, '%Y-%m-%d %H:%M:%S') AS hold_at FROM st""",
)
def entity_state(t: Tables) -> DataFrame:
    return state(t).select(
        "lot", "last_txn_id", "location", "location_changes", "planned", "lot_state", "click_value",
        F.col("wafers").cast("double").alias("wafers"), "is_active", F.date_format("hold_at", "yyyy-MM-dd HH:mm:ss").alias("hold_at"),
    )


@query(
    "wip_aging",
    f"""WITH {STATE_SQL} SELECT lot, 20240201 AS snapshot_date_key, md5(CAST(lot AS VARCHAR)) AS lot_key, md5(location) AS location_key, CAST(wafers AS DOUBLE) AS wafers,
  date_diff('day', CAST(held - INTERVAL 7 HOUR AS DATE), DATE '2024-02-01') AS hold_age_days, date_diff('day', CAST(moved - INTERVAL 7 HOUR AS DATE), DATE '2024-02-01') AS move_age_days
FROM st WHERE is_active""",
)
def wip_aging(t: Tables) -> DataFrame:
    return lots.wip_aging(state(t), "2024-02-01", "America/Phoenix").withColumn("wafers", F.col("wafers").cast("double"))



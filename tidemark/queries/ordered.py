"""Dedup and ordered computations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import object_key
from tidemark.functions.numbers import dec
from tidemark.operators import counter, timeline
from tidemark.operators.dedup import latest, latest_batch, prefer_first
from tidemark.operators.timeline import Step
from tidemark.queries.inputs import LINE_TIE
from tidemark.queries.registry import Tables, query

USER = ["user_id"]
TIME = ["ts", "event_id"]


@query(
    "latest_order",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey
  ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def latest_order(t: Tables) -> DataFrame:
    return latest(t.orders, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]).select(
        "o_custkey", "o_orderkey", "o_totalprice"
    )


@query(
    "latest_nulls_last",
    """SELECT user_id, event_id, t FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY t DESC NULLS LAST, event_id DESC) AS rn
  FROM (SELECT user_id, event_id, CASE WHEN event_type <> 'view' THEN event_type END AS t FROM events)) WHERE rn = 1
UNION ALL SELECT user_id, event_id, t FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY t DESC NULLS FIRST, event_id DESC) AS rn
  FROM (SELECT user_id, event_id, CASE WHEN event_type <> 'view' THEN event_type END AS t FROM events)) WHERE rn = 1""",
)
def latest_nulls_last(t: Tables) -> DataFrame:
    """Nulls placed last, and (union) nulls placed first."""
    ev = t.events.select("user_id", "event_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("t"))
    last = latest(ev, USER, [F.col("t").desc_nulls_last(), F.col("event_id").desc()])
    first = latest(ev, USER, [F.col("t").desc_nulls_first(), F.col("event_id").desc()])
    return last.unionByName(first)


TIE_SQL = ", ".join(f"{c} DESC NULLS LAST" for c in LINE_TIE)


@query(
    "two_level_dedup",
    f"""WITH v AS (SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {TIE_SQL}) AS rn FROM lineitem) WHERE rn = 1)
SELECT l_orderkey, l_partkey, l_linenumber FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS rn FROM v) WHERE rn = 1""",
)
def two_level_dedup(t: Tables) -> DataFrame:
    """Newest version of each line, then the largest line of each order."""
    versions = latest(t.lineitem, ["l_orderkey", "l_linenumber"], [F.col(c).desc_nulls_last() for c in LINE_TIE])
    return latest(versions, ["l_orderkey"], [F.col("l_extendedprice").desc(), F.col("l_linenumber").asc()]).select(
        "l_orderkey", "l_partkey", "l_linenumber"
    )


@query(
    "latest_day_lines",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM (SELECT *, DENSE_RANK() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC) AS r
  FROM lineitem) WHERE r = 1""",
)
def latest_day_lines(t: Tables) -> DataFrame:
    return latest_batch(t.lineitem, ["l_suppkey"], "l_shipdate").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"
    )


@query(
    "prefer_first",
    """WITH u AS (SELECT l_partkey AS part_id, l_suppkey AS owner, 1 AS source_rank FROM lineitem WHERE l_quantity = 50 AND l_returnflag = 'R'
  UNION ALL SELECT l_partkey, l_suppkey, 2 FROM lineitem WHERE l_quantity = 49 UNION ALL SELECT p_partkey, NULL, 3 FROM part)
SELECT part_id, owner, source_rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY part_id ORDER BY source_rank, owner) AS rn FROM u) WHERE rn = 1""",
)
def prefer_first_query(t: Tables) -> DataFrame:
    li = t.lineitem
    pick = lambda df: df.select(F.col("l_partkey").alias("part_id"), F.col("l_suppkey").alias("owner"))
    return prefer_first(
        [
            pick(li.where((F.col("l_quantity") == 50) & (F.col("l_returnflag") == "R"))),
            pick(li.where(F.col("l_quantity") == 49)),
            t.part.select(F.col("p_partkey").alias("part_id")),
        ],
        ["part_id"],
        [F.col("owner").asc()],
    )


@query(
    "lag_event",
    """SELECT event_id, user_id, event_type, lag(event_type) OVER w AS previous_type, lead(event_type) OVER w AS next_type
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def lag_event(t: Tables) -> DataFrame:
    ev = t.events.select("event_id", "user_id", "event_type", "ts")
    both = {"previous_type": Step("lag", "event_type"), "next_type": Step("lead", "event_type")}
    return timeline.scan(ev, USER, TIME, both, ranged=True).drop("ts")


@query(
    "lag_ignore_nulls",
    """WITH e AS (SELECT event_id, user_id, ts, CASE WHEN event_type = 'purchase' THEN value END AS score FROM events)
SELECT event_id, user_id, score, coalesce(last_value(score IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS previous_score FROM e""",
)
def lag_ignore_nulls(t: Tables) -> DataFrame:
    ev = t.events.select(
        "event_id", "user_id", "ts", F.when(F.col("event_type") == "purchase", F.col("value")).alias("score")
    )
    return timeline.previous(
        ev, USER, TIME, {"previous_score": "score"}, ranged=True, ignore_nulls=True, default=F.lit(0.0)
    ).drop("ts")


@query(
    "effective_to",
    """WITH p AS (SELECT DISTINCT l_partkey, CAST(l_shipdate AS DATE) AS f FROM lineitem)
SELECT l_partkey, f AS effective_from, coalesce(lead(f) OVER (PARTITION BY l_partkey ORDER BY f) - 1, DATE '9999-12-31') AS effective_to FROM p""",
)
def effective_to(t: Tables) -> DataFrame:
    starts = (
        t.lineitem.select("l_partkey", F.col("l_shipdate").cast("date").alias("effective_from"))
        .distinct()
    )
    return timeline.valid_to(
        starts, ["l_partkey"], "effective_from", "effective_to", ranged=True
    )


KNOWN = ["last_click", "last_error", "last_any"]


@query(
    "last_known",
    """SELECT user_id, max_by(value, event_id) FILTER (event_type = 'click') AS last_click,
  max_by(value, event_id) FILTER (event_type = 'error') AS last_error, max_by(value, event_id) AS last_any FROM events GROUP BY 1""",
)
def last_known(t: Tables) -> DataFrame:
    """Newest non-null value of each attribute, one pass for all of them."""
    e = F.col("event_type")
    wide = t.events.select(
        "user_id", "ts", "event_id",
        F.when(e == "click", F.col("value")).alias("last_click"),
        F.when(e == "error", F.col("value")).alias("last_error"),
        F.col("value").alias("last_any"),
    )
    return timeline.last_known(wide, USER, TIME, KNOWN)


@query(
    "first_last_value",
    """SELECT event_id, user_id, first_value(event_type) OVER w AS first_type, last_value(event_type) OVER w AS last_type
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
def first_last_value(t: Tables) -> DataFrame:
    ev = t.events.select("event_id", "user_id", "ts", "event_type")
    out = timeline.whole_key(
        ev, USER,
        {
            "first_type": timeline.first_value("event_type", TIME),
            "last_type": timeline.last_value("event_type", TIME),
        },
    )
    return out.select("event_id", "user_id", "first_type", "last_type")


@query(
    "running_sales",
    """WITH m AS (SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_begin, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS s
  FROM orders GROUP BY 1, 2)
SELECT o_orderpriority, month_begin, CAST(sum(s) OVER (PARTITION BY o_orderpriority ORDER BY month_begin ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running FROM m""",
)
def running_sales(t: Tables) -> DataFrame:
    """Running sum over months; the months are aggregated first, so the window is small."""
    monthly = t.orders.groupBy("o_orderpriority", F.trunc("o_orderdate", "month").alias("month_begin")).agg(
        F.sum(dec(F.col("o_totalprice"))).alias("s")
    )
    out = timeline.running(monthly, ["o_orderpriority"], ["month_begin"], {"r": ("sum", "s")})
    return out.select("o_orderpriority", "month_begin", F.col("r").cast("double").alias("running"))


@query(
    "running_max_run",
    """WITH c AS (SELECT *, CASE WHEN event_type <> lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) THEN 1 ELSE 0 END AS step FROM events),
r AS (SELECT *, sum(step) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM c)
SELECT event_id, user_id, run, max(value) OVER (PARTITION BY user_id, run ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run_max FROM r""",
)
def running_max_run(t: Tables) -> DataFrame:
    """Running maximum inside each unbroken run of one event type."""
    ev = t.events.select("event_id", "user_id", "ts", "event_type", "value")
    runs = timeline.change_event(ev, USER, TIME, "event_type", "run", ranged=True)
    out = timeline.running(runs, [*USER, "run"], TIME, {"run_max": ("max", "value")}, ranged=True)
    return out.select("event_id", "user_id", "run", "run_max")


@query(
    "change_event",
    """WITH e AS (SELECT event_id, user_id, ts, nullif(event_type, 'view') AS t FROM events),
c AS (SELECT *, CASE WHEN t <> lag(t) OVER (PARTITION BY user_id ORDER BY ts, event_id) THEN 1 ELSE 0 END AS step FROM e)
SELECT event_id, user_id, t, sum(step) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS changes FROM c""",
)
def change_event(t: Tables) -> DataFrame:
    ev = t.events.select("event_id", "user_id", "ts", F.nullif("event_type", F.lit("view")).alias("t"))
    return timeline.change_event(ev, USER, TIME, "t", "changes", ranged=True).drop("ts")


@query(
    "islands",
    """SELECT event_id, user_id, event_type, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id)
  - ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS island FROM events""",
)
def islands(t: Tables) -> DataFrame:
    ev = t.events.select("event_id", "user_id", "ts", "event_type")
    return timeline.islands(ev, USER, TIME, "event_type", "island", ranged=True).drop("ts")


@query(
    "dup_ordinal",
    """WITH d AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS n FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, n AS dup_no,
  md5('{"COL1":' || l_orderkey || ',"COL2":' || l_linenumber || ',"COL3":' || n || '}') AS line_key FROM d""",
)
def dup_ordinal(t: Tables) -> DataFrame:
    """Number repeats of a key and hash the number into the key."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    out = timeline.copy_ordinal(
        li, ["l_orderkey", "l_linenumber"], LINE_TIE, "dup_no", ranged=True
    )
    return out.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "dup_no",
        object_key({"COL1": F.col("l_orderkey"), "COL2": F.col("l_linenumber"), "COL3": F.col("dup_no")}).alias("line_key"),
    )


@query(
    "bucket_seq",
    """WITH r AS (SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS run_date FROM lineitem)
SELECT run_date, 1 - ROW_NUMBER() OVER (ORDER BY run_date DESC) AS bucket FROM r""",
)
def bucket_seq(t: Tables) -> DataFrame:
    """0, -1, -2 … from the newest planning run; only the distinct runs reach the window."""
    from tidemark.plans.leadtime import bucket_sequence

    runs = t.lineitem.select(F.trunc("l_shipdate", "month").alias("run_date"))
    return bucket_sequence(runs, "run_date", "bucket")


COUNTER_SQL = """WITH RECURSIVE e AS (SELECT event_id, user_id,
    CASE WHEN event_type = 'signup' AND value < 5 THEN 'X' WHEN event_type = 'error' THEN 'H' WHEN event_type = 'purchase' THEN 'R' ELSE 'O' END AS op,
    ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
r AS (SELECT event_id, user_id, n, CASE op WHEN 'H' THEN 1 ELSE 0 END AS c FROM e WHERE n = 1
  UNION ALL SELECT e.event_id, e.user_id, e.n, CASE e.op WHEN 'X' THEN 0 WHEN 'H' THEN r.c + 1 WHEN 'R' THEN greatest(r.c - 1, 0) ELSE r.c END
  FROM r JOIN e ON e.user_id = r.user_id AND e.n = r.n + 1)
SELECT event_id, user_id, c AS hold_count FROM r"""


@query("floored_counter", COUNTER_SQL)
def floored_counter(t: Tables) -> DataFrame:
    """Plus one, minus one not below zero, reset; against a row-by-row recursion."""
    e = F.col("event_type")
    step = F.when(e == "error", 1).when(e == "purchase", -1).otherwise(0)
    reset = (e == "signup") & (F.col("value") < 5)
    ev = t.events.select("event_id", "user_id", "ts", "event_type", "value")
    return counter.floored_counter(ev, USER, TIME, step, reset, "hold_count", ranged=True).select(
        "event_id", "user_id", "hold_count"
    )

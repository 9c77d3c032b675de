"""Predicates, latest slices, as-of maxima, relative dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import clamp_date, day, instant, start_years_back
from tidemark.functions.hashing import surrogate_key
from tidemark.functions.numbers import dec
from tidemark.functions.text import null_if_sentinel
from tidemark.operators import calendar as cal
from tidemark.operators import joins, timeline
from tidemark.operators.dedup import latest, latest_batch, latest_slice
from tidemark.operators.snapshots import current_weeks
from tidemark.queries.inputs import fiscal_cal, fiscal_sql, on_day
from tidemark.queries.registry import Tables, query


@query(
    "alias_chain",
    """WITH a AS (SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS gross,
  CAST(l_discount AS DECIMAL(18,2)) AS disc, l_quantity FROM lineitem),
b AS (SELECT *, gross * (1 - disc) AS net FROM a),
c AS (SELECT *, CASE WHEN net > 50000 THEN 'L' WHEN net > 10000 THEN 'M' ELSE 'S' END AS band FROM b)
SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, l_quantity, CAST(net AS DOUBLE) AS net, band,
  md5(band || '--' || CAST(l_partkey AS VARCHAR)) AS band_key FROM c""",
)
def alias_chain(t: Tables) -> DataFrame:
    """Each step uses the one before, down to a hash."""
    return (
        t.lineitem.withColumn("gross", dec(F.col("l_extendedprice")))
        .withColumn("net", F.col("gross") * (1 - dec(F.col("l_discount"))))
        .withColumn("band", F.when(F.col("net") > 50000, "L").when(F.col("net") > 10000, "M").otherwise("S"))
        .withColumn("band_key", surrogate_key(F.col("band"), F.col("l_partkey")))
        .select(
            "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_quantity",
            F.col("net").cast("double").alias("net"), "band", "band_key",
        )
    )


@query(
    "predicates_part",
    r"""SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part
WHERE p_type IN ('PROMO', 'SMALL', 'LARGE') AND p_brand NOT IN ('Brand#1', 'Brand#2')
  AND p_size BETWEEN 5 AND 40 AND (p_name LIKE '%widget' OR p_name ILIKE 'BLUE%' OR p_name LIKE '%^_%' ESCAPE '^')
  AND p_name NOT LIKE '%anvil%'""",
)
def predicates_part(t: Tables) -> DataFrame:
    c = F.col
    return t.part.where(
        c("p_type").isin("PROMO", "SMALL", "LARGE")
        & ~c("p_brand").isin("Brand#1", "Brand#2")
        & c("p_size").between(5, 40)
        & (c("p_name").like("%widget") | c("p_name").ilike("BLUE%") | F.expr("p_name LIKE '%^_%' ESCAPE '^'"))
        & ~c("p_name").like("%anvil%")
    ).select("p_partkey", "p_name", "p_brand", "p_type", "p_size")


@query(
    "case_filter",
    """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE CASE WHEN o_orderstatus = 'F' AND left(o_orderpriority, 1) IN ('1', '2') THEN 1
           WHEN o_orderstatus <> 'F' THEN 1 END = 1""",
)
def case_filter(t: Tables) -> DataFrame:
    keep = F.when(
        (F.col("o_orderstatus") == "F") & F.left("o_orderpriority", F.lit(1)).isin("1", "2"), 1
    ).when(F.col("o_orderstatus") != "F", 1)
    return t.orders.where(keep == 1).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(
    "latest_shipdate",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
WHERE l_shipdate = (SELECT max(l_shipdate) FROM lineitem)""",
)
def latest_shipdate(t: Tables) -> DataFrame:
    return latest_slice(t.lineitem, "l_shipdate").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )


@query(
    "latest_order_per_customer_ties",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
WHERE (o_custkey, o_orderdate) IN (SELECT o_custkey, max(o_orderdate) FROM orders GROUP BY 1)""",
)
def latest_order_per_customer_ties(t: Tables) -> DataFrame:
    return latest_batch(t.orders, ["o_custkey"], "o_orderdate").select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "asof_max_events",
    """WITH s AS (SELECT s.event_id, s.user_id, s.ts, (SELECT max(CAST(c.value AS DECIMAL(18,2))) FROM events c
    WHERE c.user_id = s.user_id AND c.event_type = 'click' AND c.ts <= s.ts) AS best_click
  FROM events s WHERE s.event_type = 'signup')
SELECT event_id, user_id, CAST(best_click AS DOUBLE) AS best_click,
  ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sort_order FROM s""",
)
def asof_max_events(t: Tables) -> DataFrame:
    """Best click of the user up to each signup, renumbered along time."""
    ev = t.events.withColumn("v", dec(F.col("value")))
    left = ev.where(F.col("event_type") == "signup").select("event_id", "user_id", "ts")
    right = ev.where(F.col("event_type") == "click").select("user_id", "ts", "v")
    best = joins.asof_max(left, right, ["user_id"], "ts", "ts", "v", "best", ranged=True)
    out = timeline.ordinal(best, ["user_id"], ["ts", "event_id"], "sort_order", ranged=True)
    return out.select("event_id", "user_id", F.col("best").cast("double").alias("best_click"), "sort_order")


@query(
    "exists_or_absent",
    """WITH matrix AS (SELECT o_custkey AS k, o_orderdate AS f, o_orderdate + INTERVAL 365 DAYS AS u, o_orderpriority AS p
  FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 450000)
SELECT o_orderkey, o_custkey FROM orders o
WHERE EXISTS (SELECT 1 FROM matrix WHERE k = o.o_custkey AND o.o_orderdate BETWEEN f AND u AND p IN ('1-URGENT', '2-HIGH'))
   OR o_custkey NOT IN (SELECT k FROM matrix)""",
)
def exists_or_absent(t: Tables) -> DataFrame:
    o = t.orders
    matrix = o.where((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 450000)).select(
        "o_custkey",
        F.col("o_orderdate").cast("date").alias("from_date"),
        F.date_add(F.col("o_orderdate").cast("date"), 365).alias("to_date"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("accepts"),
    )
    facts = o.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("order_day"))
    return joins.exists_or_absent(
        facts, matrix, "o_custkey", "order_day", "from_date", "to_date", F.col("accepts")
    ).select("o_orderkey", "o_custkey")


@query(
    "since_years",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'""",
)
def since_years(t: Tables) -> DataFrame:
    """From the first day of the year five years back."""
    return t.orders.where(F.col("o_orderdate") >= start_years_back("2001-08-01", 5)).select("o_orderkey", "o_custkey")


@query(
    "recent_weeks",
    f"""WITH {fiscal_sql("orders", "o_orderdate")}, o AS (SELECT o_orderkey, fiscal_week FROM orders
  JOIN cal ON calendar_date = CAST(o_orderdate AS DATE))
SELECT o_orderkey, fiscal_week FROM o WHERE fiscal_week >= ((SELECT max(fiscal_week) FROM o) - 200) // 100 * 100""",
)
def recent_weeks(t: Tables) -> DataFrame:
    o = t.orders
    weeks = on_day(o, "o_orderdate", fiscal_cal(o, "o_orderdate"), ["fiscal_week"])
    return cal.keep_recent_years(weeks.select("o_orderkey", "fiscal_week"), "fiscal_week", 2)


@query(
    "clamp_dates",
    """SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus <> 'P' THEN greatest(CAST(o_orderdate AS DATE), DATE '1996-01-01') END,
    DATE '1960-01-01') AS request_date,
  coalesce(nullif(o_orderstatus, 'O'), 'UNK') AS status_code FROM orders""",
)
def clamp_dates(t: Tables) -> DataFrame:
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    return t.orders.select(
        "o_orderkey",
        clamp_date(known, "1996-01-01", "1960-01-01").alias("request_date"),
        F.coalesce(F.nullif("o_orderstatus", F.lit("O")), F.lit("UNK")).alias("status_code"),
    )


@query(
    "due_flags",
    f"""WITH {fiscal_sql("orders", "o_orderdate")},
task AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS finish, CASE WHEN o_orderstatus = 'F' THEN 100 ELSE 50 END AS pct FROM orders),
assignment AS (SELECT l_orderkey, l_suppkey FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey
  ORDER BY l_shipdate DESC, l_suppkey, l_partkey) AS rn FROM lineitem) WHERE rn = 1)
SELECT o_orderkey, c_name AS project, l_suppkey AS assigned_to,
  CASE WHEN finish < DATE '2001-07-25' AND pct < 100 THEN 'Y' ELSE 'N' END AS is_past_due,
  CASE WHEN finish >= DATE '2001-07-25' AND finish <= DATE '2001-08-01' AND pct < 100 THEN 'Y' ELSE 'N' END AS is_due_soon,
  (SELECT fiscal_week FROM cal WHERE calendar_date = DATE '2001-07-25') AS snapshot_week_key
FROM task JOIN customer ON c_custkey = o_custkey LEFT JOIN assignment ON l_orderkey = o_orderkey""",
)
def due_flags(t: Tables) -> DataFrame:
    """Task report: project, latest assignment, overdue and due-soon flags, current week."""
    o, asof = t.orders, "2001-07-25"
    finish, open_task = F.col("o_orderdate").cast("date"), F.col("o_orderstatus") != "F"
    flag = lambda c: F.when(c, "Y").otherwise("N")
    tasks = o.select(
        "o_orderkey",
        "o_custkey",
        flag((finish < day(asof)) & open_task).alias("is_past_due"),
        flag(finish.between(day(asof), F.date_add(day(asof), 7)) & open_task).alias("is_due_soon"),
    )
    assigned = latest(
        t.lineitem.select("l_orderkey", "l_suppkey", "l_shipdate", "l_partkey"),
        ["l_orderkey"],
        [F.col("l_shipdate").desc(), F.col("l_suppkey").asc(), F.col("l_partkey").asc()],
    )
    out = joins.enrich(
        tasks,
        [
            (t.customer, {"o_custkey": "c_custkey"}, {"project": "c_name"}),
            (assigned, {"o_orderkey": "l_orderkey"}, {"assigned_to": "l_suppkey"}),
        ],
    )
    calendar = fiscal_cal(o, "o_orderdate")
    week = calendar.where(F.col("calendar_date") == day(asof))
    return joins.stamp_period(out, week, "fiscal_week", "snapshot_week_key").drop("o_custkey")


@query(
    "null_sentinels",
    """SELECT o_orderkey, CASE WHEN o_orderpriority NOT IN ('4-NOT SPECIFIED') THEN o_orderpriority END AS priority,
  CASE WHEN CAST(o_orderdate AS DATE) <> DATE '1995-01-01' THEN CAST(o_orderdate AS DATE) END AS order_day FROM orders""",
)
def null_sentinels(t: Tables) -> DataFrame:
    d = F.col("o_orderdate").cast("date")
    return t.orders.select(
        "o_orderkey",
        null_if_sentinel(F.col("o_orderpriority"), ["4-NOT SPECIFIED"]).alias("priority"),
        F.when(d != day("1995-01-01"), d).alias("order_day"),
    )


@query(
    "current_weeks",
    f"""WITH {fiscal_sql("orders", "o_orderdate")}
SELECT DISTINCT fiscal_week FROM cal WHERE calendar_date IN (DATE '2000-01-01', DATE '1999-12-31')""",
)
def current_weeks_query(t: Tables) -> DataFrame:
    """Two weeks are current between midnight UTC and local midnight."""
    calendar = fiscal_cal(t.orders, "o_orderdate")
    return current_weeks(calendar, instant("2000-01-01 03:00:00"), "America/Phoenix", "fiscal_week", "calendar_date")



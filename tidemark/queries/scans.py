"""Scans, incremental reads, sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import day, instant
from tidemark.functions.numbers import exact_sum
from tidemark.operators import calendar as cal
from tidemark.operators.dedup import latest
from tidemark.operators.quality import freshness
from tidemark.plans.directory import member_rows
from tidemark.plans.usage import refresh_log
from tidemark.queries.inputs import LINE_KEY, LINE_ORDER_SQL, newest_line_order
from tidemark.queries.registry import Tables, query
from tidemark.sources import sinks
from tidemark.sources.tables import (
    LoadWindow,
    backfill,
    constant_table,
    expand_changed_keys,
    impacted,
    read_since,
    scan,
    seed_from_text,
    with_history,
)
from tidemark.sources.watermarks import watermark_plan


@query(
    "scan_rename",
    """SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment FROM customer""",
)
def scan_rename(t: Tables) -> DataFrame:
    return scan(
        t.spark,
        t.folder,
        "customer",
        {"customer_id": "c_custkey", "customer_name": "c_name", "segment": "c_mktsegment"},
    )


SEGMENT_SEED = """segment,class,division,loaded
AUTOMOBILE,OEM,"Power, Automotive",2022-11-01 10:15:00
BUILDING,DIST,"Industrial, Building",11/2/2022 9:05
FURNITURE,CIPO,"Consumer, Home",2022-11-03 00:00:00
HOUSEHOLD,EMSI,"Consumer, Appliance",1/4/2023 23:59
MACHINERY,DIST,"Industrial, Machines",2023-01-05 12:00:00
"""


def segment_ref(t: Tables) -> DataFrame:
    return seed_from_text(
        t.spark,
        SEGMENT_SEED,
        "segment string, class string, division string, loaded string",
        ["loaded"],
        ["yyyy-MM-dd HH:mm:ss", "M/d/yyyy H:mm"],
    )


SEGMENT_REF_SQL = """segment_ref(segment, class, division, loaded) AS (VALUES
  ('AUTOMOBILE', 'OEM', 'Power, Automotive', TIMESTAMP '2022-11-01 10:15:00'),
  ('BUILDING', 'DIST', 'Industrial, Building', TIMESTAMP '2022-11-02 09:05:00'),
  ('FURNITURE', 'CIPO', 'Consumer, Home', TIMESTAMP '2022-11-03 00:00:00'),
  ('HOUSEHOLD', 'EMSI', 'Consumer, Appliance', TIMESTAMP '2023-01-04 23:59:00'),
  ('MACHINERY', 'DIST', 'Industrial, Machines', TIMESTAMP '2023-01-05 12:00:00'))"""


@query(
    "seed_join",
    f"""WITH {SEGMENT_REF_SQL}
SELECT c_custkey, class, division, strftime(loaded, '%Y-%m-%d %H:%M:%S') AS loaded
FROM customer LEFT JOIN segment_ref ON c_mktsegment = segment""",
)
def seed_join(t: Tables) -> DataFrame:
    ref = segment_ref(t)
    return t.customer.join(ref, F.col("c_mktsegment") == F.col("segment"), "left").select(
        "c_custkey", "class", "division", F.date_format("loaded", "yyyy-MM-dd HH:mm:ss").alias("loaded")
    )


# Age bucket -> reporting group (fixed values).
NPD_BUCKETS = [
    ("New Request", "5 years old and less"),
    ("0 to 3 years", "5 years old and less"),
    ("3 to 5 years", "5 years old and less"),
    ("5 to 7 years", "Greater than 5 years but less than 10 years"),
    ("7 to 10 years", "Greater than 5 years but less than 10 years"),
    ("Greater than 10 years", "Greater than 10 years old"),
]


@query(
    "bucket_ref",
    """WITH ref(npd_bucket, npd_group) AS (VALUES """
    + ", ".join(f"('{a}', '{b}')" for a, b in NPD_BUCKETS)
    + """), ages AS (
  SELECT l_partkey, date_diff('day', CAST(min(l_shipdate) AS DATE), DATE '2001-12-31') AS age FROM lineitem GROUP BY 1),
named AS (SELECT CASE WHEN age < 3*365 THEN '0 to 3 years' WHEN age < 5*365 THEN '3 to 5 years'
  WHEN age < 7*365 THEN '5 to 7 years' WHEN age < 10*365 THEN '7 to 10 years' ELSE 'Greater than 10 years' END AS npd_bucket
  FROM ages)
SELECT ref.npd_bucket, npd_group, count(named.npd_bucket) AS parts
FROM ref LEFT JOIN named ON ref.npd_bucket = named.npd_bucket GROUP BY 1, 2""",
)
def bucket_ref(t: Tables) -> DataFrame:
    """Parts per age bucket, buckets without parts included."""
    ref = constant_table(t.spark, NPD_BUCKETS, ["npd_bucket", "npd_group"])
    first = t.lineitem.groupBy("l_partkey").agg(F.min("l_shipdate").cast("date").alias("first"))
    age = F.datediff(day("2001-12-31"), F.col("first"))
    named = first.select(
        F.when(age < 3 * 365, "0 to 3 years")
        .when(age < 5 * 365, "3 to 5 years")
        .when(age < 7 * 365, "5 to 7 years")
        .when(age < 10 * 365, "7 to 10 years")
        .otherwise("Greater than 10 years")
        .alias("npd_bucket")
    ).groupBy("npd_bucket").agg(F.count("*").alias("parts"))
    return ref.join(named, "npd_bucket", "left").select(
        "npd_bucket", "npd_group", F.coalesce("parts", F.lit(0)).alias("parts")
    )


@query(
    "time_dim",
    """WITH m AS (SELECT unnest(range(1440)) AS n),
d AS (SELECT n, n // 60 AS h, n % 60 AS mi, CASE WHEN (n // 60) % 12 = 0 THEN 12 ELSE (n // 60) % 12 END AS h12 FROM m),
ev AS (SELECT hour(ts) * 60 + minute(ts) AS n, count(*) AS events FROM events GROUP BY 1)
SELECT h * 10000 + mi * 100 AS time_key, n + 1 AS minute_of_day, h AS hour_24, h12 AS hour_12, mi AS minute,
  lpad(CAST(h AS VARCHAR), 2, '0') || ':' || lpad(CAST(mi AS VARCHAR), 2, '0') AS label_24,
  lpad(CAST(h12 AS VARCHAR), 2, '0') || ':' || lpad(CAST(mi AS VARCHAR), 2, '0') || CASE WHEN h >= 12 THEN ' PM' ELSE ' AM' END AS label_12,
  h12 * 100 + mi AS hour_12_minute_code, h >= 12 AS is_pm,
  CASE WHEN h < 5 THEN 'Early Morning' WHEN h < 12 THEN 'Morning' WHEN h < 18 THEN 'Afternoon' ELSE 'Evening' END AS day_part,
  CASE WHEN h BETWEEN 6 AND 17 THEN 'Day' ELSE 'Night' END AS day_night,
  coalesce(events, 0) AS events
FROM d LEFT JOIN ev USING (n)""",
)
def time_dim(t: Tables) -> DataFrame:
    """Minutes of the day with the number of events in each."""
    per_minute = t.events.groupBy((F.hour("ts") * 60 + F.minute("ts") + 1).alias("minute_of_day")).agg(
        F.count("*").alias("events")
    )
    return (
        cal.minutes_of_day(t.spark)
        .join(per_minute, "minute_of_day", "left")
        .withColumn("events", F.coalesce("events", F.lit(0)))
    )


CUTOFF = "2000-01-01"
CUST_ORDERS_SQL = """{name} AS (SELECT * EXCLUDE (rn) FROM (
  SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
    ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders WHERE {where}) WHERE rn = 1)"""
BEFORE_AFTER_SQL = (
    CUST_ORDERS_SQL.format(name="tgt", where=f"o_orderdate < TIMESTAMP '{CUTOFF}'")
    + ",\n"
    + CUST_ORDERS_SQL.format(name="src", where=f"o_orderdate >= TIMESTAMP '{CUTOFF}'")
)


def customer_orders(df: DataFrame) -> DataFrame:
    newest = latest(df, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
    return newest.select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate")
    )


def before_after(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Each customer's newest order before, and after, the load cutoff."""
    o = t.orders
    cut = instant(CUTOFF)
    return customer_orders(o.where(F.col("o_orderdate") < cut)), customer_orders(o.where(F.col("o_orderdate") >= cut))


@query(
    "upsert_orders",
    f"""WITH {BEFORE_AFTER_SQL}
SELECT coalesce(t.o_custkey, s.o_custkey) AS o_custkey,
  CASE WHEN s.o_custkey IS NOT NULL THEN s.o_orderkey ELSE t.o_orderkey END AS o_orderkey,
  CASE WHEN s.o_custkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
  CASE WHEN s.o_custkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
  CASE WHEN t.o_custkey IS NOT NULL THEN t.o_orderdate ELSE s.o_orderdate END AS o_orderdate
FROM tgt t FULL JOIN src s ON t.o_custkey = s.o_custkey""",
)
def upsert_orders(t: Tables) -> DataFrame:
    """The order date plays the insert time and is kept for known customers."""
    target, source = before_after(t)
    return sinks.upsert(target, source, ["o_custkey"], ["o_orderkey", "o_orderstatus", "o_totalprice"])


@query(
    "retention_events",
    """SELECT event_id, user_id, event_type, value FROM events
WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 8 DAYS""",
)
def retention_events(t: Tables) -> DataFrame:
    """Old log plus new load, keeping eight days."""
    ev = t.events
    cut = instant("2024-01-26")
    kept = sinks.append_with_retention(
        ev.where(F.col("ts") < cut), ev.where(F.col("ts") >= cut), "ts", instant("2024-01-31"), 8
    )
    return kept.select("event_id", "user_id", "event_type", "value")


@query(
    "update_from_stage",
    """WITH stage AS (SELECT o_custkey, max(o_totalprice) AS top FROM orders
  WHERE o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY 1)
SELECT c_custkey, c_name, coalesce(top, c_acctbal) AS c_acctbal FROM customer LEFT JOIN stage ON o_custkey = c_custkey""",
)
def update_from_stage(t: Tables) -> DataFrame:
    stage = (
        t.orders.where(F.col("o_orderdate") >= instant("2001-01-01"))
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.max("o_totalprice").alias("top"))
    )
    target = t.customer.select("c_custkey", "c_name", "c_acctbal")
    return sinks.update_from(target, stage, ["c_custkey"], {"c_acctbal": "top"})


@query(
    "logical_delete_returns",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
  THEN 'Y' ELSE 'N' END AS delete_flag FROM orders""",
)
def logical_delete_returns(t: Tables) -> DataFrame:
    returned = t.lineitem.where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return sinks.logical_delete(t.orders.select("o_orderkey", "o_custkey"), returned, ["o_orderkey"], "delete_flag")


@query(
    "backfill_slices",
    """SELECT DATE '1996-01-01' + 20 * CAST(date_diff('day', DATE '1996-01-01', CAST(l_shipdate AS DATE)) // 20 AS INTEGER) AS slice,
  count(*) AS lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '2001-01-31' GROUP BY 1""",
)
def backfill_slices(t: Tables) -> DataFrame:
    """Five years and a month in 20-day slices, as one job."""

    def job(df: DataFrame) -> DataFrame:
        return df.groupBy("slice").agg(F.count("*").alias("lines"), exact_sum(F.col("l_extendedprice")).alias("amount"))

    return backfill(job, t.lineitem, "l_shipdate", "1996-01-01", "2001-01-31", 20)


@query(
    "watermark_events",
    """SELECT event_id, user_id, event_type, value FROM events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12 12:00:00'""",
)
def watermark_events(t: Tables) -> DataFrame:
    return read_since(t.events, "ts", "2024-01-10", "2024-01-12 12:00:00").select(
        "event_id", "user_id", "event_type", "value"
    )


@query(
    "watermark_backfill",
    """SELECT event_id, user_id, event_type, value FROM events
WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-20'""",
)
def watermark_backfill(t: Tables) -> DataFrame:
    """The same read with the bounds overridden for a backfill."""
    window = LoadWindow.choose("2024-01-10", "2024-01-12 12:00:00", backfill=True, start="2024-01-01", end="2024-01-20")
    return window.read(t.events, "ts").select("event_id", "user_id", "event_type", "value")


@query(
    "changed_users_full_history",
    """SELECT event_id, user_id, event_type FROM events
WHERE user_id IN (SELECT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-29 12:00:00' AND event_type = 'purchase')""",
)
def changed_users_full_history(t: Tables) -> DataFrame:
    ev = t.events
    touched = read_since(ev, "ts", "2024-01-29 12:00:00", "9999-12-31").where(F.col("event_type") == "purchase")
    return expand_changed_keys(ev.select("event_id", "user_id", "event_type"), ["user_id"], touched)


@query(
    "history_union",
    f"""WITH {BEFORE_AFTER_SQL}
SELECT o_custkey, o_orderkey, o_orderstatus FROM src
UNION ALL SELECT o_custkey, o_orderkey, o_orderstatus FROM tgt WHERE o_custkey NOT IN (SELECT o_custkey FROM src)
UNION ALL SELECT c_custkey, NULL, NULL FROM customer
  WHERE c_custkey NOT IN (SELECT o_custkey FROM src) AND c_custkey NOT IN (SELECT o_custkey FROM tgt)""",
)
def history_union(t: Tables) -> DataFrame:
    """Current load, then one-time histories for keys not seen yet."""
    old, new = before_after(t)
    cols = ["o_custkey", "o_orderkey", "o_orderstatus"]
    never = t.customer.select(F.col("c_custkey").alias("o_custkey"))
    return with_history(new.select(*cols), [old.select(*cols), never], ["o_custkey"])


@query(
    "watermark_table",
    """WITH runs AS (SELECT o_orderpriority AS job, year(o_orderdate) * 12 + month(o_orderdate) AS batch_id, max(o_orderdate) AS hwm
  FROM orders GROUP BY 1, 2)
SELECT job, batch_id, strftime(hwm, '%Y-%m-%d') AS hwm,
  strftime(coalesce(lag(hwm) OVER (PARTITION BY job ORDER BY batch_id), TIMESTAMP '1900-01-01'), '%Y-%m-%d') AS lwm FROM runs""",
)
def watermark_table(t: Tables) -> DataFrame:
    """Marks of monthly loads per job: each low mark is the high mark before it."""
    loads = t.orders.select(
        F.col("o_orderpriority").alias("job"),
        (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("batch_id"),
        "o_orderdate",
    )
    plan = watermark_plan(loads, "job", "batch_id", "o_orderdate")
    return plan.select(
        "job", "batch_id", F.date_format("hwm", "yyyy-MM-dd").alias("hwm"), F.date_format("lwm", "yyyy-MM-dd").alias("lwm")
    )


@query(
    "freshness_events",
    """WITH m AS (SELECT max(ts) AS max_loaded_at FROM events),
a AS (SELECT strftime(max_loaded_at, '%Y-%m-%d %H:%M:%S') AS max_loaded_at, date_diff('second', date_trunc('second', max_loaded_at), TIMESTAMP '2024-02-01') AS s FROM m)
SELECT max_loaded_at, (s - 1) // 3600 AS age_hours, CASE WHEN s > 48*3600 THEN 'error' WHEN s > 24*3600 THEN 'warn' ELSE 'pass' END AS status FROM a""",
)
def freshness_events(t: Tables) -> DataFrame:
    out = freshness(t.events, "ts", instant("2024-02-01"))
    return out.withColumn("max_loaded_at", F.date_format("max_loaded_at", "yyyy-MM-dd HH:mm:ss"))


@query(
    "impacted_orders",
    """SELECT o_orderkey, o_custkey FROM orders WHERE
  (o_orderdate >= TIMESTAMP '2001-07-01' AND o_orderdate < TIMESTAMP '2001-08-01')
  OR o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9900)
  OR (o_orderpriority, o_orderstatus) IN (SELECT o_orderpriority, o_orderstatus FROM orders WHERE o_totalprice > 499900)""",
)
def impacted_orders(t: Tables) -> DataFrame:
    """Orders that changed, or whose customer or (priority, status) changed."""
    o = t.orders
    direct = (F.col("o_orderdate") >= instant("2001-07-01")) & (F.col("o_orderdate") < instant("2001-08-01"))
    customers = t.customer.where(F.col("c_acctbal") > 9900).select(F.col("c_custkey").alias("o_custkey"))
    pairs = o.where(F.col("o_totalprice") > 499900).select("o_orderpriority", "o_orderstatus")
    return impacted(o, direct, [(["o_custkey"], customers), (["o_orderpriority", "o_orderstatus"], pairs)]).select(
        "o_orderkey", "o_custkey"
    )


@query(
    "current_lines",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) AS rn FROM lineitem) WHERE rn = 1""",
)
def current_lines_query(t: Tables) -> DataFrame:
    """Newest staging row of each order line."""
    return latest(t.lineitem, LINE_KEY, newest_line_order()).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )


@query(
    "usage_log",
    """SELECT event_id, user_id, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 20 DAYS AND ts < TIMESTAMP '2024-01-29'""",
)
def usage_log(t: Tables) -> DataFrame:
    """Hot log table: rows since the mark upserted (an overlap is harmless), old ones purged."""
    ev = t.events
    hot = ev.where(F.col("ts") < instant("2024-01-22"))
    out = refresh_log(hot, ev, ["event_id"], "ts", LoadWindow("2024-01-20", "2024-01-29"), instant("2024-01-31"), 20)
    return out.select("event_id", "user_id", "event_type", "value")


@query(
    "user_report",
    """WITH r AS (SELECT user_id, ts, event_id, event_type, '{"' || event_type || ';' || coalesce(nullif(event_type, 'view'), '') || ';all' AS members FROM events
  WHERE (user_id, CAST(ts AS DATE)) IN (SELECT user_id, max(CAST(ts AS DATE)) FROM events GROUP BY 1))
SELECT * FROM (SELECT user_id, event_id, unnest(regexp_split_to_array(members, '[;"{]')) AS member FROM r) WHERE member <> ''""",
)
def user_report(t: Tables) -> DataFrame:
    """Rows of each user's newest day, one per group member named in a text."""
    e = F.col("event_type")
    rows = t.events.select(
        "user_id", "event_id", F.col("ts").cast("date").alias("valid_from"),
        F.concat(F.lit('{"'), e, F.lit(";"), F.coalesce(F.nullif(e, F.lit("view")), F.lit("")), F.lit(";all")).alias("members"),
    )
    return member_rows(rows, ["user_id"], "valid_from", "members", '[;"{]', "member").select("user_id", "event_id", "member")

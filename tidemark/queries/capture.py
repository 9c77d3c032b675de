"""Keys, change capture, type-2 history, snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import day, instant, to_zone
from tidemark.functions.hashing import object_key, row_hash, surrogate_key
from tidemark.operators import history, snapshots
from tidemark.operators.dedup import latest
from tidemark.operators.timeline import valid_to
from tidemark.plans import pricing
from tidemark.queries.inputs import LINE_KEY, fiscal_cal, fiscal_sql, newest_line_order
from tidemark.queries.registry import Tables, query
from tidemark.queries.scans import BEFORE_AFTER_SQL, before_after
from tidemark.sources import sinks

TEXT = {
    "o_orderkey": "CAST({p}o_orderkey AS VARCHAR)",
    "o_orderstatus": "{p}o_orderstatus",
    "o_totalprice": "CAST(CAST({p}o_totalprice AS DECIMAL(38,6)) AS VARCHAR)",
    "o_orderdate": "CAST({p}o_orderdate AS VARCHAR)",
}


def hash_sql(cols: list[str], p: str = "") -> str:
    parts = ", ".join(f"'\"col{i + 1}\":' || {TEXT[c].format(p=p)}" for i, c in enumerate(cols))
    return f"md5('{{' || concat_ws(',', {parts}) || '}}')"


PAYLOAD = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


@query(
    "surrogate_keys",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, md5(CAST(l_partkey AS VARCHAR)) AS part_key,
  md5(l_orderkey || '--' || l_linenumber) AS line_key,
  md5('{' || concat_ws(',', '"COL1":' || l_suppkey, '"COL2":' || nullif(l_returnflag, 'N')) || '}') AS object_key FROM lineitem""",
)
def surrogate_keys(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        surrogate_key(F.col("l_partkey")).alias("part_key"),
        surrogate_key(F.col("l_orderkey"), F.col("l_linenumber")).alias("line_key"),
        object_key({"COL1": F.col("l_suppkey"), "COL2": F.nullif("l_returnflag", F.lit("N"))}).alias("object_key"),
    )


@query(
    "row_hash",
    """SELECT o_orderkey, md5('{' || concat_ws(',', '"col1":' || o_custkey, '"col2":' || o_orderstatus,
  '"col3":' || CAST(CAST(o_totalprice AS DECIMAL(38,6)) AS VARCHAR), '"col4":' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'),
  '"col5":' || o_orderpriority) || '}') AS row_md5 FROM orders""",
)
def row_hash_query(t: Tables) -> DataFrame:
    o = t.orders
    return o.select("o_orderkey", row_hash(o, exclude=["o_orderkey"]).alias("row_md5"))


def hashed(df: DataFrame) -> DataFrame:
    return df.withColumn("row_md5", row_hash(df, exclude=["o_custkey"]))


HASHED_SQL = f"""WITH {BEFORE_AFTER_SQL},
t AS (SELECT *, {hash_sql(PAYLOAD)} AS row_md5 FROM tgt), s AS (SELECT *, {hash_sql(PAYLOAD)} AS row_md5 FROM src_mix)"""
# The source repeats the newest order for customers without a new one, so many hashes are equal.
SRC_MIX_SQL = BEFORE_AFTER_SQL + """,
src_mix AS (SELECT * FROM src UNION ALL SELECT * FROM tgt WHERE o_custkey NOT IN (SELECT o_custkey FROM src))"""
HASHED_SQL = HASHED_SQL.replace(BEFORE_AFTER_SQL, SRC_MIX_SQL)


def hashed_pair(t: Tables) -> tuple[DataFrame, DataFrame]:
    old, new = before_after(t)
    mixed = new.unionByName(old.join(new.select("o_custkey"), "o_custkey", "left_anti"))
    return hashed(old), hashed(mixed)


@query(
    "cdc_changed",
    f"""{HASHED_SQL} SELECT s.o_custkey, s.o_orderkey, s.row_md5 FROM s LEFT JOIN t ON s.o_custkey = t.o_custkey
WHERE t.row_md5 IS NULL OR t.row_md5 <> s.row_md5""",
)
def cdc_changed(t: Tables) -> DataFrame:
    target, source = hashed_pair(t)
    return snapshots.changed(source, target, ["o_custkey"], "row_md5").select("o_custkey", "o_orderkey", "row_md5")


@query(
    "cdc_upsert",
    f"""{HASHED_SQL} SELECT coalesce(s.o_custkey, t.o_custkey) AS o_custkey,
  CASE WHEN c THEN s.o_orderkey ELSE t.o_orderkey END AS o_orderkey, CASE WHEN c THEN s.row_md5 ELSE t.row_md5 END AS row_md5,
  CASE WHEN t.o_custkey IS NULL THEN DATE '2001-08-02' ELSE DATE '2000-01-01' END AS ins_day,
  CASE WHEN c THEN DATE '2001-08-02' ELSE DATE '2000-01-01' END AS upd_day
FROM (SELECT o_custkey, t.row_md5 IS DISTINCT FROM s.row_md5 AND s.o_custkey IS NOT NULL AS c FROM s FULL JOIN t USING (o_custkey)) k
LEFT JOIN s USING (o_custkey) LEFT JOIN t USING (o_custkey)""",
)
def cdc_upsert(t: Tables) -> DataFrame:
    """New and changed customers take the new order; the insert day of known ones stays."""
    target, source = hashed_pair(t)
    stamp = lambda df, d: df.select(
        "o_custkey", "o_orderkey", "row_md5", day(d).alias("ins_day"), day(d).alias("upd_day")
    )
    return sinks.upsert(
        stamp(target, "2000-01-01"), stamp(source, "2001-08-02"), ["o_custkey"],
        ["o_orderkey", "row_md5", "upd_day"], hash_col="row_md5",
    )


# --- type-2 history: customers' newest orders, dated by order date ---------------------

HIST_COLS = ["o_custkey", "o_orderkey", "o_orderstatus", "valid_from", "valid_to", "version_id"]
VERSION_SQL = "md5(CAST(o_custkey AS VARCHAR) || '|' || CAST(o_orderdate AS VARCHAR))"
# Source of the second run: newest orders of customers who ordered since 1998.
SCD_SRC_SQL = """src AS (SELECT * EXCLUDE (rn) FROM (SELECT o_custkey, o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate,
    ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders WHERE o_orderdate >= TIMESTAMP '2000-06-01') WHERE rn = 1)"""
SCD_TGT_SQL = """tgt AS (SELECT * EXCLUDE (rn) FROM (SELECT o_custkey, o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate,
    ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders WHERE o_orderdate < TIMESTAMP '2000-06-01') WHERE rn = 1)"""


SCD_ALL_SQL = SCD_TGT_SQL.replace(" WHERE o_orderdate < TIMESTAMP '2000-06-01'", "")


def run_rows(t: Tables, since: str | None, until: str | None) -> DataFrame:
    o = t.orders
    if since:
        o = o.where(F.col("o_orderdate") >= instant(since))
    if until:
        o = o.where(F.col("o_orderdate") < instant(until))
    newest = latest(o, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
    return newest.select("o_custkey", "o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("o_orderdate"))


def shown(df: DataFrame) -> DataFrame:
    return df.select(
        "o_custkey", "o_orderkey", "o_orderstatus", "valid_from", F.date_format("valid_to", "yyyy-MM-dd HH:mm").alias("valid_to"), "version_id"
    )


@query(
    "scd2_init",
    f"""WITH {SCD_ALL_SQL} SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate AS valid_from, CAST(NULL AS VARCHAR) AS valid_to, {VERSION_SQL} AS version_id FROM tgt""",
)
def scd2_init(t: Tables) -> DataFrame:
    return shown(history.init(run_rows(t, None, None), ["o_custkey"], F.col("o_orderdate")))


APPLY_SQL = f"""WITH {SCD_TGT_SQL}, {SCD_SRC_SQL}
SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate AS valid_from, CAST(NULL AS VARCHAR) AS valid_to, {VERSION_SQL} AS version_id FROM src
UNION ALL SELECT t.o_custkey, t.o_orderkey, t.o_orderstatus, t.o_orderdate,
  CASE WHEN s.o_custkey IS NOT NULL THEN strftime(s.o_orderdate - 1, '%Y-%m-%d 00:00') ELSE {{gone}} END,
  md5(CAST(t.o_custkey AS VARCHAR) || '|' || CAST(t.o_orderdate AS VARCHAR))
FROM tgt t LEFT JOIN src s ON s.o_custkey = t.o_custkey"""


@query("scd2_apply", APPLY_SQL.format(gone="NULL"))
def scd2_apply(t: Tables) -> DataFrame:
    """Newer source date: close the day before, open a new version."""
    first = history.init(run_rows(t, None, "2000-06-01"), ["o_custkey"], F.col("o_orderdate"))
    return shown(history.apply(first, run_rows(t, "2000-06-01", None), ["o_custkey"], F.col("o_orderdate")))


@query("scd2_delete", APPLY_SQL.format(gone="'2001-08-02 06:30'"))
def scd2_delete(t: Tables) -> DataFrame:
    """Open rows whose key left the source are closed at the load time."""
    first = history.init(run_rows(t, None, "2000-06-01"), ["o_custkey"], F.col("o_orderdate"))
    return shown(
        history.apply(
            first, run_rows(t, "2000-06-01", None), ["o_custkey"], F.col("o_orderdate"),
            hard_deletes_at="2001-08-02 06:30:00",
        )
    )


@query(
    "scd2_same_day",
    f"""WITH {SCD_ALL_SQL}
SELECT o_custkey, o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_orderdate AS valid_from,
  CAST(NULL AS VARCHAR) AS valid_to, {VERSION_SQL} AS version_id FROM tgt""",
)
def scd2_same_day(t: Tables) -> DataFrame:
    """A change dated like the open version overwrites it in place."""
    rows = run_rows(t, None, None)
    fixed = rows.withColumn("o_orderstatus", F.when(F.col("o_orderstatus") == "P", "X").otherwise(F.col("o_orderstatus")))
    add = lambda df: df.withColumn("row_md5", row_hash(df, ["o_custkey"]))
    first = history.init(add(rows), ["o_custkey"], F.col("o_orderdate"))
    return shown(history.apply(first, add(fixed), ["o_custkey"], F.col("o_orderdate"), row_hash="row_md5"))


@query(
    "scd2_check",
    f"""WITH {SCD_ALL_SQL}, n AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_orderdate FROM tgt)
SELECT t.o_custkey, t.o_orderkey, t.o_orderstatus, t.o_orderdate AS valid_from,
  CASE WHEN t.o_orderstatus IS DISTINCT FROM n.o_orderstatus THEN '2001-08-01 00:00' END AS valid_to,
  md5(CAST(t.o_custkey AS VARCHAR) || '|' || CAST(t.o_orderdate AS VARCHAR)) AS version_id FROM tgt t JOIN n USING (o_custkey)
UNION ALL SELECT n.o_custkey, n.o_orderkey, n.o_orderstatus, DATE '2001-08-02', NULL, md5(CAST(n.o_custkey AS VARCHAR) || '|2001-08-02')
FROM tgt t JOIN n USING (o_custkey) WHERE t.o_orderstatus IS DISTINCT FROM n.o_orderstatus""",
)
def scd2_check(t: Tables) -> DataFrame:
    """Versions by comparing columns, nulls included, instead of dates."""
    rows = run_rows(t, None, None)
    changed = rows.withColumn("o_orderstatus", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")))
    first = history.init(rows, ["o_custkey"], F.col("o_orderdate"))
    return shown(
        history.apply(first, changed, ["o_custkey"], day("2001-08-02"), check_cols=["o_orderkey", "o_orderstatus"])
    )


@query(
    "scd2_new_column",
    f"""WITH {SCD_TGT_SQL}, {SCD_SRC_SQL}
SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate AS valid_from, CAST(NULL AS VARCHAR) AS valid_to, {VERSION_SQL} AS version_id,
  o_orderstatus || '!' AS note FROM src
UNION ALL SELECT t.o_custkey, t.o_orderkey, t.o_orderstatus, t.o_orderdate,
  CASE WHEN s.o_custkey IS NOT NULL THEN strftime(s.o_orderdate - 1, '%Y-%m-%d 00:00') END,
  md5(CAST(t.o_custkey AS VARCHAR) || '|' || CAST(t.o_orderdate AS VARCHAR)), NULL
FROM tgt t LEFT JOIN src s ON s.o_custkey = t.o_custkey""",
)
def scd2_new_column(t: Tables) -> DataFrame:
    """The source gains a column; old versions hold null in it."""
    first = history.init(run_rows(t, None, "2000-06-01"), ["o_custkey"], F.col("o_orderdate"))
    src = run_rows(t, "2000-06-01", None).withColumn("note", F.concat("o_orderstatus", F.lit("!")))
    out = history.apply(first, src, ["o_custkey"], F.col("o_orderdate"))
    return shown_with(out, "note")


def shown_with(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(
        "o_custkey", "o_orderkey", "o_orderstatus", "valid_from",
        F.date_format("valid_to", "yyyy-MM-dd HH:mm").alias("valid_to"), "version_id", *extra,
    )


# --- periodic snapshots ----------------------------------------------------------------


@query(
    "weekly_snapshot",
    f"""WITH {fiscal_sql("lineitem", "l_shipdate")},
newest AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1),
wk AS (SELECT DISTINCT fiscal_week FROM cal WHERE calendar_date IN (DATE '2000-01-01', DATE '1999-12-31'))
SELECT l_orderkey, l_linenumber, l_quantity, fiscal_week AS snapshot_week_key,
  md5('{{"COL1":' || fiscal_week || ',"COL2":' || l_orderkey || ',"COL3":' || l_linenumber || '}}') AS snapshot_key FROM newest, wk""",
)
def weekly_snapshot(t: Tables) -> DataFrame:
    """Newest lines stamped with the week; near midnight with both weeks."""
    calendar = fiscal_cal(t.lineitem, "l_shipdate")
    now = instant("2000-01-01 03:00:00")
    week_of = lambda d: calendar.where(F.col("calendar_date") == d).select("fiscal_week").scalar()
    weeks = [week_of(now.cast("date")), week_of(to_zone(now, "America/Phoenix").cast("date"))]
    out = snapshots.weekly_snapshot(t.lineitem, LINE_KEY, newest_line_order(), weeks)
    return out.select("l_orderkey", "l_linenumber", "l_quantity", "snapshot_week_key", "snapshot_key")


@query(
    "monthly_snapshot",
    """WITH newest AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS rn FROM lineitem) WHERE rn = 1)
SELECT l_partkey, l_suppkey, l_quantity, 200107 AS snapshot_month_key, md5('{"COL1":200107,"COL2":' || l_partkey || ',"COL3":' || l_suppkey || '}') AS working_capital_key FROM newest""",
)
def monthly_snapshot(t: Tables) -> DataFrame:
    """Inventory by part and supplier stamped with the fiscal month."""
    calendar = fiscal_cal(t.lineitem, "l_shipdate")
    month = calendar.where(F.col("calendar_date") == day("2001-07-25")).select("fiscal_month").scalar()
    order = [F.col(c).desc() for c in ("l_shipdate", "l_orderkey", "l_linenumber")]
    out = snapshots.weekly_snapshot(
        t.lineitem, ["l_partkey", "l_suppkey"], order, [month], "snapshot_month_key", "working_capital_key"
    )
    return out.select("l_partkey", "l_suppkey", "l_quantity", "snapshot_month_key", "working_capital_key")


@query(
    "local_time_view",
    """SELECT event_id, user_id, strftime(ts - INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS local_ts, event_type AS type FROM events""",
)
def local_time_view(t: Tables) -> DataFrame:
    """Presentation view: renamed columns, time stamps in local time."""
    return snapshots_view(t.events.select("event_id", "user_id", "ts", "event_type"))


def snapshots_view(ev: DataFrame) -> DataFrame:
    return ev.select(
        "event_id", "user_id",
        F.date_format(to_zone(F.col("ts"), "America/Phoenix"), "yyyy-MM-dd HH:mm:ss").alias("local_ts"),
        F.col("event_type").alias("type"),
    )


@query(
    "carry_forward",
    """WITH d AS (SELECT user_id, CAST(ts AS DATE) AS d, max(value) AS v FROM events GROUP BY 1, 2),
prev AS (SELECT * FROM d WHERE d = (SELECT max(d) FROM d WHERE d < DATE '2024-01-20')), delta AS (SELECT * FROM d WHERE d = DATE '2024-01-20')
SELECT user_id, DATE '2024-01-20' AS snapshot_day, v FROM delta
UNION ALL SELECT user_id, DATE '2024-01-20', v FROM prev WHERE user_id NOT IN (SELECT user_id FROM delta)""",
)
def carry_forward(t: Tables) -> DataFrame:
    daily = t.events.groupBy("user_id", F.col("ts").cast("date").alias("snapshot_day")).agg(F.max("value").alias("v"))
    delta = daily.where(F.col("snapshot_day") == day("2024-01-20"))
    return snapshots.carry_forward(delta, daily, ["user_id"], "snapshot_day", day("2024-01-20"))


@query(
    "freeze_first",
    """WITH f AS (SELECT user_id, max_by(value, event_id) FILTER (event_type = 'purchase') AS first_price FROM events WHERE ts < TIMESTAMP '2024-01-05' GROUP BY 1),
n AS (SELECT user_id, max_by(value, event_id) FILTER (event_type = 'purchase') AS first_price, count(*) AS events FROM events WHERE ts >= TIMESTAMP '2024-01-05' GROUP BY 1)
SELECT n.user_id, coalesce(f.first_price, n.first_price) AS first_price, events FROM n LEFT JOIN f ON n.user_id = f.user_id""",
)
def freeze_first(t: Tables) -> DataFrame:
    """A value set once stays."""
    ev, cut = t.events, instant("2024-01-05")
    price = F.max_by("value", F.when(F.col("event_type") == "purchase", F.col("event_id"))).alias("first_price")
    old = ev.where(F.col("ts") < cut).groupBy("user_id").agg(price)
    new = ev.where(F.col("ts") >= cut).groupBy("user_id").agg(price, F.count("*").alias("events"))
    return snapshots.freeze(new, old, ["user_id"], ["first_price"])


@query(
    "archive_day",
    """SELECT p_partkey, p_name, DATE '2001-12-31' AS snapshot_date, md5('{"PART":' || p_partkey || ',"DAY":2001-12-31}') AS archive_key FROM part""",
)
def archive_day(t: Tables) -> DataFrame:
    return snapshots.archive(t.part.select("p_partkey", "p_name"), {"PART": F.col("p_partkey")}, "2001-12-31")


PRICES_SQL = """a AS (SELECT l_partkey AS part_id, CAST(l_shipdate AS DATE) AS f, max(CAST(l_extendedprice AS DECIMAL(18,2))) AS price_a FROM lineitem
  WHERE l_returnflag = 'R' GROUP BY 1, 2),
b AS (SELECT l_partkey AS part_id, CAST(l_shipdate AS DATE) AS f, max(CAST(l_extendedprice AS DECIMAL(18,2))) AS price_b FROM lineitem
  WHERE l_returnflag = 'A' GROUP BY 1, 2),
a2 AS (SELECT *, coalesce(lead(f) OVER (PARTITION BY part_id ORDER BY f) - 1, DATE '9999-12-31') AS u FROM a),
b2 AS (SELECT *, coalesce(lead(f) OVER (PARTITION BY part_id ORDER BY f) - 1, DATE '9999-12-31') AS u FROM b),
dates AS (SELECT part_id, f FROM a UNION SELECT part_id, f FROM b),
spans AS (SELECT *, coalesce(lead(f) OVER (PARTITION BY part_id ORDER BY f) - 1, DATE '9999-12-31') AS u FROM dates),
merged AS (SELECT s.part_id, s.f AS effective_from, s.u AS effective_to, price_a, price_b FROM spans s
  LEFT JOIN a2 ON a2.part_id = s.part_id AND s.f BETWEEN a2.f AND a2.u LEFT JOIN b2 ON b2.part_id = s.part_id AND s.f BETWEEN b2.f AND b2.u)"""


def price_source(t: Tables, flag: str, out: str) -> DataFrame:
    """Dated prices of a part from lines of one kind, with their validity ends."""
    rows = (
        t.lineitem.where(F.col("l_returnflag") == flag)
        .groupBy(F.col("l_partkey").alias("part_id"), F.col("l_shipdate").cast("date").alias("effective_from"))
        .agg(F.max(F.col("l_extendedprice").cast("decimal(18,2)")).alias(out))
    )
    return valid_to(rows, ["part_id"], "effective_from", "effective_to", ranged=True)


@query(
    "merge_timelines",
    f"""WITH {PRICES_SQL} SELECT part_id, effective_from, effective_to, CAST(price_a AS DOUBLE) AS price_a, CAST(price_b AS DOUBLE) AS price_b FROM merged""",
)
def merge_timelines(t: Tables) -> DataFrame:
    out = history.merge_timelines(
        price_source(t, "R", "price_a"), price_source(t, "A", "price_b"),
        "part_id", "effective_from", "effective_to", ["price_a"], ["price_b"],
        ranged=True,
    )
    return out.withColumn("price_a", F.col("price_a").cast("double")).withColumn("price_b", F.col("price_b").cast("double"))


@query(
    "version_status",
    f"""WITH {PRICES_SQL} SELECT part_id, effective_from, CASE WHEN effective_from > DATE '2000-01-01' THEN 'Staged'
  WHEN effective_from <= (SELECT max(f) FROM a) AND effective_to >= DATE '2000-01-01' THEN 'Current'
  WHEN price_b < 50000 THEN 'Deleted' ELSE 'Expired' END AS status FROM merged""",
)
def version_status(t: Tables) -> DataFrame:
    a = price_source(t, "R", "price_a")
    out = merge_timelines(t)
    status = history.version_status(
        F.col("effective_from"), F.col("effective_to"), F.col("price_b") < 50000, day("2000-01-01"),
        a.agg(F.max("effective_from")).scalar(),
    )
    return out.select("part_id", "effective_from", status.alias("status"))


@query(
    "expire_open",
    """WITH t AS (SELECT l_partkey AS part_id, CAST(max(l_shipdate) AS DATE) AS effective_from FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01' GROUP BY 1),
s AS (SELECT l_partkey AS part_id, CAST(min(l_shipdate) AS DATE) AS n FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01' AND l_returnflag = 'R' GROUP BY 1)
SELECT t.part_id, effective_from, CASE WHEN n IS NOT NULL THEN n - 1 ELSE DATE '9999-12-31' END AS effective_to,
  CASE WHEN n IS NOT NULL THEN 'Expired' ELSE 'Current' END AS status FROM t LEFT JOIN s ON t.part_id = s.part_id""",
)
def expire_open(t: Tables) -> DataFrame:
    li, cut = t.lineitem, instant("2000-01-01")
    target = (
        li.where(F.col("l_shipdate") < cut)
        .groupBy(F.col("l_partkey").alias("part_id"))
        .agg(F.max("l_shipdate").cast("date").alias("effective_from"))
        .select("part_id", "effective_from", day("9999-12-31").alias("effective_to"), F.lit("Current").alias("status"))
    )
    stage = (
        li.where((F.col("l_shipdate") >= cut) & (F.col("l_returnflag") == "R"))
        .groupBy(F.col("l_partkey").alias("part_id"))
        .agg(F.min("l_shipdate").cast("date").alias("effective_from"))
    )
    return history.expire_open(target, stage, ["part_id"], "effective_from", "effective_to", "status")


@query(
    "price_timeline",
    f"""WITH {PRICES_SQL}, firsts AS (SELECT part_id, min(f) AS first_from FROM a GROUP BY 1)
SELECT md5('{{"COL1":' || m.part_id || ',"COL2":' || effective_from || '}}') AS price_key, m.part_id, effective_from, effective_to,
  CAST(m.price_a AS DOUBLE) AS price_a, CAST(price_b AS DOUBLE) AS price_b,
  CASE WHEN effective_from > DATE '2000-01-01' THEN 'Staged'
  WHEN effective_from <= (SELECT max(f) FROM a) AND effective_to >= DATE '2000-01-01' THEN 'Current'
  WHEN price_b < 50000 THEN 'Deleted' ELSE 'Expired' END AS status,
  coalesce(x.f = first_from, false) AS is_first_price
FROM merged m LEFT JOIN a2 x ON x.part_id = m.part_id AND m.effective_from BETWEEN x.f AND x.u LEFT JOIN firsts ON firsts.part_id = m.part_id""",
)
def price_timeline(t: Tables) -> DataFrame:
    """Price worksheet history of two sources."""
    return pricing.price_history(
        price_source(t, "R", "price_a"), price_source(t, "A", "price_b"), "2000-01-01", F.col("price_b") < 50000
    )

"""Joins: lookups, merges, effective dates, cascades, pairings, as-of."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import day
from tidemark.functions.numbers import dec
from tidemark.operators import calendar as cal
from tidemark.operators import joins, matching
from tidemark.operators.joins import Rule
from tidemark.plans import npd
from tidemark.queries.inputs import RATES_SQL, fiscal_cal, fiscal_sql, rate_table
from tidemark.queries.registry import Tables, query

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
LINE_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity"


@query(
    "inner_join",
    """SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def inner_join(t: Tables) -> DataFrame:
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_name", "c_mktsegment"
    )


@query(
    "enrich_lineitem",
    f"""SELECT {LINE_SQL}, o_orderstatus AS order_status, c_name AS customer, n_name AS nation, r_name AS region,
  p_brand AS brand, s_name AS supplier
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey""",
)
def enrich_lineitem(t: Tables) -> DataFrame:
    out = joins.enrich(
        t.lineitem.select(*LINE),
        [
            (t.orders, {"l_orderkey": "o_orderkey"}, {"order_status": "o_orderstatus", "_cust": "o_custkey"}),
            (t.customer, {"_cust": "c_custkey"}, {"customer": "c_name", "_nation": "c_nationkey"}),
            (t.nation, {"_nation": "n_nationkey"}, {"nation": "n_name", "_region": "n_regionkey"}),
            (t.region, {"_region": "r_regionkey"}, {"region": "r_name"}),
            (t.part, {"l_partkey": "p_partkey"}, {"brand": "p_brand"}),
            (t.supplier, {"l_suppkey": "s_suppkey"}, {"supplier": "s_name"}),
        ],
    )
    return out.drop("_cust", "_nation", "_region")


@query(
    "merge_customer_supplier",
    """SELECT coalesce(c_custkey, s_suppkey) AS party, coalesce(s_acctbal, c_acctbal) AS balance,
  coalesce(c_name, s_name) AS name, coalesce(c_nationkey, s_nationkey) AS nation, c_mktsegment AS segment
FROM customer FULL JOIN supplier ON c_custkey = s_suppkey""",
)
def merge_customer_supplier(t: Tables) -> DataFrame:
    c = t.customer.select(
        F.col("c_custkey").alias("party"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
    )
    s = t.supplier.select(
        F.col("s_suppkey").alias("party"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"),
        F.col("s_acctbal").alias("balance"),
    )
    return joins.merge_sources(c, s, ["party"], prefer_second=["balance"]).select(
        "party", "balance", "name", "nation", "segment"
    )


@query(
    "precedence_union",
    """WITH a AS (SELECT l_partkey AS k, 1 AS src FROM lineitem WHERE l_quantity = 50 AND l_returnflag = 'R'),
b AS (SELECT l_partkey AS k, 2 AS src FROM lineitem WHERE l_quantity = 49), c AS (SELECT p_partkey AS k, 3 AS src FROM part)
SELECT * FROM a UNION ALL SELECT * FROM b WHERE k NOT IN (SELECT k FROM a)
UNION ALL SELECT * FROM c WHERE k NOT IN (SELECT k FROM a) AND k NOT IN (SELECT k FROM b)""",
)
def precedence_union(t: Tables) -> DataFrame:
    li = t.lineitem
    src = lambda df, key, n: df.select(F.col(key).alias("k"), F.lit(n).alias("src"))
    return joins.precedence_union(
        [
            src(li.where((F.col("l_quantity") == 50) & (F.col("l_returnflag") == "R")), "l_partkey", 1),
            src(li.where(F.col("l_quantity") == 49), "l_partkey", 2),
            src(t.part, "p_partkey", 3),
        ],
        ["k"],
    )


@query(
    "stamp_week",
    f"""WITH {fiscal_sql("orders", "o_orderdate")}
SELECT c_custkey, (SELECT fiscal_week FROM cal WHERE calendar_date = DATE '2001-07-25') AS snapshot_week_key FROM customer""",
)
def stamp_week(t: Tables) -> DataFrame:
    calendar = fiscal_cal(t.orders, "o_orderdate")
    week = calendar.where(F.col("calendar_date") == day("2001-07-25"))
    return joins.stamp_period(t.customer.select("c_custkey"), week, "fiscal_week", "snapshot_week_key")


@query(
    "npd_timeline",
    """WITH part_master AS (SELECT l_partkey AS k, CAST(min(l_shipdate) AS DATE) AS d FROM lineitem GROUP BY 1),
merged AS (SELECT coalesce(k, p_partkey) AS part_id, CASE WHEN d > DATE '1990-01-01' THEN
    CASE WHEN month(d) = 12 AND day(d) = 31 THEN d + 1 ELSE d END ELSE DATE '1990-01-02' END AS s
  FROM part_master FULL JOIN part ON k = p_partkey)
SELECT part_id, 'New Request' AS npd_bucket, DATE '1990-01-01' AS effective_from, s - 1 AS effective_to FROM merged
UNION ALL SELECT part_id, '0 to 3 years', s, CAST(s + INTERVAL 3 YEAR - INTERVAL 1 DAY AS DATE) FROM merged
UNION ALL SELECT part_id, '3 to 5 years', CAST(s + INTERVAL 3 YEAR AS DATE), CAST(s + INTERVAL 5 YEAR - INTERVAL 1 DAY AS DATE) FROM merged
UNION ALL SELECT part_id, '5 to 7 years', CAST(s + INTERVAL 5 YEAR AS DATE), CAST(s + INTERVAL 7 YEAR - INTERVAL 1 DAY AS DATE) FROM merged
UNION ALL SELECT part_id, '7 to 10 years', CAST(s + INTERVAL 7 YEAR AS DATE), CAST(s + INTERVAL 10 YEAR - INTERVAL 1 DAY AS DATE) FROM merged
UNION ALL SELECT part_id, 'Greater than 10 years', CAST(s + INTERVAL 10 YEAR AS DATE), DATE '9999-12-31' FROM merged""",
)
def npd_timeline(t: Tables) -> DataFrame:
    parts = t.lineitem.groupBy(F.col("l_partkey").alias("part_id")).agg(
        F.min("l_shipdate").cast("date").alias("defined_on")
    )
    products = t.part.select(F.col("p_partkey").alias("part_id"))
    return npd.bucket_timeline(parts, products)


@query(
    "effective_join",
    f"""SELECT {", ".join("f." + c for c in LINE)}, r.l_suppkey AS ref_supplier
FROM lineitem f LEFT JOIN lineitem r ON r.l_partkey = f.l_partkey AND r.l_returnflag = 'R' AND r.l_quantity = 50
  AND f.l_shipdate BETWEEN r.l_shipdate AND r.l_shipdate + INTERVAL 200 DAYS""",
)
def effective_join(t: Tables) -> DataFrame:
    """Lines with the suppliers whose (overlapping) validity covers the ship date."""
    li = t.lineitem
    ref = li.where((F.col("l_returnflag") == "R") & (F.col("l_quantity") == 50)).select(
        "l_partkey",
        F.col("l_suppkey").alias("ref_supplier"),
        F.col("l_shipdate").cast("date").alias("valid_from"),
        F.date_add(F.col("l_shipdate").cast("date"), 200).alias("valid_to"),
    )
    facts = li.select(*LINE, F.col("l_shipdate").cast("date").alias("ship_day"))
    return joins.join_effective(
        facts, ref, ["l_partkey"], "ship_day", "valid_from", "valid_to", ["ref_supplier"]
    ).drop("ship_day")


@query(
    "effective_latest",
    f"""WITH r AS (SELECT l_partkey AS p, l_suppkey AS s, CAST(l_shipdate AS DATE) AS f,
  CASE WHEN l_linenumber = 1 THEN DATE '9999-12-31' WHEN l_linenumber = 2 THEN CAST(l_shipdate AS DATE) ELSE CAST(l_shipdate AS DATE) + 300 END AS u
  FROM lineitem WHERE l_quantity >= 49 AND l_returnflag = 'R'),
d AS (SELECT DISTINCT l_partkey AS p, CAST(l_shipdate AS DATE) AS day FROM lineitem),
best AS (SELECT d.p, day, s FROM d JOIN r ON r.p = d.p AND day BETWEEN f AND u
  QUALIFY row_number() OVER (PARTITION BY d.p, day ORDER BY f DESC, s) = 1)
SELECT {LINE_SQL}, s AS newest_supplier FROM lineitem LEFT JOIN best ON p = l_partkey AND day = CAST(l_shipdate AS DATE)""",
)
def effective_latest(t: Tables) -> DataFrame:
    """Lines with the supplier of the rule that began last of those valid on the ship date; a rule
    holds for one day, 300 days or without end."""
    li = t.lineitem
    began = F.col("l_shipdate").cast("date")
    no = F.col("l_linenumber")
    rules = li.where((F.col("l_quantity") >= 49) & (F.col("l_returnflag") == "R")).select(
        "l_partkey", "l_suppkey", began.alias("valid_from"),
        F.when(no == 1, day("9999-12-31")).when(no == 2, began).otherwise(F.date_add(began, 300)).alias("valid_to"),
    )
    newest = matching.Choice(
        "newest_supplier", rules, "l_suppkey", "valid_from", "valid_to", [matching.Rule({"l_partkey": "l_partkey"})],
        latest=True,
    )
    return matching.match_rules(li.select(*LINE, began.alias("ship_day")), [newest], "ship_day").drop("ship_day")


@query(
    "cascade_lookup",
    f"""WITH ref AS (SELECT l_partkey AS p, l_suppkey AS s, l_returnflag AS g, l_linenumber AS v FROM lineitem WHERE l_quantity = 50 AND l_linestatus = 'F'),
r1 AS (SELECT p, s, min(v) AS v FROM ref GROUP BY 1, 2), r2 AS (SELECT p, min(v) AS v FROM ref WHERE g = 'A' GROUP BY 1),
r3 AS (SELECT s, min(v) AS v FROM ref WHERE g = 'N' GROUP BY 1)
SELECT {LINE_SQL}, coalesce(r1.v, r2.v, r3.v, 0) AS found,
  CASE WHEN r1.v IS NOT NULL THEN 1 WHEN r2.v IS NOT NULL THEN 2 WHEN r3.v IS NOT NULL THEN 3 END AS rule_no
FROM lineitem LEFT JOIN r1 ON l_partkey = r1.p AND l_suppkey = r1.s LEFT JOIN r2 ON l_partkey = r2.p
LEFT JOIN r3 ON l_suppkey = r3.s AND l_returnflag = 'R'""",
)
def cascade_lookup(t: Tables) -> DataFrame:
    li = t.lineitem
    ref = li.where((F.col("l_quantity") == 50) & (F.col("l_linestatus") == "F")).select(
        F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"), F.col("l_returnflag").alias("g"),
        F.col("l_linenumber").alias("v"),
    )
    out = joins.cascade_lookup(
        li.select(*LINE, "l_returnflag"),
        ref,
        [
            Rule({"l_partkey": "p", "l_suppkey": "s"}),
            Rule({"l_partkey": "p"}, where=F.col("g") == "A"),
            Rule({"l_suppkey": "s"}, where=F.col("g") == "N", when=F.col("l_returnflag") == "R"),
        ],
        "v",
        "found",
        default=F.lit(0),
        rule_out="rule_no",
    )
    return out.drop("l_returnflag")


@query(
    "parent_lookup",
    """SELECT o.o_orderkey, p.o_orderkey AS parent_key, p.o_orderstatus AS parent_status
FROM orders o LEFT JOIN orders p ON p.o_orderkey = o.o_custkey""",
)
def parent_lookup(t: Tables) -> DataFrame:
    """Self join: the row another row names as its parent."""
    o = t.orders
    parent = o.select(F.col("o_orderkey").alias("parent_key"), F.col("o_orderstatus").alias("parent_status"))
    return o.join(parent, F.col("o_custkey") == F.col("parent_key"), "left").select(
        "o_orderkey", "parent_key", "parent_status"
    )


@query("cross_rates", f"WITH {RATES_SQL} SELECT month, from_cur, to_cur, rate FROM cross_rates")
def cross_rates(t: Tables) -> DataFrame:
    return joins.cross_rates(rate_table(t))


@query(
    "expand_months",
    """WITH c AS (SELECT o_custkey, CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS a, CAST(date_trunc('month', max(o_orderdate)) AS DATE) AS b
  FROM orders GROUP BY 1)
SELECT o_custkey, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month_begin FROM c""",
)
def expand_months(t: Tables) -> DataFrame:
    span = t.orders.groupBy("o_custkey").agg(
        F.trunc(F.min("o_orderdate"), "month").alias("a"), F.trunc(F.max("o_orderdate"), "month").alias("b")
    )
    return joins.expand_periods(span, "a", "b", "month_begin").select("o_custkey", "month_begin")


HOLDS_SQL = """first_hold AS (SELECT user_id, min(event_id) AS f FROM events WHERE event_type = 'error' GROUP BY 1),
opens AS (SELECT user_id, event_id AS open_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events WHERE event_type = 'error'),
closes AS (SELECT e.user_id, event_id AS close_id, ROW_NUMBER() OVER (PARTITION BY e.user_id ORDER BY event_id) AS rn
  FROM events e JOIN first_hold h ON e.user_id = h.user_id WHERE event_type = 'purchase' AND event_id > f),
holds AS (SELECT o.user_id, o.rn, open_id, close_id FROM opens o LEFT JOIN closes c ON o.user_id = c.user_id AND o.rn = c.rn)"""


def holds(t: Tables) -> DataFrame:
    return joins.pair_nth(
        t.events.select("user_id", "event_id", "event_type"), ["user_id"], "event_id",
        F.col("event_type") == "error", F.col("event_type") == "purchase", ranged=True,
    )


@query("pair_nth_events", f"WITH {HOLDS_SQL} SELECT user_id, rn, open_id, close_id FROM holds")
def pair_nth_events(t: Tables) -> DataFrame:
    return holds(t)


@query(
    "inside_hold",
    f"""WITH {HOLDS_SQL}
SELECT e.event_id, e.user_id, count(h.open_id) AS open_holds, count(h.open_id) > 0 AS is_hold
FROM events e LEFT JOIN holds h ON e.user_id = h.user_id AND e.event_id > open_id AND (close_id IS NULL OR e.event_id < close_id)
GROUP BY 1, 2""",
)
def inside_hold(t: Tables) -> DataFrame:
    ev = t.events.select("event_id", "user_id")
    out = joins.inside_intervals(ev, holds(t), ["user_id"], "event_id", "open_holds", ranged=True)
    return out.withColumn("is_hold", F.col("open_holds") > 0)


@query(
    "asof_prior_event",
    """SELECT event_id, user_id, prior_id, CAST(prior_value AS DOUBLE) AS prior_value FROM (
  SELECT l.event_id, l.user_id, r.event_id AS prior_id, r.value AS prior_value,
    ROW_NUMBER() OVER (PARTITION BY l.event_id ORDER BY r.ts DESC NULLS LAST, r.event_id DESC) AS rn
  FROM (SELECT * FROM events WHERE event_type = 'purchase') l
  LEFT JOIN events r ON r.user_id = l.user_id AND r.event_type = 'view' AND r.ts < l.ts) WHERE rn = 1""",
)
def asof_prior_event(t: Tables) -> DataFrame:
    """For each purchase the user's newest earlier view."""
    ev = t.events
    left = ev.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    right = ev.where(F.col("event_type") == "view").select(
        "user_id", "ts", F.col("event_id").alias("prior_id"), F.col("value").alias("prior_value")
    )
    return joins.asof_join(
        left, right, ["user_id"], "ts", "ts", ["prior_id", "prior_value"], allow_equal=False,
        tie="prior_id", ranged=True,
    ).select("event_id", "user_id", "prior_id", "prior_value")


@query(
    "quarter_offsets",
    f"""WITH {fiscal_sql("orders", "o_orderdate")},
p AS (SELECT DISTINCT fiscal_quarter, 4 * (fiscal_year - 1970) + fiscal_quarter % 10 - 1 AS seq FROM cal)
SELECT p.fiscal_quarter, b4.fiscal_quarter AS prior_four, b1.fiscal_quarter AS prior_one, n1.fiscal_quarter AS next_one,
  n4.fiscal_quarter AS next_four
FROM p LEFT JOIN p b4 ON b4.seq = p.seq - 4 LEFT JOIN p b1 ON b1.seq = p.seq - 1 LEFT JOIN p n1 ON n1.seq = p.seq + 1
LEFT JOIN p n4 ON n4.seq = p.seq + 4""",
)
def quarter_offsets(t: Tables) -> DataFrame:
    days = fiscal_cal(t.orders, "o_orderdate").withColumn(
        "seq", 4 * (F.col("fiscal_year") - 1970) + F.col("fiscal_quarter") % 10 - 1
    )
    return cal.period_offsets(
        days, "fiscal_quarter", "seq", {"prior_four": -4, "prior_one": -1, "next_one": 1, "next_four": 4}
    ).drop("seq")


@query(
    "regex_key_join",
    r"""SELECT c_custkey, c_name, o_orderkey FROM customer
LEFT JOIN orders ON o_orderkey = CAST(nullif(regexp_extract(substr(c_name, 5), '[0-9]+'), '') AS BIGINT)""",
)
def regex_key_join(t: Tables) -> DataFrame:
    """Join on digits found inside a name; no digits, no match."""
    c = t.customer.select("c_custkey", "c_name").withColumn(
        "_key", F.regexp_substr(F.expr("substring(c_name, 5)"), F.lit("[0-9]+")).try_cast("bigint")
    )
    return c.join(t.orders, F.col("_key") == F.col("o_orderkey"), "left").select("c_custkey", "c_name", "o_orderkey")


@query(
    "concat_key_join",
    f"""SELECT {LINE_SQL}, e.event_id FROM lineitem LEFT JOIN (
  SELECT CAST(user_id AS VARCHAR) || ':' || CAST(day(ts) AS VARCHAR) AS k, max(event_id) AS event_id FROM events GROUP BY 1) e
ON CAST(l_suppkey AS VARCHAR) || ':' || CAST(day(l_shipdate) AS VARCHAR) = e.k""",
)
def concat_key_join(t: Tables) -> DataFrame:
    """Two columns glued with a colon on both sides."""
    glue = lambda a, b: F.concat(F.col(a).cast("string"), F.lit(":"), F.dayofmonth(b).cast("string"))
    ev = t.events.groupBy(glue("user_id", "ts").alias("_k")).agg(F.max("event_id").alias("event_id"))
    li = t.lineitem.select(*LINE, glue("l_suppkey", "l_shipdate").alias("_lk"))
    return li.join(ev, F.col("_lk") == F.col("_k"), "left").select(*LINE, "event_id")


@query(
    "vs_global_max",
    f"""SELECT {LINE_SQL}, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) - (SELECT max(CAST(l_extendedprice AS DECIMAL(18,2))) FROM lineitem) AS DOUBLE) AS below_top
FROM lineitem""",
)
def vs_global_max(t: Tables) -> DataFrame:
    """A one-row aggregate against every row."""
    li = t.lineitem
    top = li.agg(F.max(dec(F.col("l_extendedprice")))).scalar()
    return li.select(*LINE, (dec(F.col("l_extendedprice")) - top).cast("double").alias("below_top"))


@query(
    "choose_attribution",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN b.region ELSE 'DIRECT' END AS region,
  CASE WHEN o_orderstatus = 'F' THEN b.seg ELSE o_orderpriority END AS seg
FROM orders LEFT JOIN (SELECT c_custkey, r_name AS region, c_mktsegment AS seg FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey) b ON o_custkey = c_custkey""",
)
def choose_attribution(t: Tables) -> DataFrame:
    bridge = (
        t.customer
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("c_custkey").alias("o_custkey"), F.col("r_name").alias("region"), F.col("c_mktsegment").alias("seg"))
    )
    facts = t.orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.lit("DIRECT").alias("region"), F.col("o_orderpriority").alias("seg")
    )
    return joins.choose_attribution(
        facts, bridge, ["o_custkey"], F.col("o_orderstatus") == "F", ["region", "seg"]
    ).select("o_orderkey", "region", "seg")


ROLES = {"sales_rep": "click", "support": "view", "engineer": "signup"}


@query(
    "lookup_roles",
    """WITH p AS (SELECT user_id, max(CASE WHEN event_type = 'click' THEN event_id END) AS sales_rep,
  max(CASE WHEN event_type = 'view' THEN event_id END) AS support, max(CASE WHEN event_type = 'signup' THEN event_id END) AS engineer
  FROM events GROUP BY 1)
SELECT c_custkey, sales_rep, support, engineer FROM customer LEFT JOIN p ON c_custkey = user_id""",
)
def lookup_roles(t: Tables) -> DataFrame:
    ref = t.events.withColumnRenamed("user_id", "c_custkey")
    return joins.lookup_roles(
        t.customer.select("c_custkey"), ref, ["c_custkey"], "event_type", "event_id", ROLES
    )



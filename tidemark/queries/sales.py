"""Sales pipelines on order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import day, instant
from tidemark.functions.hashing import member_key, object_key
from tidemark.functions.numbers import dec
from tidemark.functions.text import parse_flag
from tidemark.operators import joins
from tidemark.operators.dedup import latest
from tidemark.plans import attribution, backlog, billing, consumption, funnel, parts, pos, product
from tidemark.queries.inputs import CUT_SQL, RATES_SQL, fiscal_cal, fiscal_sql, rate_table
from tidemark.queries.registry import Tables, query
from tidemark.queries.scans import SEGMENT_REF_SQL, segment_ref

ACTIVITY_SQL = "CASE l_returnflag WHEN 'R' THEN 'REVERSAL' WHEN 'N' THEN 'MANUAL_ADJUSTMENT' ELSE 'INVOICE' END"
ACCRUAL_SQL = "CASE l_linestatus WHEN 'F' THEN 'Y' ELSE 'N' END"
TXN_SQL = "l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(l_quantity AS INT)"


def activity():
    return (
        F.when(F.col("l_returnflag") == "R", "REVERSAL")
        .when(F.col("l_returnflag") == "N", "MANUAL_ADJUSTMENT")
        .otherwise("INVOICE")
    )


def accrual_flag():
    return F.when(F.col("l_linestatus") == "F", "Y").otherwise("N")


def txn_id():
    parts_ = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return F.concat_ws("-", *[F.col(c).cast("string") for c in parts_], F.col("l_quantity").cast("int").cast("string"))


SIGNS_SQL = """signs AS (SELECT *,
  CASE WHEN accrual = 'Y' OR activity = 'MANUAL_ADJUSTMENT' THEN 0 WHEN activity = 'REVERSAL' THEN -q ELSE q END AS gross_quantity,
  CASE WHEN accrual = 'Y' THEN 0 WHEN activity IN ('REVERSAL', 'MANUAL_ADJUSTMENT') THEN -q ELSE q END AS net_quantity,
  CASE WHEN accrual = 'Y' OR activity = 'MANUAL_ADJUSTMENT' THEN 0 WHEN activity = 'REVERSAL' THEN acc ELSE amt END AS gross_amount,
  CASE WHEN activity IN ('REVERSAL', 'MANUAL_ADJUSTMENT') THEN acc WHEN accrual = 'Y' THEN -acc ELSE amt END AS net_amount,
  CASE WHEN activity = 'REVERSAL' THEN 0 WHEN activity = 'MANUAL_ADJUSTMENT' THEN acc ELSE -acc END AS accrual_amount
FROM base)"""
MEASURES = ["gross_quantity", "net_quantity", "gross_amount", "net_amount", "accrual_amount"]
BASE_SQL = f"""SELECT *, {ACTIVITY_SQL} AS activity, {ACCRUAL_SQL} AS accrual, CAST(l_quantity AS DECIMAL(18,2)) AS q,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS amt, round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)), 2) AS acc FROM lineitem"""


@query(
    "billing_signs",
    f"""WITH base AS ({BASE_SQL}), {SIGNS_SQL}
SELECT {TXN_SQL} AS txn_id, {", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in MEASURES)} FROM signs""",
)
def billing_signs(t: Tables) -> DataFrame:
    amount = dec(F.col("l_extendedprice"))
    m = billing.signed_measures(
        activity(), accrual_flag(), dec(F.col("l_quantity")), amount, F.round(amount * dec(F.col("l_discount")), 2)
    )
    return t.lineitem.select(txn_id().alias("txn_id"), *[c.cast("double").alias(n) for n, c in m.items()])


@query(
    "process_date_shift",
    f"""WITH {fiscal_sql("lineitem", "l_shipdate")},
b AS (SELECT *, min(calendar_date) OVER (PARTITION BY fiscal_week) AS wb, min(calendar_date) OVER (PARTITION BY fiscal_month) AS mb FROM cal)
SELECT {TXN_SQL} AS txn_id, CASE WHEN {ACTIVITY_SQL} = 'MANUAL_ADJUSTMENT' THEN CAST(o_orderdate AS DATE)
  WHEN wb <> mb AND CAST(o_orderdate AS DATE) < wb THEN wb ELSE CAST(o_orderdate AS DATE) END AS process_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN b ON calendar_date = CAST(l_shipdate AS DATE)""",
)
def process_date_shift(t: Tables) -> DataFrame:
    """Order dates against the fiscal week of the ship date, so the shift does act."""
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    df = lines.withColumn("_day", F.col("l_shipdate").cast("date")).join(week_bounds(t), F.col("_day") == F.col("calendar_date"), "left")
    when = billing.process_date(
        F.col("o_orderdate").cast("date"), activity(), F.col("fiscal_week_begin_date"), F.col("fiscal_month_begin_date")
    )
    return df.select(txn_id().alias("txn_id"), when.alias("process_date"))


def week_bounds(t: Tables) -> DataFrame:
    days = fiscal_cal(t.lineitem, "l_shipdate")
    first = lambda p: days.groupBy(f"fiscal_{p}").agg(F.min("calendar_date").alias(f"fiscal_{p}_begin_date"))
    return days.join(first("week"), "fiscal_week").join(first("month"), "fiscal_month")


@query(
    "billing_fact",
    f"""WITH {fiscal_sql("lineitem", "l_shipdate")}, {RATES_SQL}, base AS ({BASE_SQL}), {SIGNS_SQL},
d AS (SELECT *, CAST(l_shipdate AS DATE) AS pd, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS n FROM signs),
j AS (SELECT d.*, o_custkey, fiscal_week, a.rate AS ra, b.rate AS rb FROM d LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN cal ON calendar_date = pd
  LEFT JOIN cross_rates a ON a.month = CAST(strftime(pd, '%Y%m') AS INT) AND a.from_cur = o_orderpriority AND a.to_cur = '5-LOW'
  LEFT JOIN cross_rates b ON b.month = CAST(strftime(pd, '%Y%m') AS INT) AND b.from_cur = o_orderpriority AND b.to_cur = '2-HIGH')
SELECT md5('{{"COL1":' || l_orderkey || ',"COL2":' || l_linenumber || ',"COL3":' || n || ',"COL4":' || pd || '}}') AS billing_key,
  md5(coalesce(CAST(o_custkey AS VARCHAR), '-1')) AS customer_key, md5(CAST(l_partkey AS VARCHAR)) AS product_key,
  CAST(strftime(pd, '%Y%m%d') AS INT) AS process_date_key, fiscal_week, {", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in MEASURES)},
  {CUT_SQL.format(amount="net_amount", rate="ra")} AS net_amount_low, {CUT_SQL.format(amount="net_amount", rate="rb")} AS net_amount_high FROM j""",
)
def billing_fact(t: Tables) -> DataFrame:
    staging = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"), F.col("l_partkey").alias("product"),
        F.col("l_suppkey").alias("seller"), F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("unit_amount"),
        F.col("l_discount").alias("discount"), activity().alias("activity"), accrual_flag().alias("accrual"),
        F.col("l_shipdate").cast("date").alias("ship_day"),
    )
    orders = t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer"), F.col("o_orderpriority").alias("currency")
    )
    return billing.billing_fact(
        staging, orders, week_bounds(t), joins.cross_rates(rate_table(t)), ("net_amount_low", "5-LOW"), ("net_amount_high", "2-HIGH")
    )


@query(
    "backlog_delinquency",
    f"""WITH b AS (SELECT {TXN_SQL} AS line_id, CASE o_orderstatus WHEN 'P' THEN 'FORECAST' ELSE 'ORDER' END AS demand_type,
  l_returnflag = 'R' AS a, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)) AS accrual,
  CASE WHEN l_tax = 0 THEN 0 ELSE CAST(l_quantity AS DECIMAL(18,2)) END AS q, CASE WHEN l_linenumber < 3 THEN CAST(o_orderdate AS DATE) + 60 END AS req, CAST(l_shipdate AS DATE) AS sch,
  CASE WHEN l_linestatus = 'O' THEN CAST(o_orderdate AS DATE) + 90 END AS pro, CASE o_orderpriority WHEN '1-URGENT' THEN 'OMD' WHEN '2-HIGH' THEN 'INT-SPS' ELSE 'DIST' END AS class
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'F')
SELECT line_id, demand_type, CAST(CASE WHEN a THEN 0 ELSE amount END AS DOUBLE) AS gross_amount, CAST(CASE WHEN a THEN -accrual ELSE amount END AS DOUBLE) AS net_amount,
  CAST(CASE WHEN a THEN 0 ELSE q END AS DOUBLE) AS net_quantity, coalesce(req, DATE '1960-01-01') AS requested_date, sch AS scheduled_date, coalesce(pro, DATE '1960-01-01') AS promised_date,
  CASE WHEN req <= DATE '2000-06-30' THEN 'Y' ELSE 'N' END AS is_requested_late, CASE WHEN sch <= DATE '2000-06-30' THEN 'Y' ELSE 'N' END AS is_scheduled_late,
  CASE WHEN pro <= DATE '2000-06-30' THEN 'Y' ELSE 'N' END AS is_promised_late,
  CASE WHEN class IN ('OMD', 'INT-SPS') OR q = 0 THEN 'N' WHEN req <= DATE '2000-06-30' + 92 THEN 'Y' WHEN req > DATE '2000-06-30' + 92 THEN 'N'
    WHEN sch <= DATE '2000-06-30' + 92 THEN 'Y' ELSE 'N' END AS is_booking FROM b""",
)
def backlog_delinquency(t: Tables) -> DataFrame:
    ordered = F.col("o_orderdate").cast("date")
    price = dec(F.col("l_extendedprice"))
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).where(F.col("o_orderstatus") != "F")
    lines = rows.select(
        "o_orderstatus", txn_id().alias("line_id"),
        F.when(F.col("l_returnflag") == "R", backlog.ACCRUAL).alias("activity"),
        price.alias("amount"), (price * dec(F.col("l_discount"))).alias("accrual"), F.when(F.col("l_tax") == 0, F.lit(0)).otherwise(dec(F.col("l_quantity"))).alias("quantity"),
        F.when(F.col("l_linenumber") < 3, F.date_add(ordered, 60)).when(F.col("l_linenumber") == 3, F.lit("0001-01-01").cast("date")).alias("requested"), F.col("l_shipdate").cast("date").alias("scheduled"),
        F.when(F.col("l_linestatus") == "O", F.date_add(ordered, 90)).alias("promised"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "OMD").when(F.col("o_orderpriority") == "2-HIGH", "INT-SPS").otherwise("DIST").alias("business_class"),
    )
    forecast = lines.where(F.col("o_orderstatus") == "P").drop("o_orderstatus")
    firm = lines.where(F.col("o_orderstatus") != "P").drop("o_orderstatus")
    return backlog.backlog_fact(forecast, firm, "2000-06-30")


# --- attribution -------------------------------------------------------------------------

CUSTOMERS_SQL = f"""{SEGMENT_REF_SQL},
cust AS (SELECT c_custkey AS customer, 'C' || c_nationkey AS corp, CASE WHEN c_acctbal >= 2000 THEN 'E' || c_nationkey END AS end_corp, class
  FROM customer JOIN segment_ref ON c_mktsegment = segment)"""


def customers(t: Tables) -> DataFrame:
    nation = F.col("c_nationkey").cast("string")
    return t.customer.join(segment_ref(t), F.col("c_mktsegment") == F.col("segment")).select(
        F.col("c_custkey").alias("customer"),
        F.concat(F.lit("C"), nation).alias("corp"),
        F.when(F.col("c_acctbal") >= 2000, F.concat(F.lit("E"), nation)).alias("end_corp"),
        "class",
    )


def order_lines(t: Tables) -> DataFrame:
    return t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).withColumn(
        "ship_day", F.col("l_shipdate").cast("date")
    )


LINES_SQL = "ol AS (SELECT *, CAST(l_shipdate AS DATE) AS ship_day FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
OWN_SQL = """(class = 'EMSI' OR (class = 'OEM' AND oem) OR (class IN ('DIST', 'CIPO') AND custom))"""


@query(
    "customer_bridge",
    f"""WITH {CUSTOMERS_SQL}, {LINES_SQL},
interest AS (SELECT l_partkey AS product, CASE WHEN l_returnflag = 'R' THEN o_custkey END AS customer, CASE WHEN l_returnflag <> 'R' THEN corp END AS corp,
  CASE WHEN l_linenumber = 7 THEN 'COIW' ELSE 'C' || l_linenumber END AS interest, ship_day AS f, ship_day + 400 AS u
  FROM ol JOIN cust ON o_custkey = cust.customer WHERE l_quantity = 50),
adj AS (SELECT l_partkey AS product, o_custkey AS direct, CASE WHEN l_returnflag <> 'N' THEN l_suppkey END AS indirect,
  coalesce(end_corp, corp) AS end_corp, 'ADJ' || l_linenumber AS adjusted, ship_day AS f, ship_day + 400 AS u
  FROM ol JOIN cust ON l_suppkey = cust.customer WHERE l_quantity = 49),
refc AS (SELECT l_partkey AS product, o_custkey AS direct, CASE WHEN l_returnflag <> 'N' THEN l_suppkey END AS indirect,
  coalesce(end_corp, corp) AS end_corp, 'REF' || l_linenumber AS reference, ship_day - 200 AS f,
  CASE WHEN l_linestatus = 'O' THEN DATE '9999-12-31' ELSE ship_day END AS u FROM ol JOIN cust ON l_suppkey = cust.customer WHERE l_quantity = 48),
x AS (SELECT {TXN_SQL} AS txn_id, l_partkey AS product, o_custkey AS direct, l_suppkey AS indirect, ship_day AS process_date,
  d.corp AS direct_corp, d.class, i.corp AS ind_corp, i.end_corp AS ind_end_corp,
  coalesce(d.corp IN (SELECT 'C' || n_nationkey FROM nation WHERE n_regionkey = 1), false) AS oem, l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO') AS custom
  FROM ol LEFT JOIN cust d ON o_custkey = d.customer LEFT JOIN cust i ON l_suppkey = i.customer),
y AS (SELECT *,
  (SELECT min(interest) FROM interest r WHERE r.product = x.product AND r.customer = x.direct AND x.process_date BETWEEN f AND u AND interest <> 'COIW') AS c1,
  (SELECT min(interest) FROM interest r WHERE r.product = x.product AND r.customer IS NULL AND r.corp = x.direct_corp AND x.process_date BETWEEN f AND u AND interest <> 'COIW') AS c2,
  (SELECT min(adjusted) FROM adj r WHERE r.product = x.product AND r.direct = x.direct AND r.indirect = x.indirect AND r.end_corp = x.ind_end_corp AND x.process_date BETWEEN f AND u) AS a1,
  (SELECT min(adjusted) FROM adj r WHERE r.product = x.product AND r.indirect IS NULL AND x.process_date BETWEEN f AND u) AS a2,
  (SELECT min(adjusted) FROM adj r WHERE r.product = x.product AND r.direct = x.direct AND r.indirect = x.indirect AND x.ind_end_corp IS NULL AND r.end_corp = x.ind_corp AND x.process_date BETWEEN f AND u) AS a3,
  (SELECT min(reference) FROM refc r WHERE r.product = x.product AND r.direct = x.direct AND r.indirect = x.indirect AND r.end_corp = x.ind_end_corp AND x.process_date BETWEEN f AND u) AS r1,
  (SELECT min(reference) FROM refc r WHERE r.product = x.product AND r.indirect IS NULL AND x.process_date BETWEEN f AND u) AS r2,
  (SELECT min(reference) FROM refc r WHERE r.product = x.product AND r.direct = x.direct AND r.indirect = x.indirect AND x.ind_end_corp IS NULL AND r.end_corp = x.ind_corp AND x.process_date BETWEEN f AND u) AS r3
  FROM x),
z AS (SELECT *, coalesce(ind_end_corp, ind_corp) AS indirect_corp,
  CASE WHEN {OWN_SQL} THEN coalesce(c1, c2, direct_corp) ELSE coalesce(ind_end_corp, ind_corp) END AS end_corp,
  CASE WHEN {OWN_SQL} THEN CASE WHEN c1 IS NOT NULL THEN 'COICustomer' WHEN c2 IS NOT NULL THEN 'COICorporation'
    WHEN direct_corp IS NOT NULL THEN 'NoCOI-Using DIRCoproration' ELSE 'Not Defined' END ELSE 'SUBCorp' END AS end_corp_definition FROM y),
w AS (SELECT *, coalesce(a1, a2, a3, end_corp) AS adjusted_end_corp, coalesce(r1, r2, r3, end_corp) AS reference_corp FROM z)
SELECT txn_id, process_date, direct_corp, indirect_corp, end_corp, adjusted_end_corp, reference_corp, end_corp_definition, md5(direct_corp) AS direct_corp_key,
  md5(indirect_corp) AS indirect_corp_key, md5(end_corp) AS end_corp_key, md5(adjusted_end_corp) AS adjusted_end_corp_key, md5(reference_corp) AS reference_corp_key FROM w""",
)
def customer_bridge(t: Tables) -> DataFrame:
    lines, cust = order_lines(t), customers(t)
    facts = lines.select(
        txn_id().alias("txn_id"), F.col("l_partkey").alias("product"), F.col("o_custkey").alias("direct"),
        F.col("l_suppkey").alias("indirect"), F.col("ship_day").alias("process_date"),
    )
    flag, no = F.col("l_returnflag"), F.col("l_linenumber")
    span = [F.col("ship_day").alias("from_date"), F.date_add("ship_day", 400).alias("to_date")]
    interest = (
        lines.where(F.col("l_quantity") == 50)
        .join(cust, F.col("o_custkey") == F.col("customer"))
        .select(
            F.col("l_partkey").alias("product"),
            F.when(flag == "R", F.col("o_custkey")).alias("customer"),
            F.when(flag != "R", F.col("corp")).alias("corp"),
            F.when(no == 7, attribution.NO_INTEREST).otherwise(F.concat(F.lit("C"), no.cast("string"))).alias("interest"),
            *span,
        )
    )
    adjusted = (
        lines.where(F.col("l_quantity") == 49)
        .join(cust, F.col("l_suppkey") == F.col("customer"))
        .select(
            F.col("l_partkey").alias("product"), F.col("o_custkey").alias("direct"),
            F.when(flag != "N", F.col("l_suppkey")).alias("indirect"),
            F.coalesce("end_corp", "corp").alias("end_corp"),
            F.concat(F.lit("ADJ"), no.cast("string")).alias("adjusted"),
            *span,
        )
    )
    reference = (
        lines.where(F.col("l_quantity") == 48)
        .join(cust, F.col("l_suppkey") == F.col("customer"))
        .select(
            F.col("l_partkey").alias("product"), F.col("o_custkey").alias("direct"),
            F.when(flag != "N", F.col("l_suppkey")).alias("indirect"),
            F.coalesce("end_corp", "corp").alias("end_corp"),
            F.concat(F.lit("REF"), no.cast("string")).alias("reference"),
            F.date_sub("ship_day", 200).alias("from_date"),
            F.when(F.col("l_linestatus") == "O", day("9999-12-31")).otherwise(F.col("ship_day")).alias("to_date"),
        )
    )
    corps = t.nation.where(F.col("n_regionkey") == 1).select(F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("corp"))
    custom = t.part.where(F.col("p_type") == "PROMO").select(F.col("p_partkey").alias("product"))
    return attribution.customer_bridge(facts, cust, interest, adjusted, corps, custom, reference)


# --- point of sale -------------------------------------------------------------------------


@query(
    "pos_fact",
    f"""WITH {CUSTOMERS_SQL}, {LINES_SQL},
addr AS (SELECT l_suppkey || ':' || o_custkey AS address, min(l_partkey) AS customer FROM ol WHERE l_returnflag = 'A' GROUP BY 1),
pos AS (SELECT {TXN_SQL} AS txn_id, l_partkey AS product, o_custkey AS direct, l_suppkey AS ship_id, 'D' || l_suppkey AS ship_name, l_linenumber AS end_id,
  CASE WHEN l_linenumber = 1 THEN 'D' || l_suppkey ELSE 'E' || l_linenumber END AS end_name, ship_day, CAST(l_quantity AS DECIMAL(18,2)) AS q,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS resale, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS cost, l_tax > 0.06 AS is_var,
  p_type AS division FROM ol JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'N'),
r AS (SELECT pos.*, a.customer AS indirect, d.corp AS direct_corp, d.class AS direct_class, s.corp AS ship_corp, s.end_corp AS ship_end, s.class AS ship_class, e.corp AS own_end
  FROM pos LEFT JOIN addr a ON ship_id || ':' || direct = a.address LEFT JOIN addr b ON end_id || ':' || direct = b.address
  LEFT JOIN cust d ON direct = d.customer LEFT JOIN cust s ON a.customer = s.customer LEFT JOIN cust e ON b.customer = e.customer),
r2 AS (SELECT *, CASE WHEN ship_name = end_name THEN coalesce(ship_end, ship_corp, direct_corp) ELSE coalesce(own_end, ship_end, ship_corp, direct_corp) END AS end_corp,
  CASE WHEN ship_name = end_name AND ship_end IS NOT NULL THEN 'INDEndCorp-ShipEndMatch' WHEN ship_name = end_name THEN 'INDCorp-NoINDEnd-ShipEndMatch'
    WHEN own_end IS NULL AND ship_end IS NOT NULL THEN 'INDEndCorp-NoPOSEnd' WHEN own_end IS NOT NULL THEN 'POSEndDefined' ELSE 'INDCorp-NoINDEnd' END AS end_corp_rule FROM r),
xref AS (SELECT l_partkey AS product, CASE WHEN l_returnflag = 'R' THEN o_custkey END AS direct, CASE WHEN l_returnflag = 'A' THEN end_corp END AS end_corp,
  'I' || l_suppkey AS ipn, l_linestatus = 'O' AS is_default, ship_day - 400 AS f, ship_day + 400 AS u FROM ol JOIN cust ON o_custkey = cust.customer WHERE l_quantity = 50),
matrix AS (SELECT DISTINCT 'C' || c_nationkey AS corp, DATE '1996-01-01' AS f, DATE '2000-12-31' AS u, c_mktsegment = 'BUILDING' AS bills, c_mktsegment IN ('FURNITURE', 'BUILDING') AS reports FROM customer WHERE c_acctbal > 9500),
r3 AS (SELECT *,
  (SELECT min(ipn) FROM xref x WHERE x.product = r2.product AND x.direct = r2.direct AND x.end_corp IS NULL AND r2.ship_day BETWEEN f AND u) AS i1,
  (SELECT min(ipn) FROM xref x WHERE x.product = r2.product AND x.end_corp = r2.end_corp AND x.direct IS NULL AND r2.ship_day BETWEEN f AND u) AS i2,
  (SELECT min(ipn) FROM xref x WHERE x.product = r2.product AND x.end_corp IS NULL AND x.direct IS NULL AND is_default AND r2.ship_day BETWEEN f AND u) AS i3,
  (SELECT min(reports) FROM matrix m WHERE m.corp = r2.direct_corp AND r2.ship_day BETWEEN f AND u) AS reports
  FROM r2 WHERE ship_class IS NULL OR ship_class NOT IN ('DIST', 'CIPO', 'D3PL')),
bill AS (SELECT {TXN_SQL} AS txn_id, l_partkey AS product, o_custkey AS direct, corp AS direct_corp, ship_day, CAST(l_quantity AS DECIMAL(18,2)) AS q, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
  FROM ol JOIN cust ON o_custkey = cust.customer WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND class = 'CIPO'),
ok AS (SELECT * FROM bill WHERE direct_corp NOT IN (SELECT corp FROM matrix) OR EXISTS (SELECT 1 FROM matrix m WHERE m.corp = direct_corp AND ship_day BETWEEN f AND u AND bills)),
u AS (SELECT txn_id, product, coalesce(i1, i2, i3, CAST(product AS VARCHAR)) AS internal_part, direct, indirect, direct_corp, end_corp, end_corp_rule, ship_day, CAST(q AS DOUBLE) AS quantity,
    CAST(resale * q AS DOUBLE) AS resale_amount, CAST(cost * q AS DOUBLE) AS cost_amount, 'POS' AS source_of_data, NOT is_var AS is_true_pos,
    CASE WHEN direct_class IN ('OEM', 'EMSI') THEN false WHEN direct_class = 'CIPO' AND NOT reports THEN false ELSE NOT is_var END AS counts_as_pos, is_var FROM r3
  UNION ALL SELECT txn_id, product, CAST(product AS VARCHAR), direct, NULL, direct_corp, NULL, NULL, ship_day, CAST(q AS DOUBLE), CAST(amount AS DOUBLE), CAST(amount AS DOUBLE), 'BILLING', true, true, false FROM ok)
SELECT *, md5(CAST(direct AS VARCHAR)) AS direct_customer_key, md5(coalesce(end_corp, '-1')) AS end_corp_key FROM u""",
)
def pos_fact(t: Tables) -> DataFrame:
    lines, cust = order_lines(t), customers(t)
    flag, price = F.col("l_returnflag"), dec(F.col("l_extendedprice"))
    supp, no = F.col("l_suppkey").cast("string"), F.col("l_linenumber").cast("string")
    sold = lines.where(flag == "N").join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    rows = sold.select(
        txn_id().alias("txn_id"), F.col("l_partkey").cast("string").alias("product"), F.col("o_custkey").alias("direct"),
        F.col("l_suppkey").alias("ship_id"), F.concat(F.lit("D"), supp).alias("ship_name"), F.col("l_linenumber").alias("end_id"),
        F.when(F.col("l_linenumber") == 1, F.concat(F.lit("D"), supp)).otherwise(F.concat(F.lit("E"), no)).alias("end_name"),
        "ship_day", dec(F.col("l_quantity")).alias("quantity"), price.alias("resale"),
        dec(price * (1 - dec(F.col("l_discount")))).alias("cost"),
        (F.col("l_tax") > 0.06).alias("is_var"), F.col("p_type").alias("division"),
    )
    addresses = lines.where(flag == "A").groupBy(
        F.concat(supp, F.lit(":"), F.col("o_custkey").cast("string")).alias("address")
    ).agg(F.min("l_partkey").alias("customer"))
    named = lines.join(cust, F.col("o_custkey") == F.col("customer"))
    xref = named.where(F.col("l_quantity") == 50).select(
        F.col("l_partkey").cast("string").alias("product"), F.when(flag == "R", F.col("o_custkey")).alias("direct"),
        F.when(flag == "A", F.col("end_corp")).alias("end_corp"), F.concat(F.lit("I"), supp).alias("ipn"),
        (F.col("l_linestatus") == "O").alias("is_default"),
        F.date_sub("ship_day", 400).alias("from_date"), F.date_add("ship_day", 400).alias("to_date"),
    )
    matrix = t.customer.where(F.col("c_acctbal") > 9500).select(
        F.concat(F.lit("C"), F.col("c_nationkey").cast("string")).alias("direct_corp"), day("1996-01-01").alias("from_date"),
        day("2000-12-31").alias("to_date"), (F.col("c_mktsegment") == "BUILDING").alias("bills"),
        F.col("c_mktsegment").isin("FURNITURE", "BUILDING").alias("reports_pos"),
    ).distinct()
    billed = named.where((flag == "R") & (F.col("l_linestatus") == "F") & (F.col("class") == "CIPO")).select(
        txn_id().alias("txn_id"), F.col("l_partkey").cast("string").alias("product"), F.col("o_custkey").alias("direct"),
        F.col("corp").alias("direct_corp"), "ship_day", dec(F.col("l_quantity")).alias("quantity"), price.alias("amount"),
    )
    out = pos.pos_fact(rows, billed, addresses, cust, xref, matrix)
    number = [F.col(c).cast("double").alias(c) for c in ("quantity", "resale_amount", "cost_amount")]
    return out.select(
        "txn_id", F.col("product").cast("bigint").alias("product"), "internal_part", "direct", "indirect", "direct_corp", "end_corp",
        "end_corp_rule", "ship_day", *number, "source_of_data", "is_true_pos", "counts_as_pos", "is_var",
        "direct_customer_key", "end_corp_key",
    )


# --- consumption -----------------------------------------------------------------------------

CONSUMPTION_SQL = f"""{CUSTOMERS_SQL}, {LINES_SQL}, {fiscal_sql("lineitem", "l_shipdate")},
f AS (SELECT o_custkey AS customer, l_partkey AS product, 'BILLING' AS source_of_data, ship_day, CAST(l_extendedprice AS DECIMAL(18,4)) AS amount,
    CAST(l_extendedprice AS DECIMAL(18,4)) AS cost_adjusted, CAST(l_quantity AS DECIMAL(18,4)) AS quantity FROM ol JOIN cust c ON o_custkey = c.customer
    WHERE l_returnflag <> 'N' AND class NOT IN ('DIST', 'D3PL', 'CIPO')
  UNION ALL SELECT l_suppkey, l_partkey, 'POS', ship_day, cost, CAST(cost * CAST(0.97 AS DECIMAL(3,2)) AS DECIMAL(18,4)), q
    FROM (SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS cost, CAST(l_quantity AS DECIMAL(18,4)) AS q FROM ol WHERE l_returnflag = 'N')),
wk AS (SELECT customer, product, source_of_data, fiscal_week, sum(amount) AS amount, sum(cost_adjusted) AS cost_adjusted, sum(quantity) AS quantity
  FROM f LEFT JOIN cal ON calendar_date = ship_day WHERE ship_day >= DATE '1996-01-01' GROUP BY 1, 2, 3, 4)"""
DOUBLES_SQL = "CAST({s}amount{e} AS DOUBLE) AS amount, CAST({s}cost_adjusted{e} AS DOUBLE) AS cost_adjusted, CAST({s}quantity{e} AS DOUBLE) AS quantity"


def consumption_weeks(t: Tables) -> DataFrame:
    lines = order_lines(t)
    own = lines.where(F.col("l_returnflag") != "N").join(customers(t), F.col("o_custkey") == F.col("customer")).select(
        "customer", F.col("l_partkey").alias("product"), "class", F.col("ship_day").alias("day"),
        dec(F.col("l_extendedprice")).alias("amount"), dec(F.col("l_quantity")).alias("quantity"),
    )
    sold = lines.where(F.col("l_returnflag") == "N").select(
        F.col("l_suppkey").alias("customer"), F.col("l_partkey").alias("product"), F.col("ship_day").alias("day"),
        dec(F.col("l_extendedprice")).alias("cost"), dec(F.col("l_quantity")).alias("quantity"),
    )
    return consumption.weekly(own, sold, fiscal_cal(t.lineitem, "l_shipdate"), "2001-08-01")


@query(
    "consumption_weekly",
    f"""WITH {CONSUMPTION_SQL} SELECT customer, product, source_of_data, fiscal_week, {DOUBLES_SQL.format(s="", e="")} FROM wk""",
)
def consumption_weekly(t: Tables) -> DataFrame:
    return consumption_weeks(t)


@query(
    "consumption_quarterly",
    f"""WITH {CONSUMPTION_SQL}, wq AS (SELECT DISTINCT fiscal_week, fiscal_quarter FROM cal)
SELECT customer, product, source_of_data, fiscal_quarter, {DOUBLES_SQL.format(s="sum(", e=")")} FROM wk JOIN wq USING (fiscal_week) GROUP BY 1, 2, 3, 4""",
)
def consumption_quarterly(t: Tables) -> DataFrame:
    return consumption.quarterly(consumption_weeks(t), fiscal_cal(t.lineitem, "l_shipdate"))


# --- funnel ------------------------------------------------------------------------------------

ITEM_SQL = """SELECT l_partkey AS item, max(l_suppkey) AS registrar, sum(CAST(l_quantity AS DECIMAL(18,2))) AS boards, max(l_linenumber) AS per_board,
  max(CAST(l_extendedprice AS DECIMAL(18,2))) AS price, CASE WHEN min(l_tax) > 0 THEN 1 + min(CAST(l_tax AS DECIMAL(18,2))) END AS rate,
  CAST(max(CAST(l_discount AS DECIMAL(18,2)) * 100) AS INT) || '%' AS share FROM lineitem WHERE {where} GROUP BY 1"""
# Exact integers: price in millionths, boards and percent in hundredths, rounded to the cent.
REVENUE_SQL = """SELECT item, registrar, CAST(round(price * 100) AS HUGEINT) * 10000000000 // CAST(round(coalesce(rate, 1) * 1000000) AS HUGEINT) AS p6,
  CAST(round(boards * 100) AS HUGEINT) AS b2, CAST(per_board AS HUGEINT) AS per_board, CAST(replace(share, '%', '') AS HUGEINT) * 100 AS pct2 FROM ({item})"""
FULL_SQL = """SELECT item, registrar, CAST(p6 AS DOUBLE) / 1000000 AS unit_price,
  CAST((b2 * per_board * p6 * pct2 + 5000000000) // 10000000000 AS DOUBLE) / 100 AS revenue FROM ({rev})"""


def _funnel_sql(where: str) -> str:
    return FULL_SQL.format(rev=REVENUE_SQL.format(item=ITEM_SQL.format(where=where)))


def funnel_items(df: DataFrame) -> DataFrame:
    items = df.groupBy(F.col("l_partkey").alias("item")).agg(
        F.max("l_suppkey").alias("registrar"),
        F.sum(dec(F.col("l_quantity"))).alias("boards"),
        F.max("l_linenumber").alias("per_board"),
        F.max(dec(F.col("l_extendedprice"))).alias("price"),
        F.min(dec(F.col("l_tax"))).alias("tax"),
        F.max(dec(F.col("l_discount"))).alias("disc"),
    )
    rate = F.when(F.col("tax") > 0, 1 + F.col("tax"))
    share = funnel.percent(F.concat((F.col("disc") * 100).cast("int").cast("string"), F.lit("%")))
    price = funnel.unit_price(F.col("price"), rate)
    return items.select(
        "item", "registrar", price.cast("double").alias("unit_price"),
        funnel.revenue(F.col("boards"), F.col("per_board"), price, share).cast("double").alias("revenue"),
    )


@query(
    "funnel_snapshot",
    f"""WITH stored AS ({_funnel_sql("l_shipdate < TIMESTAMP '2001-06-01'")}), delta AS ({_funnel_sql("l_shipdate >= TIMESTAMP '2001-06-01'")}),
snap AS (SELECT d.item, d.registrar, d.unit_price, d.revenue, coalesce(s.revenue, d.revenue) AS created_revenue FROM delta d LEFT JOIN stored s ON s.item = d.item
  UNION ALL SELECT item, registrar, unit_price, revenue, revenue FROM stored WHERE item NOT IN (SELECT item FROM delta)),
roles AS (SELECT user_id, max(CASE WHEN event_type = 'click' THEN event_id END) AS sales_rep, max(CASE WHEN event_type = 'view' THEN event_id END) AS engineer FROM events GROUP BY 1)
SELECT md5('{{"COL1":' || item || ',"COL2":20010601,"COL3":DESIGN}}') AS funnel_key, item, 20010601 AS snapshot_date_key, unit_price, revenue, created_revenue, sales_rep, engineer
FROM snap LEFT JOIN roles ON registrar = user_id""",
)
def funnel_snapshot(t: Tables) -> DataFrame:
    """Design items by part: changed ones with the created revenue frozen, others carried over."""
    li, cut = t.lineitem, instant("2001-06-01")
    with_created = lambda df: df.withColumn("created_revenue", F.col("revenue"))
    stored = with_created(funnel_items(li.where(F.col("l_shipdate") < cut))).withColumn("snapshot_date_key", F.lit(20010531))
    delta = with_created(funnel_items(li.where(F.col("l_shipdate") >= cut)))
    snap = funnel.daily_snapshot(delta, stored, "item", "snapshot_date_key", F.lit(20010601), ["created_revenue"], "DESIGN")
    mapping = t.events.select(F.col("user_id").alias("registrar"), F.col("event_type").alias("classification"), F.col("event_id").alias("user_id"))
    role = funnel.roles(mapping, "registrar", {"sales_rep": "click", "engineer": "view"})
    return snap.join(role, "registrar", "left").select(
        "funnel_key", "item", "snapshot_date_key", "unit_price", "revenue", "created_revenue", "sales_rep", "engineer"
    )


# --- products ------------------------------------------------------------------------------------

SAMPLE_LIMITS = {
    "super_quantity": 90, "super_corps": 4, "high_quantity": 70, "high_corps": 3, "mid_quantity": 50, "mid_corps": 2,
    "many_corps": 4, "few_corps": 1,
}


@query(
    "product_classes",
    """WITH f AS (SELECT l_partkey AS product, CASE WHEN l_returnflag = 'N' THEN 'POS' ELSE 'BILLING' END AS src, CAST(l_quantity AS DECIMAL(18,2)) AS q,
  s_nationkey AS corp, n_regionkey AS region FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE l_shipdate >= TIMESTAMP '2001-02-01'),
s AS (SELECT product, sum(q) AS tq, sum(CASE WHEN src = 'POS' THEN q END) AS pq, sum(CASE WHEN src = 'BILLING' THEN q END) AS bq, count(DISTINCT corp) AS nc,
  count(DISTINCT CASE WHEN src = 'POS' THEN corp END) AS np, count(DISTINCT region) AS nr FROM f GROUP BY 1),
c AS (SELECT l_partkey AS product, count(DISTINCT CASE WHEN l_returnflag = 'A' THEN l_suppkey END) AS sim, count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_suppkey END) AS dir
  FROM lineitem WHERE l_quantity = 50 AND l_returnflag <> 'N' GROUP BY 1)
SELECT p_partkey AS product, 200131 AS fiscal_week, CAST(tq AS DOUBLE) AS total_quantity, CAST(pq AS DOUBLE) AS pos_quantity, CAST(bq AS DOUBLE) AS billing_quantity,
  nc AS end_corp_count, np AS pos_end_corp_count, nr AS region_count, coalesce(sim, 0) AS similar_count, coalesce(dir, 0) AS direct_count,
  CASE WHEN p_brand IN ('Brand#1', 'Brand#2') THEN 'Non Product' WHEN p_size = 1 THEN 'Custom' WHEN tq > 90 AND nc > 4 THEN 'Super Commodity' WHEN tq > 70 AND nc > 3 THEN 'Commodity 1'
    WHEN tq > 50 AND nc > 2 AND coalesce(dir, 0) >= 1 THEN 'Commodity 2' WHEN nc >= 4 THEN 'Firm - High Cust' WHEN nc <= 1 THEN 'Firm - Low Cust' WHEN tq = 0 OR tq IS NULL THEN 'No 6Mo Revenue' ELSE 'Firm' END AS classification
FROM part LEFT JOIN s ON p_partkey = s.product LEFT JOIN c ON p_partkey = c.product""",
)
def product_classes(t: Tables) -> DataFrame:
    li, flag = t.lineitem, F.col("l_returnflag")
    facts = (
        li.where(F.col("l_shipdate") >= instant("2001-02-01"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("l_partkey").alias("product"), F.when(flag == "N", "POS").otherwise("BILLING").alias("source"),
            F.col("l_quantity").alias("quantity"), F.col("s_nationkey").alias("end_corp"), F.col("n_regionkey").alias("region"),
        )
    )
    rivals = li.where((F.col("l_quantity") == 50) & (flag != "N")).select(
        F.col("l_partkey").alias("product"), F.when(flag == "A", "Similar").otherwise("Direct").alias("kind"), F.col("l_suppkey").alias("competitor")
    )
    products = t.part.select(
        F.col("p_partkey").alias("product"),
        F.when(F.col("p_brand").isin("Brand#1", "Brand#2"), "NP").otherwise("FG").alias("class_code"),
        (F.col("p_size") == 1).alias("is_custom"),
    )
    return product.classes(facts, products, rivals, 200131, SAMPLE_LIMITS)


KINDS = {"datasheet": "R", "app_note": "A"}


@query(
    "product_master",
    """WITH p AS (SELECT p_partkey AS part_id, p_name AS part_name, p_brand AS brand FROM part),
m AS (SELECT l_partkey AS part_id, max(l_suppkey) AS owner FROM lineitem WHERE l_quantity >= 48 GROUP BY 1),
d AS (SELECT l_partkey AS part_id, max(CASE WHEN l_returnflag = 'R' THEN 'doc-' || l_suppkey END) AS datasheet, max(CASE WHEN l_returnflag = 'A' THEN 'doc-' || l_suppkey END) AS app_note
  FROM lineitem WHERE l_quantity = 50 GROUP BY 1)
SELECT coalesce(p.part_id, m.part_id) AS part_id, part_name, brand, owner, datasheet, app_note,
  CASE WHEN coalesce(datasheet, app_note) IS NOT NULL AND part_name NOT LIKE '%anvil%' THEN 'Y' ELSE 'N' END AS is_web_visible
FROM p FULL JOIN m ON p.part_id = m.part_id LEFT JOIN d ON d.part_id = coalesce(p.part_id, m.part_id)""",
)
def product_master(t: Tables) -> DataFrame:
    li = t.lineitem
    p = t.part.select(F.col("p_partkey").alias("part_id"), F.col("p_name").alias("part_name"), F.col("p_brand").alias("brand"))
    m = li.where(F.col("l_quantity") >= 48).groupBy(F.col("l_partkey").alias("part_id")).agg(F.max("l_suppkey").alias("owner"))
    docs = li.where(F.col("l_quantity") == 50).select(
        F.col("l_partkey").alias("part_id"), F.col("l_returnflag").alias("kind"), F.concat(F.lit("doc-"), F.col("l_suppkey").cast("string")).alias("title")
    )
    return product.product_master(p, m, docs, KINDS, F.col("part_name").like("%anvil%"))


@query(
    "part_precedence",
    """WITH e AS (SELECT p_partkey AS part_id, 'ENGINEERING' AS source, p_size > 45 AS is_active FROM part WHERE p_size > 30),
l AS (SELECT l_partkey AS part_id, 'LEGACY' AS source, max(l_returnflag) = 'R' AS is_active FROM lineitem WHERE l_quantity = 49 GROUP BY 1),
p AS (SELECT p_partkey AS part_id, 'PLANNING' AS source, p_type = 'PROMO' AS is_active FROM part)
SELECT * FROM e UNION ALL SELECT * FROM l WHERE part_id NOT IN (SELECT part_id FROM e)
UNION ALL SELECT * FROM p WHERE part_id NOT IN (SELECT part_id FROM e) AND part_id NOT IN (SELECT part_id FROM l)""",
)
def part_precedence(t: Tables) -> DataFrame:
    """Part master of three systems; flags arrive as text."""
    yes = lambda c: parse_flag(F.when(c, "Y").otherwise("N")).alias("is_active")
    e = t.part.where(F.col("p_size") > 30).select(F.col("p_partkey").alias("part_id"), F.lit("ENGINEERING").alias("source"), yes(F.col("p_size") > 45))
    legacy = t.lineitem.where(F.col("l_quantity") == 49).groupBy(F.col("l_partkey").alias("part_id")).agg(F.max("l_returnflag").alias("f"))
    legacy = legacy.select("part_id", F.lit("LEGACY").alias("source"), yes(F.col("f") == "R"))
    planning = t.part.select(F.col("p_partkey").alias("part_id"), F.lit("PLANNING").alias("source"), yes(F.col("p_type") == "PROMO"))
    return parts.part_precedence(e, legacy, planning, "part_id")


@query(
    "customer_dim",
    f"""WITH {SEGMENT_REF_SQL}
SELECT md5(CAST(c_custkey AS VARCHAR)) AS customer_key, c_custkey, c_name, coalesce(class, 'UNK') AS business_class, n_name AS corporation,
  md5(coalesce(n_name, '-1')) AS corporation_key, r_name AS territory, md5(r_name || '--' || coalesce(class, 'UNK')) AS territory_key,
  r_name || '/' || n_name || '/' || c_name AS hierarchy, CASE WHEN c_acctbal < 0 THEN 'Inactive' ELSE 'Active' END AS status
FROM customer LEFT JOIN segment_ref ON c_mktsegment = segment LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def customer_dim(t: Tables) -> DataFrame:
    """Customer with class, corporation, territory and a flattened hierarchy."""
    df = joins.enrich(
        t.customer,
        [
            (segment_ref(t), {"c_mktsegment": "segment"}, {"class": "class"}),
            (t.nation, {"c_nationkey": "n_nationkey"}, {"corporation": "n_name", "_region": "n_regionkey"}),
            (t.region, {"_region": "r_regionkey"}, {"territory": "r_name"}),
        ],
    )
    cls = F.coalesce("class", F.lit("UNK"))
    return df.select(
        member_key(F.col("c_custkey")).alias("customer_key"), "c_custkey", "c_name", cls.alias("business_class"), "corporation",
        member_key(F.col("corporation")).alias("corporation_key"), "territory",
        F.md5(F.concat("territory", F.lit("--"), cls)).alias("territory_key"),
        F.concat("territory", F.lit("/"), "corporation", F.lit("/"), "c_name").alias("hierarchy"),
        F.when(F.col("c_acctbal") < 0, "Inactive").otherwise("Active").alias("status"),
    )


@query(
    "sample_fact",
    """WITH ln AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM lineitem) WHERE rn = 1),
sh AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1)
SELECT md5('{' || concat_ws(',', '"COL1":' || l_orderkey, '"COL2":' || l_linenumber, '"COL3":' || event_id) || '}') AS sample_key,
  l_orderkey, l_linenumber, l_quantity AS quantity, event_id AS shipment, event_type AS shipment_type, o_orderstatus AS order_status
FROM ln JOIN orders ON l_orderkey = o_orderkey LEFT JOIN sh ON l_suppkey = user_id""",
)
def sample_fact(t: Tables) -> DataFrame:
    """Sample orders: newest lines and shipments under a hashed key."""
    ln = latest(t.lineitem, ["l_orderkey", "l_linenumber"], [F.col(c).desc() for c in ("l_shipdate", "l_partkey", "l_suppkey")])
    sh = latest(t.events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    df = ln.join(t.orders.select("o_orderkey", "o_orderstatus"), F.col("l_orderkey") == F.col("o_orderkey")).join(
        sh.select("user_id", "event_id", "event_type"), F.col("l_suppkey") == F.col("user_id"), "left"
    )
    key = {"COL1": F.col("l_orderkey"), "COL2": F.col("l_linenumber"), "COL3": F.col("event_id")}
    return df.select(
        object_key(key).alias("sample_key"), "l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantity"),
        F.col("event_id").alias("shipment"), F.col("event_type").alias("shipment_type"), F.col("o_orderstatus").alias("order_status"),
    )

"""Project reporting on customers, orders and lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import day
from tidemark.functions.numbers import dec
from tidemark.operators import joins
from tidemark.operators.dedup import latest
from tidemark.plans import projects
from tidemark.queries.inputs import fiscal_cal, fiscal_sql, on_day
from tidemark.queries.registry import Tables, query

DIVISIONS = [
    ("AUTOMOBILE", "Power Solutions", "PSG"),
    ("BUILDING", "Advanced Solutions", "ASG"),
    ("MACHINERY", "Advanced Solutions", "ASG"),
]


@query(
    "project_summary",
    f"""WITH {fiscal_sql("orders", "o_orderdate")}, divs(old, new, code) AS (VALUES {", ".join(str(d) for d in DIVISIONS)}),
g AS (SELECT user_id, event_type FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1),
c AS (SELECT o_custkey, o_orderkey FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1),
p AS (SELECT c_custkey, c_name, c_mktsegment, CASE WHEN n_regionkey = 1 THEN 'AB - ' || n_name ELSE n_name END AS unit,
  (SELECT fiscal_week FROM cal WHERE calendar_date = DATE '2001-07-25') AS w FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT md5('{{"COL1":' || w || ',"COL2":' || c_custkey || '}}') AS project_summary_key, w AS snapshot_week_key, c_custkey AS project, c_name AS name, event_type AS "group",
  coalesce(new, c_mktsegment) AS division_name, code AS division_code,
  CASE WHEN regexp_full_match(unit, '[a-zA-Z1-9]{{2}}\\s-.*') THEN left(unit, 2) ELSE left(right(unit, 3), 2) END AS unit_code, o_orderkey AS cost_object
FROM p LEFT JOIN g ON user_id = c_custkey LEFT JOIN divs ON c_mktsegment = old LEFT JOIN c ON o_custkey = c_custkey""",
)
def project_summary(t: Tables) -> DataFrame:
    from tidemark.sources.tables import constant_table

    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("project"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("division"),
        F.when(F.col("n_regionkey") == 1, F.concat(F.lit("AB - "), "n_name")).otherwise(F.col("n_name")).alias("unit"),
    )
    groups = latest(t.events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()]).select(
        F.col("user_id").alias("project"), F.col("event_type").alias("group")
    )
    costs = latest(t.orders, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]).select(
        F.col("o_custkey").alias("project"), F.col("o_orderkey").alias("cost_object")
    )
    week = fiscal_cal(t.orders, "o_orderdate").where(F.col("calendar_date") == day("2001-07-25")).select("fiscal_week").scalar()
    return projects.summary(rows, groups, constant_table(t.spark, DIVISIONS, ["old", "new", "code"]), costs, week)


STEPS = ["STEP1", "STEP2", "STEP3", "STEP4", "STEP5", "TAPEOUT1", "TAPEOUT2"]
PLACES = [3, 1, 2, 5, 4, None, None]
STEP_REF = [
    {
        "step": s, "os": f"lo{i + 1}", "cs": f"hi{i + 1}", "forecast": f"hi{i + 2}" if i < 6 else None,
        "actual": f"lo{i + 1}" if i in (0, 2, 4) else None, "sort_order": PLACES[i],
    }
    for i, s in enumerate(STEPS)
]
PICKS_SQL = {
    k: "CASE step " + " ".join(f"WHEN '{r['step']}' THEN {r[k]}" for r in STEP_REF if r[k]) + " END"
    for k in ("os", "cs", "forecast", "actual")
}


@query(
    "schedule_steps",
    f"""WITH w AS (SELECT l_orderkey AS project, {", ".join(f"CAST(min(CASE WHEN l_linenumber = {i} THEN l_shipdate END) AS DATE) AS lo{i}, CAST(max(CASE WHEN l_linenumber = {i} THEN l_shipdate END) AS DATE) AS hi{i}" for i in range(1, 8))}
  FROM lineitem GROUP BY 1),
s AS (SELECT l_orderkey AS project, CASE WHEN l_linenumber <= 5 THEN 'STEP' || l_linenumber ELSE 'TAPEOUT' || (l_linenumber - 5) END AS step, max(l_linestatus) AS status FROM lineitem GROUP BY 1, 2),
b AS (SELECT s.project, step, status, {", ".join(f"{v} AS {k}_date" for k, v in PICKS_SQL.items())},
  CASE step {" ".join(f"WHEN '{r['step']}' THEN {r['sort_order']}" for r in STEP_REF if r['sort_order'])} END AS place FROM s JOIN w ON s.project = w.project),
p AS (SELECT *, CASE WHEN step LIKE 'TAPEOUT%' THEN (SELECT max(place) FROM b x WHERE x.project = b.project AND x.step NOT LIKE 'TAPEOUT%' AND x.cs_date <= b.cs_date) ELSE place END AS pl FROM b)
SELECT project, step, status, os_date, cs_date, forecast_date, actual_date,
  ROW_NUMBER() OVER (PARTITION BY project ORDER BY pl ASC NULLS LAST, cs_date ASC NULLS LAST, step) AS sort_order FROM p""",
)
def schedule_steps(t: Tables) -> DataFrame:
    """Orders as projects, line numbers as steps, ship dates as step dates."""
    no = F.col("l_linenumber")
    picked = lambda f, i: f(F.when(no == i, F.col("l_shipdate"))).cast("date")
    wide = t.lineitem.groupBy(F.col("l_orderkey").alias("project")).agg(
        *[picked(F.min, i).alias(f"lo{i}") for i in range(1, 8)], *[picked(F.max, i).alias(f"hi{i}") for i in range(1, 8)]
    )
    name = F.when(no <= 5, F.concat(F.lit("STEP"), no.cast("string"))).otherwise(F.concat(F.lit("TAPEOUT"), (no - 5).cast("string")))
    steps = t.lineitem.groupBy(F.col("l_orderkey").alias("project"), name.alias("step")).agg(F.max("l_linestatus").alias("status"))
    return projects.schedule(wide, steps, STEP_REF)


@query(
    "created_vs_resolved",
    f"""WITH {fiscal_sql("lineitem", "l_shipdate")},
i AS (SELECT o_orderkey, o_custkey AS project, CAST(o_orderdate AS DATE) AS c, CASE WHEN o_orderstatus <> 'P' THEN (SELECT CAST(max(l_shipdate) AS DATE) FROM lineitem WHERE l_orderkey = o_orderkey) END AS r FROM orders),
iw AS (SELECT i.*, a.fiscal_week AS cw, b.fiscal_week AS rw FROM i LEFT JOIN cal a ON a.calendar_date = c LEFT JOIN cal b ON b.calendar_date = r),
g AS (SELECT project, min(cw) AS a, max(coalesce(rw, cw)) AS b FROM iw GROUP BY 1),
w AS (SELECT DISTINCT fiscal_week FROM cal),
e AS (SELECT project, fiscal_week FROM g JOIN w ON fiscal_week BETWEEN a AND b)
SELECT e.project, e.fiscal_week AS issue_week_key, count(*) FILTER (cw IS NOT NULL) AS created_issues, count(*) FILTER (rw IS NOT NULL) AS resolved_issues,
  count(*) FILTER (cw IS NOT NULL AND rw IS NULL) AS open_issues
FROM e LEFT JOIN iw ON iw.project = e.project AND (e.fiscal_week = cw OR e.fiscal_week = rw) GROUP BY 1, 2""",
)
def created_vs_resolved(t: Tables) -> DataFrame:
    """Orders as issues of a customer; the last shipment resolves an order that is not pending."""
    shipped = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").cast("date").alias("shipped"))
    calendar = fiscal_cal(t.lineitem, "l_shipdate")
    issues = t.orders.join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_custkey").alias("project"), F.col("o_orderdate").cast("date").alias("created"),
        F.when(F.col("o_orderstatus") != "P", F.col("shipped")).alias("resolved"),
    )
    weeks = calendar.select(F.col("fiscal_week").alias("week")).distinct()
    weeks = weeks.select("week", F.row_number().over(Window.orderBy("week")).alias("week_no"))  # one row per week
    of_day = calendar.join(weeks, F.col("fiscal_week") == F.col("week"))
    issues = on_day(issues, "created", of_day.withColumnsRenamed({"week": "created_week", "week_no": "_cn"}), ["created_week", "_cn"])
    issues = on_day(issues, "resolved", of_day.withColumnsRenamed({"week": "resolved_week", "week_no": "_rn"}), ["resolved_week", "_rn"])
    gates = issues.groupBy("project").agg(F.min("_cn").alias("first_no"), F.max(F.coalesce("_rn", "_cn")).alias("last_no"))
    return projects.created_vs_resolved(gates, weeks, issues)


@query(
    "join_any",
    """SELECT o_orderkey, c_custkey FROM orders JOIN customer ON o_custkey = c_custkey OR o_orderkey = c_custkey""",
)
def join_any(t: Tables) -> DataFrame:
    """A join on either of two keys, as two equi joins."""
    o, c = t.orders.select("o_orderkey", "o_custkey"), t.customer.select("c_custkey")
    conds = [F.col("o_custkey") == F.col("c_custkey"), F.col("o_orderkey") == F.col("c_custkey")]
    return joins.join_any(o, c, conds).select("o_orderkey", "c_custkey")


RISK_SQL = """r AS (SELECT c_nationkey AS project, o_orderkey AS risk, CAST(floor(o_totalprice / 10000) AS BIGINT) AS score, CAST(date_trunc('month', o_orderdate) AS DATE) AS sm
  FROM orders JOIN customer ON o_custkey = c_custkey),
m0 AS (SELECT c_nationkey AS project, l_orderkey AS risk, CAST(date_trunc('month', l_shipdate) AS DATE) AS fm, l_linenumber - 1 AS mit,
  ROW_NUMBER() OVER (PARTITION BY l_orderkey, date_trunc('month', l_shipdate) ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_linenumber DESC) AS rn
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
m AS (SELECT project, risk, fm, mit FROM m0 WHERE rn = 1),
span AS (SELECT project, min(sm) AS a, (SELECT max(fm) FROM m WHERE m.project = r.project) AS b FROM r GROUP BY 1),
grid AS (SELECT r.project, r.risk, r.score, a, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month
  FROM r JOIN span ON r.project = span.project WHERE risk IN (SELECT risk FROM m)),
x AS (SELECT g.*, mit, coalesce(last_value(mit IGNORE NULLS) OVER (PARTITION BY g.risk ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev
  FROM grid g LEFT JOIN m ON m.risk = g.risk AND m.fm = month),
risk AS (SELECT project, month AS process_date, CAST(sum(CASE WHEN mit IS NOT NULL AND month = a THEN score WHEN mit IS NOT NULL THEN mit WHEN prev = 0 THEN score ELSE prev END) AS BIGINT) AS risk_score
FROM x GROUP BY 1, 2)"""


@query("risk_burndown", f"WITH {RISK_SQL} SELECT * FROM risk")
def risk_burndown(t: Tables) -> DataFrame:
    """Nations as projects, orders as risks, lines as mitigations."""
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    risks = o.select(
        F.col("c_nationkey").alias("project"), F.col("o_orderkey").alias("risk"),
        F.floor(F.col("o_totalprice") / 10000).cast("bigint").alias("score"), F.trunc("o_orderdate", "month").alias("start_month"),
    )
    mits = t.lineitem.join(risks.select("project", "risk"), F.col("l_orderkey") == F.col("risk")).select(
        "project", "risk", F.trunc("l_shipdate", "month").alias("finish_month"),
        F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_linenumber").alias("rank"),
        (F.col("l_linenumber") - 1).cast("bigint").alias("score"),
    )
    return projects.risk_burndown(risks, mits)


QUARTERS = [f"{y}-0{q}" for y in range(1995, 2005) for q in (1, 2, 3, 4)]


COST_PERIODS_SQL = ", ".join(
    f"('PERIOD{i + 1}', '{q}', DATE '{q[:4]}-{(int(q[-1]) - 1) * 3 + 1:02d}-01')" for i, q in enumerate(QUARTERS)
)


def cost_sql(key: str, lines: str) -> str:
    return f"""q AS (SELECT {key} AS project, year(l_shipdate) || '-0' || quarter(l_shipdate) AS quarter,
  sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS cost FROM {lines} GROUP BY 1, 2),
p(period, quarter, m1) AS (VALUES {COST_PERIODS_SQL}),
s AS (SELECT DISTINCT {key} AS project FROM {lines}),
cm AS (SELECT s.project, period, cost, CAST(m1 + INTERVAL (k) MONTH AS DATE) AS process_date
  FROM s CROSS JOIN p CROSS JOIN (VALUES (0), (1), (2)) t(k) LEFT JOIN q ON q.project = s.project AND q.quarter = p.quarter),
cost AS (SELECT project, period, process_date,
  round(CAST(sum(cost) OVER (PARTITION BY project ORDER BY process_date) AS DOUBLE) / 3, 2) AS running_cost FROM cm)"""


def costs(lines: DataFrame, key: str) -> DataFrame:
    """Running cost of forty quarterly period columns per project."""
    d, price = F.col("l_shipdate"), dec(F.col("l_extendedprice"))
    label = F.concat(F.year(d).cast("string"), F.lit("-0"), F.quarter(d).cast("string"))
    wide = lines.groupBy(F.col(key).alias("project")).agg(
        *[F.sum(F.when(label == q, price)).alias(f"cost{i + 1}") for i, q in enumerate(QUARTERS)]
    )
    periods = {f"PERIOD{i + 1}": (F.lit(q), F.col(f"cost{i + 1}")) for i, q in enumerate(QUARTERS)}
    out = projects.cost_curve(wide, periods)
    return out.withColumn("running_cost", F.round(F.col("running_cost").cast("double"), 2))


@query("cost_curve", f"WITH {cost_sql('l_suppkey', 'lineitem')} SELECT * FROM cost")
def cost_curve(t: Tables) -> DataFrame:
    """Suppliers as projects."""
    return costs(t.lineitem, "l_suppkey")


@query(
    "risk_vs_cost",
    f"""WITH {RISK_SQL}, {cost_sql("s_nationkey", "lineitem JOIN supplier ON l_suppkey = s_suppkey")}
SELECT cost.project, cost.process_date, running_cost, risk_score FROM cost LEFT JOIN risk ON risk.project = cost.project AND risk.process_date = cost.process_date""",
)
def risk_vs_cost(t: Tables) -> DataFrame:
    """Cost curve of each nation next to its risk score."""
    cost = costs(t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")), "s_nationkey").drop("period")
    return cost.join(risk_burndown(t), ["project", "process_date"], "left")

"""Calendar, period dimensions, lead-time buckets, currency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import calendar as cal
from tidemark.operators import joins, money
from tidemark.plans import leadtime
from tidemark.queries.inputs import CUT_SQL, RATES_SQL, fiscal_cal, fiscal_sql, rate_table
from tidemark.queries.registry import Tables, query


def _bounds(p: str) -> str:
    return (
        f"min(calendar_date) OVER (PARTITION BY fiscal_{p}) AS fiscal_{p}_begin_date, "
        f"max(calendar_date) OVER (PARTITION BY fiscal_{p}) AS fiscal_{p}_end_date, "
        f"date_diff('day', min(calendar_date) OVER (PARTITION BY fiscal_{p}), max(calendar_date) OVER (PARTITION BY fiscal_{p})) + 1 AS total_days_in_fiscal_{p}, "
        f"calendar_date = min(calendar_date) OVER (PARTITION BY fiscal_{p}) AS is_begin_fiscal_{p}, "
        f"calendar_date = max(calendar_date) OVER (PARTITION BY fiscal_{p}) AS is_end_fiscal_{p}, "
        f"rank() OVER (PARTITION BY fiscal_{p} ORDER BY calendar_date) AS day_in_fiscal_{p}"
    )


def _greg(u: str, months: int) -> str:
    return (
        f"CAST(date_trunc('{u}', d) AS DATE) AS {u}_begin_date, "
        f"CAST(date_trunc('{u}', d) + INTERVAL {months} MONTH - INTERVAL 1 DAY AS DATE) AS {u}_end_date, "
        f"date_diff('day', CAST(date_trunc('{u}', d) AS DATE), CAST(date_trunc('{u}', d) + INTERVAL {months} MONTH AS DATE)) AS total_days_in_{u}"
    )


def _cycle(x: str, n: str) -> str:
    return f"CASE WHEN ({x}) % {n} = 0 THEN {n} ELSE ({x}) % {n} END"


QSEQ = "(4 * (fiscal_year - 1970) + fiscal_quarter % 10 - 1)"
CALENDAR_SQL = f"""WITH {fiscal_sql("orders", "o_orderdate")},
x AS (SELECT *, calendar_date AS d, fiscal_week % 100 AS wk FROM cal),
mw AS (SELECT fiscal_month, count(DISTINCT fiscal_week) AS total_fiscal_weeks_in_fiscal_month FROM cal GROUP BY 1),
qs AS (SELECT DISTINCT fiscal_quarter AS q, {QSEQ} AS s FROM cal),
y AS (SELECT x.*, total_fiscal_weeks_in_fiscal_month,
  CASE WHEN wk = 1 THEN (fiscal_year - 1) * 100 + 52 ELSE fiscal_week - 1 END AS fiscal_week_prior,
  CASE WHEN fiscal_month % 100 = 1 THEN (fiscal_year - 1) * 100 + 12 ELSE fiscal_month - 1 END AS fiscal_month_prior,
  CASE WHEN fiscal_quarter % 10 = 1 THEN (fiscal_year - 1) * 10 + 4 ELSE fiscal_quarter - 1 END AS fiscal_quarter_prior
  FROM x JOIN mw USING (fiscal_month)),
wb AS (SELECT fiscal_week AS k, min(calendar_date) AS b, max(calendar_date) AS e FROM cal GROUP BY 1),
mb AS (SELECT fiscal_month AS k, min(calendar_date) AS b, max(calendar_date) AS e FROM cal GROUP BY 1),
qb AS (SELECT fiscal_quarter AS k, min(calendar_date) AS b, max(calendar_date) AS e FROM cal GROUP BY 1)
SELECT calendar_date, fiscal_year, fiscal_week, fiscal_month, fiscal_quarter,
  CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, strftime(d, '%a') AS day_of_week_short, strftime(d, '%A') AS day_of_week,
  dayofweek(d) NOT IN (0, 6) AS is_weekday, dayofweek(d) IN (0, 6) AS is_weekend, date_diff('day', DATE '1970-01-01', d) AS date_sequence,
  day(d) AS day_in_month, date_diff('day', CAST(date_trunc('quarter', d) AS DATE), d) + 1 AS day_in_quarter, dayofyear(d) AS day_in_year,
  CAST(strftime(d, '%Y%m') AS INT) AS month_key, year(d) || 'M' || month(d) AS month_label, strftime(d, '%b') AS month_name_short,
  strftime(d, '%B') AS month_name, {_cycle("month(d)", "3")} AS month_in_quarter, month(d) AS month_in_year,
  year(d) * 10 + quarter(d) AS quarter_key, year(d) || 'Q' || quarter(d) AS quarter_label, 'Q' || quarter(d) AS quarter_description,
  (year(d) - 1970) * 12 + month(d) - 1 AS month_sequence, quarter(d) AS quarter_in_year, (year(d) - 1970) * 4 + quarter(d) - 1 AS quarter_sequence,
  year(d) AS year_key, 'CY' || year(d) AS year_description, year(d) - 1970 AS year_sequence,
  {_greg("month", 1)}, {_greg("quarter", 3)}, {_greg("year", 12)},
  {", ".join(_bounds(p) for p in cal.PERIODS)},
  3 AS total_months_in_quarter, 12 AS total_months_in_year, 4 AS total_quarters_in_year,
  (SELECT count(DISTINCT c.fiscal_week) FROM cal c WHERE c.fiscal_quarter = y.fiscal_quarter) AS total_fiscal_weeks_in_fiscal_quarter,
  (SELECT count(DISTINCT c.fiscal_week) FROM cal c WHERE c.fiscal_year = y.fiscal_year) AS total_fiscal_weeks_in_fiscal_year,
  (SELECT count(DISTINCT c.fiscal_month) FROM cal c WHERE c.fiscal_quarter = y.fiscal_quarter) AS total_fiscal_months_in_fiscal_quarter,
  (SELECT count(DISTINCT c.fiscal_month) FROM cal c WHERE c.fiscal_year = y.fiscal_year) AS total_fiscal_months_in_fiscal_year,
  total_fiscal_weeks_in_fiscal_month, wk AS fiscal_week_number, 52 * (fiscal_year - 1970) + wk - 1 AS fiscal_week_sequence,
  {_cycle("wk", "total_fiscal_weeks_in_fiscal_month")} AS fiscal_week_in_fiscal_month, {_cycle("wk", "13")} AS fiscal_week_in_fiscal_quarter,
  {_cycle("wk", "13")} AS crawl_week_in_fiscal_quarter, ({_cycle("wk", "13")}) - 13 AS crawl_week_in_fiscal_quarter_plus_1,
  ({_cycle("wk", "13")}) - 26 AS crawl_week_in_fiscal_quarter_plus_2, fiscal_month % 100 AS fiscal_month_number,
  {_cycle("fiscal_month % 100", "3")} AS fiscal_month_in_fiscal_quarter,
  strftime(make_date(CAST(fiscal_year AS INT), CAST(fiscal_month % 100 AS INT), 1), '%b') || substr(CAST(fiscal_month AS VARCHAR), 3, 2) AS fiscal_month_description,
  fiscal_quarter % 10 AS fiscal_quarter_number, fiscal_year * 100 + fiscal_quarter % 10 AS fiscal_quarter_yyyyqq,
  'Q' || substr(CAST(fiscal_quarter AS VARCHAR), 5, 1) || substr(CAST(fiscal_quarter AS VARCHAR), 3, 2) AS fiscal_quarter_description,
  12 * (fiscal_year - 1970) + fiscal_month % 100 - 1 AS fiscal_month_sequence, {QSEQ} AS fiscal_quarter_sequence, fiscal_year - 1970 AS fiscal_year_sequence,
  fiscal_quarter - 10 AS fiscal_quarter_prior_year, fiscal_week_prior, fiscal_month_prior, fiscal_quarter_prior, fiscal_year - 1 AS fiscal_year_prior,
  wb.b AS fiscal_week_prior_begin_date, wb.e AS fiscal_week_prior_end_date, mb.b AS fiscal_month_prior_begin_date, mb.e AS fiscal_month_prior_end_date,
  qb.b AS fiscal_quarter_prior_begin_date, qb.e AS fiscal_quarter_prior_end_date,
  {", ".join(f"(SELECT q FROM qs WHERE s = {QSEQ} - {k}) AS fiscal_quarter_minus_{k}" for k in (4, 3, 2, 1))},
  {", ".join(f"(SELECT q FROM qs WHERE s = {QSEQ} + {k}) AS fiscal_quarter_plus_{k}" for k in (1, 2, 3, 4))}
FROM y LEFT JOIN wb ON wb.k = fiscal_week_prior LEFT JOIN mb ON mb.k = fiscal_month_prior LEFT JOIN qb ON qb.k = fiscal_quarter_prior"""


@query("fiscal_calendar", CALENDAR_SQL)
def fiscal_calendar(t: Tables) -> DataFrame:
    return cal.fiscal_calendar(fiscal_cal(t.orders, "o_orderdate"))


def _flags(p: str, seq: str, ago: int | None) -> str:
    now = f"(SELECT {seq} FROM cal WHERE calendar_date = DATE '2000-06-15')"
    out = f"{seq} = {now} AS is_current_fiscal_{p}, {seq} = {now} - 1 AS is_prior_fiscal_{p}"
    return out + (f", {seq} = {now} - {ago} AS is_prior_fiscal_year_current_fiscal_{p}" if ago else "")


@query(
    "calendar_flags",
    f"""WITH {fiscal_sql("orders", "o_orderdate")}
SELECT calendar_date, {_flags("week", "52 * (fiscal_year - 1970) + fiscal_week % 100 - 1", 52)},
  {_flags("month", "12 * (fiscal_year - 1970) + fiscal_month % 100 - 1", 12)}, {_flags("quarter", QSEQ, 4)},
  {_flags("year", "fiscal_year - 1970", None)} FROM cal""",
)
def calendar_flags(t: Tables) -> DataFrame:
    names = [f"fiscal_{p}_sequence" for p in cal.PERIODS]
    days = cal.with_sequences(fiscal_cal(t.orders, "o_orderdate")).select("calendar_date", *names)
    return cal.relative_flags(days, "2000-06-15").drop(*names)


@query(
    "calendar_period_flags",
    f"""WITH {fiscal_sql("orders", "o_orderdate")}, n AS (SELECT calendar_date, 12 * year(calendar_date) + month(calendar_date) AS m,
  4 * year(calendar_date) + quarter(calendar_date) AS q, year(calendar_date) AS y FROM cal)
SELECT calendar_date, calendar_date = DATE '2000-06-15' AS is_current_day, calendar_date = DATE '2000-06-14' AS is_prior_day,
  m = 12 * 2000 + 6 AS is_current_month, m = 12 * 2000 + 5 AS is_prior_month, m = 12 * 1999 + 6 AS is_prior_year_current_month,
  q = 4 * 2000 + 2 AS is_current_quarter, q = 4 * 2000 + 1 AS is_prior_quarter, q = 4 * 1999 + 2 AS is_prior_year_current_quarter,
  y = 2000 AS is_current_year, y = 1999 AS is_prior_year FROM n""",
)
def calendar_period_flags(t: Tables) -> DataFrame:
    days = fiscal_cal(t.orders, "o_orderdate").select("calendar_date")
    return cal.calendar_period_flags(days, "2000-06-15")


@query(
    "period_bounds",
    f"""WITH {fiscal_sql("orders", "o_orderdate")}
SELECT calendar_date, {_bounds("week")} FROM cal""",
)
def period_bounds(t: Tables) -> DataFrame:
    full = cal.fiscal_calendar(fiscal_cal(t.orders, "o_orderdate"))
    cols = "fiscal_week_begin_date fiscal_week_end_date total_days_in_fiscal_week is_begin_fiscal_week is_end_fiscal_week day_in_fiscal_week"
    return full.select("calendar_date", *cols.split())


def _dim_sql(p: str, cols: str) -> str:
    return f"""WITH {fiscal_sql("orders", "o_orderdate")}
SELECT fiscal_{p}, {cols}, min(calendar_date) AS fiscal_{p}_begin_date, max(calendar_date) AS fiscal_{p}_end_date FROM cal GROUP BY ALL"""


@query("fiscal_week_dim", _dim_sql("week", "fiscal_month, fiscal_quarter, fiscal_year"))
def fiscal_week_dim(t: Tables) -> DataFrame:
    return _dim(t, "week", ["fiscal_month", "fiscal_quarter", "fiscal_year"])


@query("fiscal_quarter_dim", _dim_sql("quarter", "fiscal_year"))
def fiscal_quarter_dim(t: Tables) -> DataFrame:
    return _dim(t, "quarter", ["fiscal_year"])


def _dim(t: Tables, p: str, cols: list[str]) -> DataFrame:
    full = cal.fiscal_calendar(fiscal_cal(t.orders, "o_orderdate"))
    return cal.distinct_dim(full, [f"fiscal_{p}", *cols, f"fiscal_{p}_begin_date", f"fiscal_{p}_end_date"])


@query(
    "leadtime_buckets",
    """WITH f AS (SELECT l_partkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS run_date, l_quantity, l_suppkey,
  ROW_NUMBER() OVER (PARTITION BY l_partkey, date_trunc('month', l_shipdate) ORDER BY l_shipdate DESC, l_suppkey DESC, l_quantity DESC, l_orderkey DESC) AS rn FROM lineitem),
b AS (SELECT run_date, 1 - ROW_NUMBER() OVER (ORDER BY run_date DESC) AS bucket FROM (SELECT DISTINCT run_date FROM f))
SELECT l_partkey, f.run_date, l_quantity AS leadtime, l_suppkey, bucket FROM f JOIN b ON f.run_date = b.run_date WHERE rn = 1""",
)
def leadtime_buckets(t: Tables) -> DataFrame:
    li = t.lineitem.withColumn("run_date", F.trunc("l_shipdate", "month"))
    order = [F.col(c).desc() for c in ("l_shipdate", "l_suppkey", "l_quantity", "l_orderkey")]
    fact = leadtime.leadtime_fact(li, "l_partkey", "run_date", order)
    return leadtime.with_buckets(fact, "run_date").select(
        "l_partkey", "run_date", F.col("l_quantity").alias("leadtime"), "l_suppkey", "bucket"
    )


@query(
    "convert_amounts",
    f"""WITH {RATES_SQL}, o AS (SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m') AS INT) AS m, o_orderpriority AS cur, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders)
SELECT o_orderkey, {CUT_SQL.format(amount="amount", rate="a.rate")} AS amount_low, {CUT_SQL.format(amount="amount", rate="b.rate")} AS amount_high
FROM o LEFT JOIN cross_rates a ON a.month = m AND a.from_cur = cur AND a.to_cur = '5-LOW'
LEFT JOIN cross_rates b ON b.month = m AND b.from_cur = cur AND b.to_cur = '2-HIGH'""",
)
def convert_amounts(t: Tables) -> DataFrame:
    """Order amounts in two other currencies; a zero rate gives null."""
    facts = t.orders.select(
        "o_orderkey", F.date_format("o_orderdate", "yyyyMM").cast("int").alias("m"), F.col("o_orderpriority").alias("cur"), "o_totalprice"
    )
    rates = joins.cross_rates(rate_table(t))
    out = money.convert_amounts(
        facts, rates, "o_totalprice", "m", "cur", {"amount_low": "5-LOW", "amount_high": "2-HIGH"}
    )
    return out.select("o_orderkey", F.col("amount_low").cast("double").alias("amount_low"), F.col("amount_high").cast("double").alias("amount_high"))

"""Inputs the queries share, as DataFrames and as SQL text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import calendar as cal
from tidemark.operators.dedup import latest
from tidemark.queries.registry import Tables

# lineitem repeats (l_orderkey, l_linenumber): read it as staging rows, loaded on l_shipdate.
LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_TIE = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
LINE_ORDER_SQL = ", ".join(f"{c} DESC NULLS LAST" for c in LINE_TIE)


def newest_line_order() -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in LINE_TIE]


def current_lines(t: Tables) -> DataFrame:
    return latest(t.lineitem, LINE_KEY, newest_line_order())


CURRENT_LINES_SQL = f"""current_lines AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) AS rn
    FROM lineitem) WHERE rn = 1)"""


def fiscal_cal(df: DataFrame, date: str) -> DataFrame:
    return cal.fiscal_days(cal.day_spine(df, date))


def fiscal_sql(table: str, date: str, name: str = "cal") -> str:
    return f"""{name}_days AS (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS calendar_date
  FROM (SELECT date_trunc('day', min({date})) AS lo, date_trunc('day', max({date})) AS hi FROM {table})),
{name}_wk AS (
  SELECT calendar_date, year(calendar_date) AS fiscal_year,
         least((dayofyear(calendar_date) - 1) // 7 + 1, 52) AS wk FROM {name}_days),
{name}_q AS (SELECT *, (wk - 1) // 13 + 1 AS q FROM {name}_wk),
{name} AS (
  SELECT calendar_date, fiscal_year, fiscal_year * 100 + wk AS fiscal_week,
         fiscal_year * 100 + (q - 1) * 3 + CASE WHEN wk - 1 - (q - 1) * 13 < 4 THEN 1
           WHEN wk - 1 - (q - 1) * 13 < 8 THEN 2 ELSE 3 END AS fiscal_month,
         fiscal_year * 10 + q AS fiscal_quarter
  FROM {name}_q)"""


def on_day(facts: DataFrame, date: str, calendar: DataFrame, columns: list[str]) -> DataFrame:
    """Look up calendar columns of a fact's day."""
    side = calendar.select(F.col("calendar_date").alias("_day"), *columns)
    return facts.join(side, F.col(date).cast("date") == F.col("_day"), "left").drop("_day")


def rate_table(t: Tables) -> DataFrame:
    """Monthly rates of five currencies into a common one, one of them zero each January."""
    o = t.orders
    month = F.date_format("o_orderdate", "yyyyMM").cast("int")
    return (
        o.groupBy(month.alias("month"), F.col("o_orderpriority").alias("from_cur"))
        .agg(
            F.max(F.col("o_totalprice").cast("decimal(18,2)")).alias("top"),
            F.max("o_orderdate").alias("loaded"),
        )
        .select(
            "month",
            "from_cur",
            F.lit("COMMON").alias("to_cur"),
            F.when((F.col("month") % 100 == 1) & (F.col("from_cur") == "5-LOW"), F.lit(0))
            .otherwise(F.col("top"))
            .cast("double")
            .alias("rate"),
            "loaded",
        )
    )


RATES_SQL = """rates AS (
  SELECT month, from_cur, 'COMMON' AS to_cur,
         CASE WHEN month % 100 = 1 AND from_cur = '5-LOW' THEN 0 ELSE CAST(top AS DOUBLE) END AS rate, loaded
  FROM (SELECT CAST(strftime(o_orderdate, '%Y%m') AS INT) AS month, o_orderpriority AS from_cur,
               max(CAST(o_totalprice AS DECIMAL(18,2))) AS top, max(o_orderdate) AS loaded
        FROM orders GROUP BY 1, 2)),
cross_rates AS (
  SELECT month, src AS from_cur, dst AS to_cur, rate FROM (
    SELECT a.month, a.from_cur AS src, b.from_cur AS dst,
           CASE WHEN b.rate = 0 THEN 0.0 WHEN a.from_cur = b.from_cur THEN 1.0
                ELSE round(a.rate / b.rate, 6) END AS rate,
           ROW_NUMBER() OVER (PARTITION BY a.month, a.from_cur, b.from_cur
             ORDER BY a.loaded DESC NULLS LAST, b.loaded DESC NULLS LAST, a.to_cur) AS rn
    FROM rates a JOIN rates b ON a.to_cur = b.to_cur AND a.month = b.month) WHERE rn = 1)"""

# amount (two decimals) / rate (six), cut to four digits, in exact integers
CUT_SQL = (
    "CASE WHEN {rate} IS NULL OR {rate} = 0 THEN NULL ELSE "
    "sign({amount}) * CAST((CAST(round(abs({amount}) * 100) AS HUGEINT) * 100000000) "
    "// CAST(round({rate} * 1000000) AS HUGEINT) AS DOUBLE) / 10000 END"
)

"""Group-by aggregates and classification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import dec, exact_sum
from tidemark.operators.rollup import classify, rollup_to
from tidemark.queries.inputs import fiscal_cal, fiscal_sql
from tidemark.queries.registry import Tables, query


def sales_lines(t: Tables) -> DataFrame:
    """Lines with their order's date, customer and segment."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    c = t.customer.select("c_custkey", "c_mktsegment")
    return (
        t.lineitem.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
    )


SALES_SQL = """sales AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey)"""
MEASURES_SQL = """CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS gross,
  CAST(sum(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))) AS DECIMAL(18,4))) AS DOUBLE) AS net"""


def measures():
    gross = dec(F.col("l_extendedprice"))
    return {
        "quantity": F.col("l_quantity"),
        "gross": gross,
        "net": gross * (1 - dec(F.col("l_discount"))),
    }


def sales_by(t: Tables, period: str) -> DataFrame:
    return rollup_to(
        sales_lines(t), fiscal_cal(t.orders, "o_orderdate"), "o_orderdate", period,
        ["c_mktsegment", "l_returnflag"], measures(), scale=4,
    )


def sales_by_sql(period: str) -> str:
    return f"""WITH {fiscal_sql("orders", "o_orderdate")}, {SALES_SQL}
SELECT c_mktsegment, l_returnflag, {period}, {MEASURES_SQL}
FROM sales LEFT JOIN cal ON CAST(o_orderdate AS DATE) = calendar_date GROUP BY 1, 2, 3"""


@query("weekly_sales", sales_by_sql("fiscal_week"))
def weekly_sales(t: Tables) -> DataFrame:
    return sales_by(t, "fiscal_week")


@query("quarterly_sales", sales_by_sql("fiscal_quarter"))
def quarterly_sales(t: Tables) -> DataFrame:
    return sales_by(t, "fiscal_quarter")


@query(
    "distinct_counts",
    """SELECT l_returnflag, l_linestatus, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers,
  count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY 1, 2""",
)
def distinct_counts(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count_distinct("l_partkey").alias("parts"),
        F.count_distinct("l_suppkey").alias("suppliers"),
        F.count_distinct("l_orderkey").alias("orders"),
    )


@query(
    "cond_distinct",
    """SELECT l_suppkey, count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS returned,
  count(DISTINCT CASE WHEN l_returnflag IN ('A', 'N') THEN l_partkey END) AS kept FROM lineitem GROUP BY 1""",
)
def cond_distinct(t: Tables) -> DataFrame:
    flag = F.col("l_returnflag")
    return t.lineitem.groupBy("l_suppkey").agg(
        F.count_distinct(F.when(flag == "R", F.col("l_partkey"))).alias("returned"),
        F.count_distinct(F.when(flag.isin("A", "N"), F.col("l_partkey"))).alias("kept"),
    )


@query(
    "cond_sum",
    """SELECT l_partkey, CAST(sum(CASE WHEN l_returnflag = 'R' THEN coalesce(CAST(l_quantity AS DECIMAL(18,2)), 0) END) AS DOUBLE) AS returned,
  CAST(sum(CASE WHEN l_quantity > 49 THEN CAST(l_quantity AS DECIMAL(18,2)) END) AS DOUBLE) AS large FROM lineitem GROUP BY 1""",
)
def cond_sum(t: Tables) -> DataFrame:
    """A group without a match is null, not zero."""
    q = dec(F.col("l_quantity"))
    return t.lineitem.groupBy("l_partkey").agg(
        F.sum(F.when(F.col("l_returnflag") == "R", F.coalesce(q, F.lit(0)))).cast("double").alias("returned"),
        F.sum(F.when(F.col("l_quantity") > 49, q)).cast("double").alias("large"),
    )


@query(
    "count_if",
    """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'P') AS pending, count(*) FILTER (o_totalprice > 250000) AS large FROM orders GROUP BY 1""",
)
def count_if(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderpriority").agg(
        F.count_if(F.col("o_orderstatus") == "P").alias("pending"), F.count_if(F.col("o_totalprice") > 250000).alias("large")
    )


@query(
    "first_last_order",
    """SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first_order, CAST(max(o_orderdate) AS DATE) AS last_order,
  min(o_totalprice) AS smallest, max(o_totalprice) AS largest FROM orders GROUP BY 1""",
)
def first_last_order(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").cast("date").alias("first_order"),
        F.max("o_orderdate").cast("date").alias("last_order"),
        F.min("o_totalprice").alias("smallest"),
        F.max("o_totalprice").alias("largest"),
    )


@query(
    "month_dim",
    """SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m') AS INT) AS month_key, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_begin,
  last_day(CAST(o_orderdate AS DATE)) AS month_end FROM orders""",
)
def month_dim(t: Tables) -> DataFrame:
    d = F.col("o_orderdate").cast("date")
    return t.orders.select(
        F.date_format(d, "yyyyMM").cast("int").alias("month_key"),
        F.trunc(d, "month").alias("month_begin"),
        F.last_day(d).alias("month_end"),
    ).distinct()


@query(
    "weeks_per_month",
    f"""WITH {fiscal_sql("orders", "o_orderdate")}
SELECT fiscal_month, count(*) AS weeks FROM (SELECT DISTINCT fiscal_month, fiscal_week FROM cal) GROUP BY 1""",
)
def weeks_per_month(t: Tables) -> DataFrame:
    """Two-level group: distinct weeks, then their number per month."""
    days = fiscal_cal(t.orders, "o_orderdate")
    return days.groupBy("fiscal_month", "fiscal_week").count().groupBy("fiscal_month").agg(F.count("*").alias("weeks"))


@query(
    "classify_parts",
    """WITH s AS (SELECT l_partkey, sum(CAST(l_quantity AS DECIMAL(18,2))) AS q, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1)
SELECT p_partkey, CAST(q AS DOUBLE) AS quantity, n AS suppliers,
  CASE WHEN p_type = 'PROMO' THEN 'Custom' WHEN q > 900 AND n > 30 THEN 'Super Commodity' WHEN q > 800 AND n > 25 THEN 'Commodity 1'
       WHEN n >= 30 THEN 'Firm - High Cust' WHEN n <= 20 THEN 'Firm - Low Cust' WHEN q = 0 OR q IS NULL THEN 'No Revenue' ELSE 'Firm' END AS class
FROM part LEFT JOIN s ON p_partkey = l_partkey""",
)
def classify_parts(t: Tables) -> DataFrame:
    s = t.lineitem.groupBy("l_partkey").agg(
        F.sum(dec(F.col("l_quantity"))).alias("q"), F.count_distinct("l_suppkey").alias("suppliers")
    )
    q, n = F.col("q"), F.col("suppliers")
    label = classify(
        [
            (F.col("p_type") == "PROMO", "Custom"),
            ((q > 900) & (n > 30), "Super Commodity"),
            ((q > 800) & (n > 25), "Commodity 1"),
            (n >= 30, "Firm - High Cust"),
            (n <= 20, "Firm - Low Cust"),
            ((q == 0) | q.isNull(), "No Revenue"),
        ],
        "Firm",
    )
    return t.part.join(s, F.col("p_partkey") == F.col("l_partkey"), "left").select(
        "p_partkey", q.cast("double").alias("quantity"), "suppliers", label.alias("class")
    )


@query(
    "grouped_by_expression",
    """SELECT year(o_orderdate) AS y, left(o_orderpriority, 1) AS p, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders GROUP BY 1, 2""",
)
def grouped_by_expression(t: Tables) -> DataFrame:
    return (
        t.orders.groupBy(F.year("o_orderdate").alias("y"), F.left("o_orderpriority", F.lit(1)).alias("p"))
        .agg(exact_sum(F.col("o_totalprice")).alias("total"))
    )


@query("distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(t: Tables) -> DataFrame:
    return t.lineitem.select("l_partkey", "l_suppkey", "l_returnflag").distinct()

"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.queries.registry import Tables, query


@query(
    "dq_unique",
    """SELECT l_orderkey || '--' || l_linenumber AS unique_field, count(*) AS n_records FROM lineitem GROUP BY 1 HAVING count(*) > 1""",
)
def dq_unique(t: Tables) -> DataFrame:
    expr = F.concat(F.col("l_orderkey").cast("string"), F.lit("--"), F.col("l_linenumber").cast("string"))
    return quality.not_unique(t.lineitem, expr)


@query("dq_not_null", """SELECT event_id, user_id FROM events WHERE nullif(event_type, 'view') IS NULL""")
def dq_not_null(t: Tables) -> DataFrame:
    return quality.is_null(t.events, F.nullif("event_type", F.lit("view"))).select("event_id", "user_id")


@query(
    "dq_scoped",
    """SELECT l_partkey AS unique_field, count(*) AS n_records FROM (SELECT l_partkey, l_shipdate FROM lineitem) l
WHERE date_trunc('year', l_shipdate) = (SELECT max(date_trunc('year', l_shipdate)) FROM lineitem) GROUP BY 1 HAVING count(*) > 1""",
)
def dq_scoped(t: Tables) -> DataFrame:
    """Only the rows of the newest yearly load are checked."""
    loads = t.lineitem.select("l_partkey", F.date_trunc("year", F.col("l_shipdate")).alias("load"))
    return quality.not_unique(quality.in_latest_load(loads, "load"), "l_partkey")


@query(
    "dq_missing_fk",
    """SELECT DISTINCT l_orderkey AS missing_key FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""",
)
def dq_missing_fk(t: Tables) -> DataFrame:
    dim = t.orders.where(F.col("o_orderstatus") != "P")
    return quality.missing_keys(t.lineitem, "l_orderkey", dim, "o_orderkey")


@query(
    "dq_missing_fk_full",
    """SELECT DISTINCT 'ORDERS' AS target_model, 'LINEITEM' AS source_model, CAST(l_orderkey AS VARCHAR) AS missing_value,
  '2001-12-31 00:00:00' AS ins_dttm, 7 AS batch_id FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""",
)
def dq_missing_fk_full(t: Tables) -> DataFrame:
    """Full check (scope ignored) as audit rows."""
    dim = t.orders.where(F.col("o_orderstatus") != "P")
    missing = quality.missing_keys(
        t.lineitem, "l_orderkey", dim, "o_orderkey", F.col("l_shipdate") >= F.lit("2001-01-01").cast("timestamp_ntz"), full=True
    )
    rows = quality.audit_rows(missing, {"target_model": "ORDERS", "source_model": "LINEITEM"}, "2001-12-31 00:00:00", 7)
    return rows.withColumn("ins_dttm", F.date_format("ins_dttm", "yyyy-MM-dd HH:mm:ss"))


@query(
    "inferred_members",
    """WITH dim AS (SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR)) AS order_key, o_orderstatus, 'LOAD' AS origin FROM orders WHERE o_orderstatus <> 'P')
SELECT * FROM dim UNION ALL SELECT DISTINCT l_orderkey, md5(CAST(l_orderkey AS VARCHAR)), CAST(NULL AS VARCHAR), 'INFERRED' FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM dim)""",
)
def inferred_members(t: Tables) -> DataFrame:
    dim = t.orders.where(F.col("o_orderstatus") != "P").select(
        "o_orderkey", F.md5(F.col("o_orderkey").cast("string")).alias("order_key"), "o_orderstatus", F.lit("LOAD").alias("origin")
    )
    missing = quality.missing_keys(t.lineitem, "l_orderkey", dim, "o_orderkey")
    return quality.insert_inferred(dim, missing, "o_orderkey", "order_key", origin=F.lit("INFERRED"))


_CHECKS_SQL = """WITH line AS (SELECT *, l_orderkey || '--' || l_linenumber AS line_key FROM lineitem),
failed AS (
  SELECT 'line_unique' AS check_name, line_key AS failed_key, count(*) AS n_records FROM line GROUP BY 2 HAVING count(*) > 1
  UNION ALL SELECT 'part_unique', CAST(l_partkey AS VARCHAR), count(*) FROM line
    WHERE date_trunc('year', l_shipdate) = (SELECT max(date_trunc('year', l_shipdate)) FROM line) GROUP BY 2 HAVING count(*) > 1
  UNION ALL SELECT 'flag_not_null', CAST(NULL AS VARCHAR), count(*) FROM line WHERE nullif(l_returnflag, 'R') IS NULL HAVING count(*) > 0
  UNION ALL SELECT 'order_known', CAST(l_orderkey AS VARCHAR), count(*) FROM line
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY 2
  UNION ALL SELECT 'part_known', CAST(l_partkey AS VARCHAR), count(*) FROM line
    WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40) GROUP BY 2
  UNION ALL SELECT 'supplier_known', CAST(l_suppkey AS VARCHAR), count(*) FROM line
    WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier) GROUP BY 2)
"""


def line_checks(t: Tables) -> list[quality.Check]:
    """Six checks of the lines: keys, a scoped key, a blank flag and three dimensions."""
    year = F.date_trunc("year", F.col("l_shipdate"))
    last = t.lineitem.agg(F.max(year)).scalar()
    line = F.concat(F.col("l_orderkey").cast("string"), F.lit("--"), F.col("l_linenumber").cast("string"))
    return [
        quality.Check("line_unique", "unique", line),
        quality.Check("part_unique", "unique", "l_partkey", where=year == last),
        quality.Check("flag_not_null", "not_null", F.nullif("l_returnflag", F.lit("R"))),
        quality.Check("order_known", "foreign", "l_orderkey", t.orders.where(F.col("o_orderstatus") != "P"), "o_orderkey"),
        quality.Check("part_known", "foreign", "l_partkey", t.part.where(F.col("p_size") <= 40), "p_partkey"),
        quality.Check("supplier_known", "foreign", "l_suppkey", t.supplier, "s_suppkey"),
    ]


@query("dq_failures", _CHECKS_SQL + "SELECT * FROM failed")
def dq_failures(t: Tables) -> DataFrame:
    """Failing keys of six checks from one scan of the lines."""
    return quality.failures(t.lineitem, line_checks(t))


@query(
    "dq_report",
    _CHECKS_SQL
    + """SELECT c.check_name, c.kind, coalesce(count(f.check_name), 0) AS failed_keys, CAST(coalesce(sum(n_records), 0) AS BIGINT) AS failed_records,
  CASE WHEN count(f.check_name) > 0 THEN 'fail' ELSE 'pass' END AS status
FROM (VALUES ('line_unique', 'unique'), ('part_unique', 'unique'), ('flag_not_null', 'not_null'), ('order_known', 'foreign'),
  ('part_known', 'foreign'), ('supplier_known', 'foreign')) c(check_name, kind) LEFT JOIN failed f ON f.check_name = c.check_name GROUP BY 1, 2""",
)
def dq_report(t: Tables) -> DataFrame:
    """Outcome of the six checks, passed ones too."""
    return quality.report(t.lineitem, line_checks(t))

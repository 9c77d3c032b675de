"""One query per family of scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates, hashing, numbers, text
from tidemark.queries.registry import Tables, query


@query(
    "scalars_null",
    """SELECT event_id, coalesce(nullif(event_type, 'view'), 'none') AS filled, CASE WHEN value > 5 THEN 'hi' ELSE 'lo' END AS size,
  CASE WHEN nullif(event_type, 'view') IS NULL THEN 'N' WHEN event_type = 'click' THEN 'C' ELSE 'X' END AS decoded,
  coalesce(nullif(event_type, ''), 'blank') AS no_blank FROM events""",
)
def scalars_null(t: Tables) -> DataFrame:
    e = F.nullif("event_type", F.lit("view"))
    return t.events.select(
        "event_id",
        F.nvl(e, F.lit("none")).alias("filled"),
        F.expr("if(value > 5, 'hi', 'lo')").alias("size"),
        # decode matches null to null
        F.expr("decode(nullif(event_type, 'view'), null, 'N', 'click', 'C', 'X')").alias("decoded"),
        F.ifnull(text.blank_to_null(F.col("event_type")), F.lit("blank")).alias("no_blank"),
    )


@query(
    "scalars_string",
    """SELECT c_custkey, upper(c_name) AS up, lower(c_mktsegment) AS low, trim('  ' || c_name || ' ') AS trimmed,
  length(c_name) AS len, left(c_name, 4) AS l4, right(c_name, 5) AS r5, substr(c_name, 1, 3) AS s3,
  substr(c_name, length(c_name) - 4) AS tail, replace(c_name, '#', '') AS no_hash,
  CASE WHEN length(CAST(c_custkey AS VARCHAR)) >= 3 THEN CAST(c_custkey AS VARCHAR) ELSE lpad(CAST(c_custkey AS VARCHAR), 3, '0') END AS padded,
  concat_ws('/', c_mktsegment, CAST(c_nationkey AS VARCHAR)) AS path, c_name || ':' || c_mktsegment AS glued FROM customer""",
)
def scalars_string(t: Tables) -> DataFrame:
    name, seg = F.col("c_name"), F.col("c_mktsegment")
    return t.customer.select(
        "c_custkey",
        F.upper(name).alias("up"),
        F.lower(seg).alias("low"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.length(name).alias("len"),
        F.left(name, F.lit(4)).alias("l4"),
        F.right(name, F.lit(5)).alias("r5"),
        F.substring(name, 0, 3).alias("s3"),
        F.substring(name, -5, 5).alias("tail"),
        text.remove(name, "#").alias("no_hash"),
        text.pad_left(F.col("c_custkey").cast("string"), 3, "0").alias("padded"),
        F.concat_ws("/", seg, F.col("c_nationkey").cast("string")).alias("path"),
        F.concat(name, F.lit(":"), seg).alias("glued"),
    )


@query(
    "scalars_search",
    """SELECT p_partkey, strpos(p_name, ' ') AS blank_at,
  CASE WHEN strpos(substr(p_name, 3), 'i') = 0 THEN 0 ELSE strpos(substr(p_name, 3), 'i') + 2 END AS i_from_3,
  split_part(p_name, ' ', 1) AS first_word, split_part(p_name, ' ', -1) AS last_word, strpos(p_brand, '#') AS hash_at FROM part""",
)
def scalars_search(t: Tables) -> DataFrame:
    name = F.col("p_name")
    return t.part.select(
        "p_partkey",
        text.find(" ", name).alias("blank_at"),
        text.find("i", name, 3).alias("i_from_3"),
        F.split_part(name, F.lit(" "), F.lit(1)).alias("first_word"),
        text.last_part(name, " ").alias("last_word"),
        text.find("#", F.col("p_brand")).alias("hash_at"),
    )


@query(
    "scalars_regex",
    r"""SELECT p_partkey, nullif(regexp_extract(p_brand, '[0-9]+'), '') AS brand_no,
  regexp_full_match(p_name, '[a-z]+ widget') AS is_widget, regexp_full_match(p_brand, 'Brand') AS is_plain_brand FROM part""",
)
def scalars_regex(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey",
        F.regexp_substr("p_brand", F.lit("[0-9]+")).alias("brand_no"),
        text.matches_fully(F.col("p_name"), "[a-z]+ widget").alias("is_widget"),
        text.matches_fully(F.col("p_brand"), "Brand").alias("is_plain_brand"),
    )


@query(
    "scalars_numeric",
    """SELECT c_custkey, CAST(round(CAST(c_acctbal AS DECIMAL(18,2)), 1) AS DOUBLE) AS rounded,
  sign(CAST(c_acctbal AS DECIMAL(18,2))) * CAST(CAST(round(abs(CAST(c_acctbal AS DECIMAL(18,2))) * 100) AS BIGINT) // 10 AS DOUBLE) / 10 AS cut,
  c_custkey % 7 AS modulo, abs(-c_nationkey) AS magnitude,
  CASE WHEN c_nationkey = 0 THEN NULL ELSE CAST(c_custkey AS DOUBLE) / CAST(c_nationkey AS DOUBLE) END AS quotient,
  -1 * CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS flipped FROM customer""",
)
def scalars_numeric(t: Tables) -> DataFrame:
    bal = numbers.dec(F.col("c_acctbal"))
    return t.customer.select(
        "c_custkey",
        F.round(bal, 1).cast("double").alias("rounded"),
        numbers.truncate(bal, 1).cast("double").alias("cut"),
        (F.col("c_custkey") % 7).alias("modulo"),
        F.abs(-F.col("c_nationkey")).alias("magnitude"),
        numbers.ratio(F.col("c_custkey").cast("double"), F.col("c_nationkey").cast("double")).alias("quotient"),
        (-1 * bal).cast("double").alias("flipped"),
    )


@query(
    "scalars_dateparts",
    """SELECT event_id, year(ts) AS y, quarter(ts) AS q, month(ts) AS m, day(ts) AS d, dayofyear(ts) AS doy, hour(ts) AS h,
  left(dayname(ts), 3) AS dname, left(monthname(ts), 3) AS mname FROM events""",
)
def scalars_dateparts(t: Tables) -> DataFrame:
    ts = F.col("ts")
    return t.events.select(
        "event_id", F.year(ts).alias("y"), F.quarter(ts).alias("q"), F.month(ts).alias("m"), F.dayofmonth(ts).alias("d"),
        F.dayofyear(ts).alias("doy"), F.hour(ts).alias("h"), F.dayname(ts).alias("dname"), F.monthname(ts).alias("mname"),
    )


@query(
    "scalars_datemath",
    """WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, d + 30 AS plus_30, date_diff('day', d, DATE '2001-12-31') AS age, last_day(d) AS month_end,
  CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end,
  CAST(date_trunc('year', d) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS year_end,
  CAST(date_trunc('year', d) AS DATE) AS year_start, CAST(d + INTERVAL 3 YEAR AS DATE) AS plus_3y,
  CAST(d + INTERVAL 3 YEAR - INTERVAL 1 DAY AS DATE) AS end_3y FROM o""",
)
def scalars_datemath(t: Tables) -> DataFrame:
    d = F.col("o_orderdate").cast("date")
    return t.orders.select(
        "o_orderkey",
        F.date_add(d, 30).alias("plus_30"),
        F.datediff(dates.day("2001-12-31"), d).alias("age"),
        dates.last_of(d, "month").alias("month_end"),
        dates.last_of(d, "quarter").alias("quarter_end"),
        dates.last_of(d, "year").alias("year_end"),
        dates.first_of(d, "year").alias("year_start"),
        F.add_months(d, 36).alias("plus_3y"),
        F.date_sub(F.add_months(d, 36), 1).alias("end_3y"),
    )


@query(
    "scalars_parse",
    """WITH x AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
    WHEN 'O' THEN strftime(o_orderdate, '%d-%b-%Y') ELSE 'No Value' END AS txt, o_orderdate, o_orderpriority FROM orders)
SELECT o_orderkey, txt, CAST(coalesce(try_strptime(txt, '%Y-%m-%d %H:%M:%S'), try_strptime(txt, '%d-%b-%Y')) AS DATE) AS parsed,
  CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS date_key, TRY_CAST(left(o_orderpriority, 1) AS BIGINT) AS rank_no,
  TRY_CAST(o_orderpriority AS BIGINT) AS no_number FROM x""",
)
def scalars_parse(t: Tables) -> DataFrame:
    """Two text layouts in one column, text that is no date, date keys, guarded numbers."""
    d = F.col("o_orderdate")
    txt = (
        F.when(F.col("o_orderstatus") == "F", F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("o_orderstatus") == "O", F.date_format(d, "dd-MMM-yyyy"))
        .otherwise("No Value")
    )
    return t.orders.withColumn("txt", txt).select(
        "o_orderkey",
        "txt",
        dates.parse_any(F.col("txt"), ["yyyy-MM-dd HH:mm:ss", "dd-MMM-yyyy"]).cast("date").alias("parsed"),
        dates.date_key(d).alias("date_key"),
        numbers.number_or_null(F.left("o_orderpriority", F.lit(1))).alias("rank_no"),
        numbers.number_or_null(F.col("o_orderpriority")).alias("no_number"),
    )


@query(
    "scalars_bool",
    """WITH x AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
  CASE l_returnflag WHEN 'A' THEN 'Y' WHEN 'R' THEN '0' ELSE 'maybe' END AS txt FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, coalesce(CASE WHEN lower(txt) IN ('y', '1', 'true', 't', 'yes') THEN true
  WHEN lower(txt) IN ('n', '0', 'false', 'f', 'no') THEN false END, false) AS flag FROM x""",
)
def scalars_bool(t: Tables) -> DataFrame:
    txt = F.when(F.col("l_returnflag") == "A", "Y").when(F.col("l_returnflag") == "R", "0").otherwise("maybe")
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", text.parse_flag(txt).alias("flag")
    )


@query(
    "scalars_tz",
    """SELECT event_id, strftime(ts - INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS phoenix,
  CAST(ts - INTERVAL 7 HOUR AS DATE) AS local_day FROM events""",
)
def scalars_tz(t: Tables) -> DataFrame:
    """Phoenix keeps UTC-7 all year."""
    zone = "America/Phoenix"
    return t.events.select(
        "event_id",
        F.date_format(dates.to_zone(F.col("ts"), zone), "yyyy-MM-dd HH:mm:ss").alias("phoenix"),
        dates.local_day(F.col("ts"), zone).alias("local_day"),
    )


@query(
    "scalars_hash",
    """SELECT event_id, md5(nullif(event_type, 'view')) AS plain, md5(coalesce(nullif(event_type, 'view'), '-1')) AS member,
  md5(CAST(user_id AS VARCHAR)) AS number_key, md5('-1') AS unknown_key FROM events""",
)
def scalars_hash(t: Tables) -> DataFrame:
    e = F.nullif("event_type", F.lit("view"))
    return t.events.select(
        "event_id",
        hashing.surrogate_key(e).alias("plain"),
        hashing.member_key(e).alias("member"),
        hashing.surrogate_key(F.col("user_id")).alias("number_key"),
        hashing.member_key(F.lit(None)).alias("unknown_key"),
    )


@query(
    "scalars_object",
    """SELECT event_id, '{' || concat_ws(',', '"COL1":' || CAST(user_id AS VARCHAR), '"COL2":' || nullif(event_type, 'view'),
  '"COL3":' || strftime(ts, '%Y-%m-%d %H:%M:%S')) || '}' AS obj FROM events""",
)
def scalars_object(t: Tables) -> DataFrame:
    ev = t.events
    members = {
        "COL1": hashing.canonical_text(F.col("user_id"), ev.schema["user_id"].dataType),
        "COL2": F.nullif("event_type", F.lit("view")),
        "COL3": hashing.canonical_text(F.col("ts"), ev.schema["ts"].dataType),
    }
    return ev.select("event_id", hashing.object_text(members).alias("obj"))


@query(
    "scalars_cast",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price_text,
  CAST(o_orderkey AS VARCHAR) AS key_text, CAST(o_orderkey AS DOUBLE) AS key_float,
  CAST(CAST(o_totalprice AS DECIMAL(38,0)) AS BIGINT) AS whole, TRY_CAST(o_orderstatus AS INTEGER) AS no_int FROM orders""",
)
def scalars_cast(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("d"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("price_text"),
        F.col("o_orderkey").cast("string").alias("key_text"),
        F.col("o_orderkey").cast("double").alias("key_float"),
        F.col("o_totalprice").cast("decimal(38,0)").cast("bigint").alias("whole"),
        F.col("o_orderstatus").try_cast("int").alias("no_int"),
    )

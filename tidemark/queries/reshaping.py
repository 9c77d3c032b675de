"""Set operations, pivot, unpivot, tokens, path walk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import reshape
from tidemark.plans import parts as parts_plan
from tidemark.queries.registry import Tables, query


@query(
    "top_n",
    """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 6""",
)
def top_n(t: Tables) -> DataFrame:
    """A top-6 report; the order makes it repeatable."""
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(6)


@query(
    "union_all",
    """SELECT 'C' AS source, c_custkey AS party, c_nationkey AS nation FROM customer
UNION ALL SELECT 'S', s_suppkey, s_nationkey FROM supplier""",
)
def union_all(t: Tables) -> DataFrame:
    c = t.customer.select(F.lit("C").alias("source"), F.col("c_custkey").alias("party"), F.col("c_nationkey").alias("nation"))
    s = t.supplier.select(F.lit("S").alias("source"), F.col("s_suppkey").alias("party"), F.col("s_nationkey").alias("nation"))
    return c.unionByName(s)


@query(
    "union_distinct",
    """SELECT l_partkey AS part_id, CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE l_returnflag = 'A'
UNION SELECT l_partkey, CAST(l_shipdate AS DATE) FROM lineitem WHERE l_returnflag = 'N'""",
)
def union_distinct(t: Tables) -> DataFrame:
    pick = lambda f: t.lineitem.where(F.col("l_returnflag") == f).select(
        F.col("l_partkey").alias("part_id"), F.col("l_shipdate").cast("date").alias("d")
    )
    return pick("A").union(pick("N")).distinct()


@query(
    "minus_prior_batch",
    """SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01'
EXCEPT SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01'""",
)
def minus_prior_batch(t: Tables) -> DataFrame:
    cut = F.lit("2000-01-01").cast("timestamp_ntz")
    cols = ["l_orderkey", "l_partkey", "l_suppkey"]
    li = t.lineitem
    return li.where(F.col("l_shipdate") >= cut).select(*cols).subtract(li.where(F.col("l_shipdate") < cut).select(*cols))


TYPES = {"clicks": "click", "views": "view", "errors": "error", "purchases": "purchase", "signups": "signup"}


@query(
    "pivot_event_types",
    "SELECT user_id, "
    + ", ".join(f"max(CASE WHEN event_type = '{v}' THEN value END) AS {k}" for k, v in TYPES.items())
    + " FROM events GROUP BY 1",
)
def pivot_event_types(t: Tables) -> DataFrame:
    return reshape.pivot_max(t.events, ["user_id"], "event_type", "value", TYPES)


UNPIVOT = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "unpivot_lineitem",
    " UNION ALL ".join(
        f"SELECT l_orderkey, l_partkey, l_linenumber, '{c}' AS measure, nullif({c}, 0) AS amount FROM lineitem WHERE nullif({c}, 0) IS NOT NULL"
        for c in UNPIVOT
    ),
)
def unpivot_lineitem(t: Tables) -> DataFrame:
    """Zeros count as missing and give no row."""
    cols = {c: F.nullif(F.col(c), F.lit(0.0)) for c in UNPIVOT}
    return reshape.unpivot(t.lineitem, ["l_orderkey", "l_partkey", "l_linenumber"], cols, "measure", "amount")


@query(
    "unpivot_pair",
    """SELECT o_orderkey, 'PRICE' AS risk_type, CASE WHEN o_totalprice > 250000 THEN 'High' END AS risk_value, o_orderpriority AS risk_note FROM orders WHERE o_totalprice > 250000
UNION ALL SELECT o_orderkey, 'STATUS', CASE WHEN o_orderstatus = 'P' THEN 'Medium' END, NULL FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT o_orderkey, 'AGE', CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 'Low' END, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'""",
)
def unpivot_pair(t: Tables) -> DataFrame:
    """Risk register: type, value and description from parallel columns."""
    return reshape.unpivot_pair(
        t.orders,
        ["o_orderkey"],
        {
            "PRICE": (F.when(F.col("o_totalprice") > 250000, "High"), F.col("o_orderpriority")),
            "STATUS": (F.when(F.col("o_orderstatus") == "P", "Medium"), F.lit(None).cast("string")),
            "AGE": (
                F.when(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"), "Low"),
                F.col("o_orderstatus"),
            ),
        },
        "risk_type",
        "risk_value",
        "risk_note",
    )


@query(
    "pick_column",
    """SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, CASE l_returnflag WHEN 'A' THEN l_quantity WHEN 'N' THEN l_discount END AS picked
FROM lineitem""",
)
def pick_column(t: Tables) -> DataFrame:
    """A reference value names the column to read; an unknown name reads nothing."""
    picked = reshape.pick_column(F.col("l_returnflag"), {"A": F.col("l_quantity"), "N": F.col("l_discount")})
    return t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", picked.alias("picked"))


@query(
    "explode_tokens",
    r"""SELECT doc_id, token, count(*) AS n FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '[ ,.\n]')) AS token FROM documents)
WHERE token <> '' GROUP BY 1, 2""",
)
def explode_tokens(t: Tables) -> DataFrame:
    """Whole texts to token rows, counted per document."""
    rows = reshape.explode_tokens(t.documents.select("doc_id", "text"), "text", "[ ,.\n]", "token")
    return rows.groupBy("doc_id", "token").agg(F.count("*").alias("n"))


WALK_SQL = """edges AS (SELECT DISTINCT l_partkey AS part, 'S' || (l_suppkey % 10) AS from_site, l_returnflag AS from_stage,
    'S' || ((l_suppkey * 7 + l_linenumber) % 10) AS to_site,
    CASE WHEN l_discount > 0.05 THEN 'BOM' ELSE 'BOD' END AS kind,
    CASE WHEN l_linestatus = 'F' THEN 'A' WHEN l_returnflag = 'A' THEN 'R' ELSE 'N' END AS to_stage FROM lineitem),
seeds AS (SELECT part, max(from_site) AS site, from_stage AS stage FROM edges WHERE kind = 'BOM' GROUP BY part, from_stage)"""


def sample_routes(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Routes between ten sites read off order lines: supplier gives the site, flags the stage."""
    site = lambda c: F.concat(F.lit("S"), (c % 10).cast("string"))
    edges = lines.select(
        F.col("l_partkey").alias("part"),
        site(F.col("l_suppkey")).alias("from_site"),
        F.col("l_returnflag").alias("from_stage"),
        site(F.col("l_suppkey") * 7 + F.col("l_linenumber")).alias("to_site"),
        F.when(F.col("l_linestatus") == "F", "A").when(F.col("l_returnflag") == "A", "R").otherwise("N").alias("to_stage"),
        F.when(F.col("l_discount") > 0.05, "BOM").otherwise("BOD").alias("kind"),
    ).distinct()
    seeds = (
        edges.where(F.col("kind") == "BOM")
        .groupBy("part", F.col("from_stage").alias("stage"))
        .agg(F.max("from_site").alias("site"))
    )
    return edges, seeds


@query(
    "walk_paths",
    f"""WITH RECURSIVE {WALK_SQL},
walk AS (SELECT part, site, stage, stage AS last_stage FROM seeds
  UNION SELECT w.part, e.to_site, e.to_stage, CASE WHEN e.kind = 'BOM' THEN e.to_stage ELSE w.last_stage END
  FROM walk w JOIN edges e ON w.part = e.part AND w.site = e.from_site AND w.stage = e.from_stage)
SELECT part, last_stage, max(stage) AS default_stage, count(*) AS states FROM walk GROUP BY 1, 2""",
)
def walk_paths(t: Tables) -> DataFrame:
    """Supply routes of each part through sites and stages."""
    edges, seeds = sample_routes(t.lineitem)
    return parts_plan.stage_summary(edges, seeds)


ROUTING_SQL = """routing AS (SELECT 'P' || l_partkey AS prod_item,
  CASE l_linenumber WHEN 2 THEN 'C_' || l_suppkey WHEN 3 THEN 'COE_' || l_suppkey WHEN 4 THEN NULL ELSE 'P' || l_partkey END AS consum_item,
  'S' || ((l_suppkey * 7 + l_linenumber) % 4) || '_' || CASE WHEN l_linestatus = 'F' THEN 'A' WHEN l_returnflag = 'A' THEN 'R' ELSE 'N' END AS prod_fclty,
  CASE WHEN l_linenumber = 7 THEN 'ADC' ELSE 'S' || (l_suppkey % 4) || '_' || l_returnflag END AS consum_fclty,
  CASE WHEN l_discount > 0.05 THEN 'R' END AS res_grp, CASE WHEN l_tax < 0.07 THEN 'B' END AS bom_name FROM lineitem),
edges AS (SELECT prod_item, consum_item, CASE WHEN res_grp IS NOT NULL THEN 'BOM' ELSE 'BOD' END AS kind,
  split_part(prod_fclty, '_', 1) AS to_site, split_part(prod_fclty, '_', 2) AS to_stage, split_part(consum_fclty, '_', 1) AS from_site,
  CASE WHEN consum_fclty = 'ADC' THEN 'SGC' ELSE split_part(consum_fclty, '_', 2) END AS from_stage
  FROM routing WHERE bom_name IS NOT NULL AND NOT (res_grp IS NOT NULL AND consum_item IS NULL)),
multi AS (SELECT DISTINCT consum_item AS part, from_stage AS stage FROM edges
  WHERE kind = 'BOM' AND prod_item = consum_item AND to_site = from_site AND to_stage <> from_stage),
moves AS (SELECT * FROM edges e WHERE EXISTS (SELECT 1 FROM multi m WHERE m.part = e.prod_item AND m.stage = e.to_stage)
  OR (kind = 'BOD' AND EXISTS (SELECT 1 FROM multi m WHERE m.part = e.consum_item AND m.stage = e.from_stage))),
seeds AS (SELECT prod_item AS part, to_stage AS stage, max(to_site) AS site FROM moves WHERE kind = 'BOM' AND prod_item <> consum_item GROUP BY 1, 2),
steps AS (SELECT DISTINCT prod_item AS part, from_site, from_stage, to_site, to_stage, kind FROM moves WHERE prod_item = consum_item)"""


@query(
    "master_part_list",
    f"""WITH RECURSIVE {ROUTING_SQL},
walk AS (SELECT part, site, stage, stage AS last_stage FROM seeds
  UNION SELECT w.part, e.to_site, e.to_stage, CASE WHEN e.kind = 'BOM' THEN e.to_stage ELSE w.last_stage END
  FROM walk w JOIN steps e ON w.part = e.part AND w.site = e.from_site AND w.stage = e.from_stage),
listed AS (SELECT 1 AS source_rank, prod_item AS part_id, max(regexp_replace(prod_item, '^[^_]*_', '')) AS base_part_id, 'BOB' AS default_stage
    FROM routing WHERE NOT prod_item LIKE 'COE%' GROUP BY 2
  UNION ALL SELECT 2, consum_item, max(regexp_replace(consum_item, '^[^_]*_', '')), 'BOB' FROM routing WHERE NOT consum_item LIKE 'COE%' GROUP BY 2
  UNION ALL SELECT 3, part || '-' || last_stage, max(part), max(stage) FROM walk GROUP BY 2
  UNION ALL SELECT DISTINCT 4, p_brand, p_brand, NULL FROM part)
SELECT part_id, base_part_id, default_stage, source_rank FROM listed
QUALIFY row_number() OVER (PARTITION BY part_id ORDER BY source_rank, base_part_id) = 1""",
)
def master_part_list(t: Tables) -> DataFrame:
    """Parts of a routing read off order lines, part-stage combinations of multistage parts, and brands known by attributes only."""
    col, text = F.col, lambda c: c.cast("string")
    no, supplier, own = col("l_linenumber"), col("l_suppkey"), F.concat(F.lit("P"), text(col("l_partkey")))
    site = lambda c: F.concat(F.lit("S"), text(c % 4), F.lit("_"))
    to_stage = F.when(col("l_linestatus") == "F", "A").when(col("l_returnflag") == "A", "R").otherwise("N")
    routing = t.lineitem.select(
        own.alias("prod_item"),
        F.when(no == 2, F.concat(F.lit("C_"), text(supplier)))
        .when(no == 3, F.concat(F.lit("COE_"), text(supplier)))
        .when(no != 4, own)
        .alias("consum_item"),
        F.concat(site(supplier * 7 + no), to_stage).alias("prod_fclty"),
        F.when(no == 7, "ADC").otherwise(F.concat(site(supplier), col("l_returnflag"))).alias("consum_fclty"),
        F.when(col("l_discount") > 0.05, "R").alias("res_grp"),
        F.when(col("l_tax") < 0.07, "B").alias("bom_name"),
    )
    return parts_plan.master_part_list(routing, t.part.select(F.col("p_brand").alias("part_id")))

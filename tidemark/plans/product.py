"""Product master, web attributes and classification by trailing window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import dec
from tidemark.operators.joins import merge_sources
from tidemark.operators.reshape import pivot_max
from tidemark.operators.rollup import classify


def product_master(parts: DataFrame, products: DataFrame, documents: DataFrame, kinds: dict[str, str], hidden: Column | None = None) -> DataFrame:
    """Both masters merged, with one column per document kind and a visibility flag.

    ``documents``: ``part_id, kind, title``. Parts with a document are visible unless
    ``hidden`` holds for them.
    """
    both = merge_sources(parts, products, ["part_id"])
    docs = pivot_max(documents, ["part_id"], "kind", "title", kinds)
    shown = F.coalesce(*[F.col(c) for c in kinds]).isNotNull()
    return both.join(docs, "part_id", "left").withColumn(
        "is_web_visible", F.when(shown if hidden is None else shown & ~hidden, "Y").otherwise("N")
    )


# Thresholds of the classification rules (fixed values).
LIMITS = {
    "super_quantity": 50_000_000,
    "super_corps": 500,
    "high_quantity": 10_000_000,
    "high_corps": 100,
    "mid_quantity": 5_000_000,
    "mid_corps": 20,
    "many_corps": 30,
    "few_corps": 4,
}


def classes(
    facts: DataFrame,
    products: DataFrame,
    competitors: DataFrame,
    week: int | None,
    limits: dict[str, int] = LIMITS,
) -> DataFrame:
    """Class of each product from its sales in a trailing window.

    ``facts``: ``product, source, quantity, end_corp, region`` (already limited to the
    window). ``competitors``: ``product, kind, competitor``. ``products``: ``product,
    class_code, is_custom``. Both sides are aggregated before they meet. ``limits`` are
    the thresholds of the rules.
    """
    comp = competitors.groupBy("product").agg(
        F.count_distinct(F.when(F.col("kind") == "Similar", F.col("competitor"))).alias("similar_count"),
        F.count_distinct(F.when(F.col("kind") == "Direct", F.col("competitor"))).alias("direct_count"),
    )
    q = F.coalesce(dec(F.col("quantity")), F.lit(0))
    sales = facts.groupBy("product").agg(
        F.sum(q).alias("total_quantity"),
        F.sum(F.when(F.col("source") == "POS", q)).alias("pos_quantity"),
        F.sum(F.when(F.col("source") == "BILLING", q)).alias("billing_quantity"),
        F.count_distinct("end_corp").alias("end_corp_count"),
        F.count_distinct(F.when(F.col("source") == "POS", F.col("end_corp"))).alias("pos_end_corp_count"),
        F.count_distinct("region").alias("region_count"),
    )
    total, corps = F.col("total_quantity"), F.col("end_corp_count")
    label = classify(
        [
            (F.col("class_code").isin("NP", "KT"), "Non Product"),
            (F.col("is_custom"), "Custom"),
            ((total > limits["super_quantity"]) & (corps > limits["super_corps"]), "Super Commodity"),
            ((total > limits["high_quantity"]) & (corps > limits["high_corps"]), "Commodity 1"),
            (
                (total > limits["mid_quantity"]) & (corps > limits["mid_corps"]) & (F.col("direct_count") >= 1),
                "Commodity 2",
            ),
            (corps >= limits["many_corps"], "Firm - High Cust"),
            (corps <= limits["few_corps"], "Firm - Low Cust"),
            ((total == 0) | total.isNull(), "No 6Mo Revenue"),
        ],
        "Firm",
    )
    zero = F.lit(0)
    return (
        products.join(comp, "product", "left")
        .withColumn("similar_count", F.coalesce("similar_count", zero))
        .withColumn("direct_count", F.coalesce("direct_count", zero))
        .join(sales, "product", "left")
        .select(
            "product",
            F.lit(week).alias("fiscal_week"),
            *[F.col(c).cast("double").alias(c) for c in ("total_quantity", "pos_quantity", "billing_quantity")],
            "end_corp_count", "pos_end_corp_count", "region_count", "similar_count", "direct_count",
            label.alias("classification"),
        )
    )

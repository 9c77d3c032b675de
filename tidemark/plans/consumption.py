"""End-customer consumption: direct billing and discounted POS, by week, then quarter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import start_years_back
from tidemark.operators.rollup import rollup_to

COST_FACTOR = "0.97"
KEYS = ["customer", "product", "source_of_data"]
MEASURES = ["amount", "cost_adjusted", "quantity"]


def weekly(billing: DataFrame, pos: DataFrame, calendar: DataFrame, asof: str, years: int = 5) -> DataFrame:
    """Consumption of the last years by fiscal week.

    ``billing``: ``customer, product, class, day, amount, quantity``, of which
    distributors are left out (their sales arrive as POS). ``pos``: ``customer,
    product, day, cost, quantity``; its adjusted cost is 97 percent.
    """
    start = start_years_back(asof, years)
    own = billing.where(~F.upper("class").isin("DIST", "D3PL", "CIPO")).select(
        "customer", "product", F.lit("BILLING").alias("source_of_data"), "day",
        "amount", F.col("amount").alias("cost_adjusted"), "quantity",
    )
    sold = pos.select(
        "customer", "product", F.lit("POS").alias("source_of_data"), "day",
        F.col("cost").alias("amount"),
        (F.col("cost") * F.lit(COST_FACTOR).cast("decimal(3,2)")).alias("cost_adjusted"),
        "quantity",
    )
    facts = own.unionByName(sold).where(F.col("day") >= start)
    return rollup_to(facts, calendar, "day", "fiscal_week", KEYS, {m: F.col(m) for m in MEASURES}, scale=4)


def quarterly(weeks: DataFrame, calendar: DataFrame) -> DataFrame:
    """The weekly rows summed by the quarter their week belongs to."""
    quarter_of = calendar.select("fiscal_week", "fiscal_quarter").distinct()
    return (
        weeks.join(quarter_of, "fiscal_week")
        .groupBy(*KEYS, "fiscal_quarter")
        .agg(*[F.sum(F.col(m).cast("decimal(24,4)")).cast("double").alias(m) for m in MEASURES])
    )

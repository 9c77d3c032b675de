"""Point-of-sale fact: customer resolution, part cross reference, amounts, billing rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import day
from tidemark.functions.hashing import member_key
from tidemark.operators.joins import enrich, exists_or_absent
from tidemark.operators.matching import Choice, Rule, match_rules


def end_corporation(same_name: Column, end: Column, ship_end: Column, ship: Column, direct: Column) -> Column:
    """Corporation the goods end at; the reported end customer counts only if it is
    not the ship-to customer under another id."""
    return F.when(same_name, F.coalesce(ship_end, ship, direct)).otherwise(F.coalesce(end, ship_end, ship, direct))


def end_corporation_rule(same_name: Column, end: Column, ship_end: Column) -> Column:
    """Label of the rule ``end_corporation`` used (fixed values)."""
    same = F.coalesce(same_name, F.lit(False))
    return (
        F.when(same & ship_end.isNotNull(), "INDEndCorp-ShipEndMatch")
        .when(same, "INDCorp-NoINDEnd-ShipEndMatch")
        .when(end.isNull() & ship_end.isNotNull(), "INDEndCorp-NoPOSEnd")
        .when(end.isNotNull(), "POSEndDefined")
        .otherwise("INDCorp-NoINDEnd")
    )


def resolve_customers(pos: DataFrame, addresses: DataFrame, customers: DataFrame) -> DataFrame:
    """Ship-to and end customers by ``distributor id:direct customer``.

    ``pos``: ``txn_id, product, direct, ship_id, ship_name, end_id, end_name, ship_day,
    quantity, resale, cost, is_var, division``. ``addresses``: ``address, customer``. ``customers``:
    ``customer, corp, end_corp, class``.
    """
    glue = lambda c: F.concat(F.col(c).cast("string"), F.lit(":"), F.col("direct").cast("string"))
    df = pos.withColumn("_same", F.col("ship_name") == F.col("end_name")).drop("ship_name", "end_name")
    # an address names one customer: customers are put to the addresses, which are fewer than the rows
    known = enrich(addresses, [(customers, {"customer": "customer"}, {"_corp": "corp", "_end_corp": "end_corp", "_class": "class"})])
    ship = {"indirect": "customer", "ship_corp": "_corp", "ship_end": "_end_corp", "ship_class": "_class"}
    df = enrich(df.withColumn("_address", glue("ship_id")), [(known, {"_address": "address"}, ship)])
    df = enrich(df.withColumn("_address", glue("end_id")), [(known, {"_address": "address"}, {"own_end": "_corp"})])
    df = enrich(df, [(customers, {"direct": "customer"}, {"direct_corp": "corp", "direct_class": "class"})])
    args = F.col("own_end"), F.col("ship_end")
    return df.withColumn(
        "end_corp", end_corporation(F.col("_same"), *args, F.col("ship_corp"), F.col("direct_corp"))
    ).withColumn("end_corp_rule", end_corporation_rule(F.col("_same"), *args))


def internal_part(df: DataFrame, xref: DataFrame) -> DataFrame:
    """Internal part: rule of the direct customer, of the end corporation, the product's
    default, else the product itself.

    ``xref``: ``product, direct, end_corp, ipn, is_default, from_date, to_date``.
    """
    no_direct, no_corp = F.col("direct").isNull(), F.col("end_corp").isNull()
    rules = [
        Rule({"product": "product", "direct": "direct"}, no_corp),
        Rule({"product": "product", "end_corp": "end_corp"}, no_direct),
        Rule({"product": "product"}, no_direct & no_corp & F.col("is_default")),
    ]
    df = match_rules(df, [Choice("_ipn", xref, "ipn", "from_date", "to_date", rules)], "ship_day")
    return df.withColumn("internal_part", F.coalesce("_ipn", "product")).drop("_ipn")


# Corporations of the contract-manufacturing class whose POS never counts (fixed values).
NON_POS_CORPS = ["PERN", "CRAC", "SNNS", "KSGC", "YYST"]
RETIRED_DIVISION, RETIRED_FROM = "FHS", "2018-06-25"


def is_true_pos(resold: Column, division: Column, ship_day: Column) -> Column:
    """Not a value-added resale, and not a retired division's product shipped after its end."""
    retired = F.coalesce((F.left(division, F.lit(3)) == RETIRED_DIVISION) & (ship_day >= day(RETIRED_FROM)), F.lit(False))
    return ~(F.coalesce(resold, F.lit(False)) | retired)


def counts_as_pos(cls: Column, corp: Column, reports_pos: Column, true_pos: Column) -> Column:
    """Whether a true POS row counts, by class and, for contract manufacturers, the reporting matrix."""
    cipo = cls == "CIPO"
    return (
        F.when(cls.isin("OEM", "EMSI"), F.lit(False))
        .when(cipo & ~reports_pos, F.lit(False))
        .when(cipo & corp.isin(NON_POS_CORPS), F.lit(False))
        .otherwise(true_pos)
    )


def pos_fact(
    pos: DataFrame, billing: DataFrame, addresses: DataFrame, customers: DataFrame, xref: DataFrame, matrix: DataFrame
) -> DataFrame:
    """POS rows plus the billing rows that count as POS.

    Rows shipped to another distributor are left out. ``billing``: ``txn_id, product,
    direct, direct_corp, ship_day, quantity, amount``; it passes where its corporation
    is not in the reporting ``matrix`` (``direct_corp, from_date, to_date, bills, reports_pos``)
    or a valid row allows it.
    """
    # flags first and rows that do not count left out early, so that fewer and narrower rows are shuffled
    pos = pos.withColumn("is_true_pos", is_true_pos(F.col("is_var"), F.col("division"), F.col("ship_day"))).drop("division")
    df = resolve_customers(pos, addresses, customers)
    df = df.where(F.col("ship_class").isNull() | ~F.col("ship_class").isin("DIST", "CIPO", "D3PL"))
    by_corp = [Rule({"direct_corp": "direct_corp"})]
    df = match_rules(df, [Choice("_reports", matrix, "reports_pos", "from_date", "to_date", by_corp)], "ship_day")
    df = internal_part(df, xref)
    sold = df.select(
        "txn_id", "product", "internal_part", "direct", "indirect", "direct_corp", "end_corp", "end_corp_rule", "ship_day",
        "quantity",
        (F.col("resale") * F.col("quantity")).cast("decimal(28,4)").alias("resale_amount"),
        (F.col("cost") * F.col("quantity")).cast("decimal(28,4)").alias("cost_amount"),
        F.lit("POS").alias("source_of_data"),
        "is_true_pos",
        counts_as_pos(F.col("direct_class"), F.col("direct_corp"), F.col("_reports"), F.col("is_true_pos")).alias("counts_as_pos"),
        "is_var",
    )
    allowed = exists_or_absent(billing, matrix, "direct_corp", "ship_day", "from_date", "to_date", F.col("bills"))
    billed = allowed.select(
        "txn_id", "product", F.col("product").alias("internal_part"), "direct", "direct_corp", "ship_day", "quantity",
        F.col("amount").cast("decimal(28,4)").alias("resale_amount"),
        F.col("amount").cast("decimal(28,4)").alias("cost_amount"),
        F.lit("BILLING").alias("source_of_data"),
        F.lit(True).alias("is_true_pos"), F.lit(True).alias("counts_as_pos"), F.lit(False).alias("is_var"),
    )
    both = sold.unionByName(billed, allowMissingColumns=True)
    return both.withColumn("direct_customer_key", member_key(F.col("direct"))).withColumn(
        "end_corp_key", member_key(F.col("end_corp"))
    )

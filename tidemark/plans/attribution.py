"""Customer-attribution bridge: which corporation a sale belongs to, and by which rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import surrogate_key
from tidemark.operators.joins import enrich
from tidemark.operators.matching import Choice, Rule, match_rules

# Business classes and labels are fixed values.
NO_INTEREST = "COIW"


def overrides() -> list[Rule]:
    """Rules of the adjusted and the reference corporation: exact with the indirect customer's
    end corporation, product-wide, exact with its own corporation where it has no other."""
    exact = {"product": "product", "direct": "direct", "indirect": "indirect"}
    named = F.col("indirect").isNotNull()
    return [
        Rule({**exact, "ind_end_corp": "end_corp"}, named),
        Rule({"product": "product"}, ~named),
        Rule({**exact, "_lone_corp": "end_corp"}, named),
    ]


def customer_bridge(
    facts: DataFrame,
    customers: DataFrame,
    interest: DataFrame,
    adjusted: DataFrame,
    allowed_corps: DataFrame,
    custom_products: DataFrame,
    reference: DataFrame,
) -> DataFrame:
    """Direct, indirect, end, adjusted end and reference corporation of each transaction.

    ``facts``: ``txn_id, product, direct, indirect, process_date``.
    ``customers``: ``customer, corp, end_corp, class``.
    ``interest``: ``product, customer, corp, interest, from_date, to_date``, where
    either ``customer`` (customer rule) or ``corp`` (corporation rule) is set.
    ``adjusted``: ``product, direct, indirect, end_corp, adjusted, from_date, to_date``;
    a null ``indirect`` makes a product-wide rule. ``reference``: the same with ``reference``
    instead of ``adjusted``.

    EMSI customers, OEM customers of an allowed corporation, and distributors of a
    custom product use the interest rules, falling back to their own corporation;
    all others use the indirect customer's end corporation, then its corporation.
    """
    direct = (customers, {"direct": "customer"}, {"direct_corp": "corp", "class": "class"})
    indirect = (customers, {"indirect": "customer"}, {"ind_corp": "corp", "ind_end_corp": "end_corp"})
    oem = (allowed_corps.distinct().withColumn("_y", F.lit(True)), {"direct_corp": "corp"}, {"_oem": "_y"})
    cls = F.col("class")
    # what the class says is kept as two flags, so that the rows stay narrow
    df = enrich(facts, [direct, oem]).withColumns(
        {
            "_own": F.coalesce((cls == "EMSI") | ((cls == "OEM") & F.col("_oem").isNotNull()), F.lit(False)),
            "_own_custom": F.coalesce(cls.isin("DIST", "CIPO"), F.lit(False)),
        }
    )
    df = enrich(df.drop("class", "_oem"), [indirect])
    custom = custom_products.distinct().withColumn("_custom", F.lit(True))

    # an indirect customer without an end corporation is looked up by its own
    df = df.withColumn("_lone_corp", F.when(F.col("ind_end_corp").isNull(), F.col("ind_corp")))
    no_customer = F.col("customer").isNull()
    owned = [
        Rule({"product": "product", "direct": "customer"}, ~no_customer),
        Rule({"product": "product", "direct_corp": "corp"}, no_customer),
    ]
    choices = [
        Choice("_coi", interest.where(F.col("interest") != NO_INTEREST), "interest", "from_date", "to_date", owned, rule_out="_coi_rule"),
        Choice("_adjusted", adjusted, "adjusted", "from_date", "to_date", overrides()),
        Choice("_reference", reference, "reference", "from_date", "to_date", overrides()),
    ]
    df = match_rules(df, choices, "process_date", also=custom)
    own = F.col("_own") | (F.col("_own_custom") & F.col("_custom").isNotNull())
    df = df.withColumn("indirect_corp", F.coalesce("ind_end_corp", "ind_corp"))
    df = df.withColumn(
        "end_corp",
        F.when(own, F.coalesce("_coi", "direct_corp")).otherwise(F.col("indirect_corp")),
    )
    label = (
        F.when(F.col("_coi_rule") == 1, "COICustomer")
        .when(F.col("_coi_rule") == 2, "COICorporation")
        .when(F.col("direct_corp").isNotNull(), "NoCOI-Using DIRCoproration")
        .otherwise("Not Defined")
    )
    df = df.withColumn("end_corp_definition", F.when(own, label).otherwise("SUBCorp"))
    df = df.withColumn("adjusted_end_corp", F.coalesce("_adjusted", "end_corp"))
    df = df.withColumn("reference_corp", F.coalesce("_reference", "end_corp"))
    keyed = ["direct_corp", "indirect_corp", "end_corp", "adjusted_end_corp", "reference_corp"]
    return df.select(
        "txn_id", "process_date", *keyed, "end_corp_definition",
        *[surrogate_key(F.col(c)).alias(c + "_key") for c in keyed],
    )

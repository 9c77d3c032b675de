"""Billing fact: process date, sign rules, keys, amounts in three currencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import date_key
from tidemark.functions.hashing import member_key, object_key
from tidemark.functions.numbers import dec
from tidemark.operators import money, timeline

REVERSAL, MANUAL = "REVERSAL", "MANUAL_ADJUSTMENT"


def process_date(date: Column, activity: Column, week_begin: Column, month_begin: Column) -> Column:
    """Move a date up to its fiscal week's start, outside the month's first week.

    Manual adjustments keep their date. With plain dates the shift never moves
    anything, as a day is never before its own week's start; it acts only where
    the calendar row comes from elsewhere.
    """
    shift = (week_begin != month_begin) & (date != week_begin) & (date < week_begin)
    return F.when(F.upper(activity) == MANUAL, date).when(shift, week_begin).otherwise(date)


def signed_measures(
    activity: Column, accrual: Column, quantity: Column, amount: Column, accrual_amount: Column
) -> dict[str, Column]:
    """Gross, net and accrual measures by activity and accrual flag ('Y'/'N').

    Accruals carry no quantity and no gross; reversals negate the quantity and
    take the accrual amount; manual adjustments count in the net only.
    """
    act = F.upper(activity)
    reversal, manual = act == REVERSAL, act == MANUAL
    is_accrual, plain = accrual == "Y", accrual == "N"
    zero = F.lit(0)
    q, a, acc = F.coalesce(quantity, zero), F.coalesce(amount, zero), F.coalesce(accrual_amount, zero)
    return {
        "gross_quantity": F.when(is_accrual | (plain & manual), zero).when(plain & reversal, -q).otherwise(q),
        "net_quantity": F.when(is_accrual, zero).when(plain & (reversal | manual), -q).otherwise(q),
        "gross_amount": F.round(
            F.when(is_accrual | (plain & manual), zero).when(plain & reversal, acc).otherwise(a), 2
        ),
        "net_amount": F.round(F.when(manual | reversal, acc).when(is_accrual, -acc).otherwise(a), 2),
        "accrual_amount": F.round(F.when(reversal, zero).when(manual, acc).otherwise(-acc), 2),
    }


def billing_fact(
    staging: DataFrame,
    orders: DataFrame,
    calendar: DataFrame,
    rates: DataFrame,
    second: tuple[str, str],
    third: tuple[str, str],
) -> DataFrame:
    """Fact rows from deduplicated billing lines.

    ``staging``: ``order_id, line_no, product, seller, quantity, unit_amount,
    discount, activity, accrual, ship_day``. ``orders``: ``order_id, customer,
    currency``. ``second``/``third`` are (output name, currency).

    Repeats of an order line are numbered and the number is part of the key. The
    numbering runs on (order, line), cut into ranges, after exact copies
    have been counted, so neither a huge order nor a huge group of copies meets in one
    task; the order join is an equi join that splits under skew.
    """
    order = ["ship_day", "product", "seller", "quantity", "unit_amount", "discount", "activity", "accrual"]
    lines = timeline.copy_ordinal(
        staging, ["order_id", "line_no"], order, "dup_no", ranged=True
    )
    df = lines.join(orders, "order_id", "left")
    cal = calendar.select(
        F.col("calendar_date").alias("ship_day"),
        F.col("fiscal_week_begin_date").alias("_wb"),
        F.col("fiscal_month_begin_date").alias("_mb"),
        "fiscal_week",
    )
    df = df.join(cal, "ship_day", "left").withColumn(
        "process_date", process_date(F.col("ship_day"), F.col("activity"), F.col("_wb"), F.col("_mb"))
    )
    amount = dec(F.col("unit_amount"))
    accrual = F.round(amount * dec(F.col("discount")), 2)
    measures = signed_measures(
        F.col("activity"), F.col("accrual"), dec(F.col("quantity")), amount, accrual
    )
    df = df.select("*", *[dec(c).alias(n) for n, c in measures.items()])
    df = df.withColumn("_month", F.date_format("process_date", "yyyyMM").cast("int"))
    df = money.convert_amounts(
        df, rates, "net_amount", "_month", "currency", {second[0]: second[1], third[0]: third[1]}
    )
    key = {f"COL{i + 1}": F.col(c) for i, c in enumerate(["order_id", "line_no", "dup_no", "process_date"])}
    return df.select(
        object_key(key).alias("billing_key"),
        member_key(F.col("customer")).alias("customer_key"),
        member_key(F.col("product")).alias("product_key"),
        date_key(F.col("process_date")).alias("process_date_key"),
        "fiscal_week",
        *[F.col(n).cast("double").alias(n) for n in (*measures, second[0], third[0])],
    )

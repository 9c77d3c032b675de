"""Backlog fact: delinquency, accrual signs, booking window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import clamp_date, day

ACCRUAL = "BACKLOG_ACCRUAL"
BOOKING_DAYS = 92
# Business classes whose lines are never bookings, and the date that stands for none.
NO_BOOKING = ("OMD", "INT-SPS")
NO_DATE = "0001-01-01"


def late(date: Column, asof: Column) -> Column:
    """Y when a known date has passed."""
    return F.when(date <= asof, F.lit("Y")).otherwise(F.lit("N"))


def backlog_amounts(activity: Column, amount: Column, accrual: Column, quantity: Column) -> dict[str, Column]:
    """Gross, net and quantity: an accrual row has only a negative net."""
    is_accrual = F.coalesce(F.upper(activity), F.lit("")) == ACCRUAL
    zero = F.lit(0)
    return {
        "gross_amount": F.when(is_accrual, zero).otherwise(F.coalesce(amount, zero)),
        "net_amount": F.when(is_accrual, -F.coalesce(accrual, zero)).otherwise(F.coalesce(amount, zero)),
        "net_quantity": F.when(is_accrual, zero).otherwise(F.coalesce(quantity, zero)),
    }


def booking(business_class: Column, quantity: Column, requested: Column, scheduled: Column, asof: Column) -> Column:
    """Y for open lines due within the window after ``asof``, by the requested date or else the scheduled one."""
    end = F.date_add(asof, BOOKING_DAYS)
    barred = F.coalesce(business_class.isin(*NO_BOOKING), F.lit(False)) | (F.coalesce(quantity, F.lit(0)) == 0)
    due = F.coalesce(requested, scheduled) <= end
    return F.when(~barred & F.coalesce(due, F.lit(False)), F.lit("Y")).otherwise(F.lit("N"))


def backlog_fact(forecast: DataFrame, firm: DataFrame, asof: str) -> DataFrame:
    """Open lines of both demand types with their flags.

    Columns of both: ``line_id, business_class, activity, amount, accrual, quantity,
    requested, scheduled, promised``. The date that stands for none is missing; missing
    and ancient dates are clamped in the output.
    """
    both = forecast.withColumn("demand_type", F.lit("FORECAST")).unionByName(
        firm.withColumn("demand_type", F.lit("ORDER"))
    )
    now = day(asof)
    names = ("requested", "scheduled", "promised")
    both = both.withColumns({c: F.nullif(F.col(c), day(NO_DATE)) for c in names})
    dates = {c: clamp_date(F.col(c), "1992-01-01", "1960-01-01") for c in names}
    measures = backlog_amounts(F.col("activity"), F.col("amount"), F.col("accrual"), F.col("quantity"))
    return both.select(
        "line_id",
        "demand_type",
        *[c.cast("double").alias(n) for n, c in measures.items()],
        *[c.alias(n + "_date") for n, c in dates.items()],
        *[late(F.col(n), now).alias(f"is_{n}_late") for n in dates],
        booking(*[F.col(c) for c in ("business_class", "quantity", "requested", "scheduled")], now).alias("is_booking"),
    )

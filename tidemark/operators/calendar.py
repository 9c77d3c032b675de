"""Fiscal and Gregorian calendar, period dimensions, minutes of the day.

A calendar has one row per day, so its windows (a week, month, quarter or year of
days) are small whatever the size of the facts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import date_key, day, last_of
from tidemark.session import broadcast_bounded
from tidemark.sources.tables import generate_rows


def day_spine(df: DataFrame, date: str, out: str = "calendar_date") -> DataFrame:
    """Every day from the first to the last date of ``df``."""
    span = df.agg(F.min(F.col(date).cast("date")).alias("lo"), F.max(F.col(date).cast("date")).alias("hi"))
    return span.select(F.explode(F.sequence("lo", "hi")).alias(out))


def fiscal_days(spine: DataFrame, date: str = "calendar_date") -> DataFrame:
    """Fiscal keys of each day: 52 weeks a year, quarters of 13 weeks, months of 4-4-5.

    Used where no fiscal calendar table is supplied. Days after week 52 stay in it.
    """
    d = F.col(date)
    week = F.least(F.floor((F.dayofyear(d) - 1) / 7) + 1, F.lit(52)).cast("int")
    quarter = (F.floor((F.col("_wk") - 1) / 13) + 1).cast("int")
    in_quarter = F.col("_wk") - 1 - (F.col("_q") - 1) * 13
    month = (F.col("_q") - 1) * 3 + F.when(in_quarter < 4, 1).when(in_quarter < 8, 2).otherwise(3)
    return (
        spine.withColumn("fiscal_year", F.year(d))
        .withColumn("_wk", week)
        .withColumn("_q", quarter)
        .withColumn("fiscal_week", F.col("fiscal_year") * 100 + F.col("_wk"))
        .withColumn("fiscal_month", F.col("fiscal_year") * 100 + month)
        .withColumn("fiscal_quarter", F.col("fiscal_year") * 10 + F.col("_q"))
        .drop("_wk", "_q")
    )


PERIODS = ("week", "month", "quarter", "year")


def _prior(c: Column, base: int, last: int, year: Column) -> Column:
    """Key of the period before; the first one of a year goes to the last of the year before."""
    return F.when(c % base == 1, (year - 1) * base + last).otherwise(c - 1)


def with_sequences(days: DataFrame) -> DataFrame:
    """Running numbers of the fiscal periods since 1970."""
    fy = F.col("fiscal_year")
    return (
        days.withColumn("fiscal_week_sequence", 52 * (fy - 1970) + F.col("fiscal_week") % 100 - 1)
        .withColumn("fiscal_month_sequence", 12 * (fy - 1970) + F.col("fiscal_month") % 100 - 1)
        .withColumn("fiscal_quarter_sequence", 4 * (fy - 1970) + F.col("fiscal_quarter") % 10 - 1)
        .withColumn("fiscal_year_sequence", fy - 1970)
    )


def _cycle(c: Column, n: int) -> Column:
    """1 .. n repeating, where a multiple of n is n."""
    return F.when(c % n == 0, F.lit(n)).otherwise(c % n)


def fiscal_calendar(days: DataFrame) -> DataFrame:
    """All calendar attributes of each day.

    Input: ``calendar_date, fiscal_year, fiscal_week, fiscal_month, fiscal_quarter``.
    The week before week 1 is week 52 of the year before.
    """
    d = F.col("calendar_date")
    out = (
        with_sequences(days).withColumn("date_key", date_key(d))
        .withColumn("day_of_week_short", F.date_format(d, "EEE"))
        .withColumn("day_of_week", F.date_format(d, "EEEE"))
        .withColumn("is_weekday", ~F.dayofweek(d).isin(1, 7))
        .withColumn("is_weekend", F.dayofweek(d).isin(1, 7))
        .withColumn("date_sequence", F.datediff(d, day("1970-01-01")))
        .withColumn("day_in_month", F.dayofmonth(d))
        .withColumn("day_in_quarter", F.datediff(d, F.trunc(d, "quarter")) + 1)
        .withColumn("day_in_year", F.dayofyear(d))
        .withColumn("month_key", F.date_format(d, "yyyyMM").cast("int"))
        .withColumn("month_label", F.concat(F.year(d).cast("string"), F.lit("M"), F.month(d).cast("string")))
        .withColumn("month_name_short", F.date_format(d, "MMM"))
        .withColumn("month_name", F.date_format(d, "MMMM"))
        .withColumn("month_in_quarter", _cycle(F.month(d), 3))
        .withColumn("month_in_year", F.month(d))
        .withColumn("quarter_key", F.year(d) * 10 + F.quarter(d))
        .withColumn("quarter_label", F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string")))
        .withColumn("quarter_description", F.concat(F.lit("Q"), F.quarter(d).cast("string")))
        .withColumn("month_sequence", (F.year(d) - 1970) * 12 + F.month(d) - 1)
        .withColumn("quarter_in_year", F.quarter(d))
        .withColumn("quarter_sequence", (F.year(d) - 1970) * 4 + F.quarter(d) - 1)
        .withColumn("year_key", F.year(d))
        .withColumn("year_description", F.concat(F.lit("CY"), F.year(d).cast("string")))
        .withColumn("year_sequence", F.year(d) - 1970)
        .withColumns({"total_months_in_quarter": F.lit(3), "total_months_in_year": F.lit(12)})
        .withColumn("total_quarters_in_year", F.lit(4))
    )
    for unit in ("month", "quarter", "year"):
        out = (
            out.withColumn(f"{unit}_begin_date", F.trunc(d, unit))
            .withColumn(f"{unit}_end_date", last_of(d, unit))
            .withColumn(f"total_days_in_{unit}", F.datediff(last_of(d, unit), F.trunc(d, unit)) + 1)
        )
    for p in PERIODS:
        w = Window.partitionBy(f"fiscal_{p}")
        begin, end = f"fiscal_{p}_begin_date", f"fiscal_{p}_end_date"
        out = (
            out.withColumn(begin, F.min(d).over(w))
            .withColumn(end, F.max(d).over(w))
            .withColumn(f"total_days_in_fiscal_{p}", F.datediff(end, begin) + 1)
            .withColumn(f"is_begin_fiscal_{p}", d == F.col(begin))
            .withColumn(f"is_end_fiscal_{p}", d == F.col(end))
            .withColumn(f"day_in_fiscal_{p}", F.rank().over(w.orderBy("calendar_date")))
        )
    wk = F.col("fiscal_week") % 100
    for part, whole in (("week", "month"), ("week", "quarter"), ("week", "year"), ("month", "quarter"), ("month", "year")):
        held = F.collect_set(f"fiscal_{part}").over(Window.partitionBy(f"fiscal_{whole}"))
        out = out.withColumn(f"total_fiscal_{part}s_in_fiscal_{whole}", F.size(held))
    total = F.col("total_fiscal_weeks_in_fiscal_month")
    fy = F.col("fiscal_year")
    out = (
        out.withColumn("fiscal_week_number", wk)
        .withColumn("fiscal_week_in_fiscal_month", F.when(wk % total == 0, total).otherwise(wk % total))
        .withColumn("fiscal_week_in_fiscal_quarter", _cycle(wk, 13))
        # Weeks to go, counted from the end of the quarter after this one and the next.
        .withColumn("crawl_week_in_fiscal_quarter", _cycle(wk, 13))
        .withColumn("crawl_week_in_fiscal_quarter_plus_1", _cycle(wk, 13) - 13)
        .withColumn("crawl_week_in_fiscal_quarter_plus_2", _cycle(wk, 13) - 26)
        .withColumn("fiscal_month_number", F.col("fiscal_month") % 100)
        .withColumn("fiscal_month_in_fiscal_quarter", _cycle(F.col("fiscal_month") % 100, 3))
        .withColumn(
            "fiscal_month_description",
            F.concat(
                F.date_format(F.to_date(F.col("fiscal_month").cast("string"), "yyyyMM"), "MMM"),
                F.substring(F.col("fiscal_month").cast("string"), 3, 2),
            ),
        )
        .withColumn("fiscal_quarter_number", F.col("fiscal_quarter") % 10)
        .withColumn("fiscal_quarter_yyyyqq", fy * 100 + F.col("fiscal_quarter") % 10)
        .withColumn(
            "fiscal_quarter_description",
            F.concat(
                F.lit("Q"),
                F.substring(F.col("fiscal_quarter").cast("string"), 5, 1),
                F.substring(F.col("fiscal_quarter").cast("string"), 3, 2),
            ),
        )
        .withColumn("fiscal_quarter_prior_year", F.col("fiscal_quarter") - 10)
        .withColumn("fiscal_week_prior", _prior(F.col("fiscal_week"), 100, 52, fy))
        .withColumn("fiscal_month_prior", _prior(F.col("fiscal_month"), 100, 12, fy))
        .withColumn("fiscal_quarter_prior", _prior(F.col("fiscal_quarter"), 10, 4, fy))
        .withColumn("fiscal_year_prior", fy - 1)
    )
    for p in ("week", "month", "quarter"):
        bounds = days.groupBy(F.col(f"fiscal_{p}").alias(f"fiscal_{p}_prior")).agg(
            F.min("calendar_date").alias(f"fiscal_{p}_prior_begin_date"),
            F.max("calendar_date").alias(f"fiscal_{p}_prior_end_date"),
        )
        out = out.join(bounds, f"fiscal_{p}_prior", "left")
    near = period_offsets(
        with_sequences(days),
        "fiscal_quarter",
        "fiscal_quarter_sequence",
        {
            **{f"fiscal_quarter_minus_{k}": -k for k in (4, 3, 2, 1)},
            **{f"fiscal_quarter_plus_{k}": k for k in (1, 2, 3, 4)},
        },
    )
    return out.join(near.drop("fiscal_quarter_sequence"), "fiscal_quarter", "left")


def period_offsets(
    calendar: DataFrame, period: str, sequence: str, offsets: Mapping[str, int]
) -> DataFrame:
    """Keys of the periods n before or after each period, by sequence number.

    The distinct periods become one map (sequence -> key, four to fifty-two entries
    a year) read as a scalar, so any number of offsets costs one small aggregate and
    no join. A period missing from the calendar gives null.
    """
    periods = calendar.select(period, sequence).distinct()
    keys = periods.agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(sequence).cast("int"), F.col(period)))).alias("m")
    ).scalar()
    return periods.select(
        "*", *[F.try_element_at(keys, (F.col(sequence) + k).cast("int")).alias(name) for name, k in offsets.items()]
    )


def distinct_dim(calendar: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A coarser period dimension."""
    return calendar.select(*columns).distinct()


YEAR_AGO = {"week": 52, "month": 12, "quarter": 4, "year": 1}


def relative_flags(calendar: DataFrame, asof: str, periods: Sequence[str] = PERIODS) -> DataFrame:
    """Whether a day's fiscal period is the current one, the one before, or the same one
    a year earlier, seen from ``asof``; told apart by the period sequence numbers.

    The reference day is one row and is read as a scalar subquery.
    """
    names = [f"fiscal_{p}_sequence" for p in periods]
    ref = calendar.where(F.col("calendar_date") == day(asof)).select(F.struct(*names)).scalar()
    out = calendar
    for p, name in zip(periods, names, strict=True):
        seq, now = F.col(name), ref.getField(name)
        out = out.withColumn(f"is_current_fiscal_{p}", seq == now).withColumn(f"is_prior_fiscal_{p}", seq == now - 1)
        if p != "year":
            out = out.withColumn(f"is_prior_fiscal_year_current_fiscal_{p}", seq == now - YEAR_AGO[p])
    return out


def calendar_period_flags(calendar: DataFrame, asof: str) -> DataFrame:
    """Whether a day, or its month, quarter or year, is the current or the prior one seen
    from ``asof``, and whether its month or quarter is the current one of a year earlier.

    Needs ``calendar_date`` only; ``asof`` need not be in the calendar.
    """
    d, now = F.col("calendar_date"), day(asof)
    months = (F.year(now) - F.year(d)) * 12 + F.month(now) - F.month(d)
    quarters = (F.year(now) - F.year(d)) * 4 + F.quarter(now) - F.quarter(d)
    years, days = F.year(now) - F.year(d), F.datediff(now, d)
    out = calendar
    for p, back in (("day", days), ("month", months), ("quarter", quarters), ("year", years)):
        out = out.withColumn(f"is_current_{p}", back == 0).withColumn(f"is_prior_{p}", back == 1)
    for p, back in (("month", months), ("quarter", quarters)):
        out = out.withColumn(f"is_prior_year_current_{p}", back == YEAR_AGO[p])
    return out


def keep_recent_years(df: DataFrame, key: str, years: int = 2) -> DataFrame:
    """Rows whose YYYYWW key is in the last fiscal years, by arithmetic on the newest key."""
    top = df.agg(F.max(key)).scalar()
    floor = F.floor((top - years * 100) / 100) * 100
    return df.where(F.col(key) >= floor)


def minutes_of_day(spark: SparkSession) -> DataFrame:
    """1440 rows with 12 and 24 hour labels, day part and day/night."""
    n = F.col("n")
    hour, minute = F.floor(n / 60).cast("int"), (n % 60).cast("int")
    h12 = _cycle(hour, 12).cast("int")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    half = F.when(hour >= 12, F.lit("PM")).otherwise(F.lit("AM"))
    part = (
        F.when(hour < 5, "Early Morning").when(hour < 12, "Morning").when(hour < 18, "Afternoon").otherwise("Evening")
    )
    return broadcast_bounded(generate_rows(spark, 1440), 1440).select(
        (hour * 10000 + minute * 100).alias("time_key"),
        (n + 1).cast("int").alias("minute_of_day"),
        hour.alias("hour_24"),
        h12.alias("hour_12"),
        minute.alias("minute"),
        F.concat(two(hour), F.lit(":"), two(minute)).alias("label_24"),
        F.concat(two(h12), F.lit(":"), two(minute), F.lit(" "), half).alias("label_12"),
        (h12 * 100 + minute).alias("hour_12_minute_code"),
        (hour >= 12).alias("is_pm"),
        part.alias("day_part"),
        F.when(hour.between(6, 17), "Day").otherwise("Night").alias("day_night"),
    )

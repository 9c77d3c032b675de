"""Project reporting: summary, schedule, issues, risk burn-down, cost curve."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.hashing import object_key
from tidemark.functions.text import matches_fully
from tidemark.operators.joins import enrich, expand_periods
from tidemark.operators.reshape import pick_column, unpivot_pair


def unit_code(name: Column) -> Column:
    """Two-letter business-unit code: in front of `` - ``, else before the last character."""
    return F.when(matches_fully(name, r"[a-zA-Z1-9]{2}\s-.*"), F.left(name, F.lit(2))).otherwise(
        F.left(F.right(name, F.lit(3)), F.lit(2))
    )


def summary(
    projects: DataFrame, groups: DataFrame, divisions: DataFrame, costs: DataFrame, week: Column
) -> DataFrame:
    """Project attributes with group, remapped division, unit code and cost object.

    ``projects``: ``project, name, division, unit``. The lookups have one row per key:
    ``groups`` (project, group), ``divisions`` (old, new, code), ``costs`` (project,
    cost_object). ``week`` is the current week as a scalar.
    """
    df = enrich(
        projects,
        [
            (groups, {"project": "project"}, {"group": "group"}),
            (divisions, {"division": "old"}, {"new_division": "new", "division_code": "code"}),
            (costs, {"project": "project"}, {"cost_object": "cost_object"}),
        ],
    ).withColumn("snapshot_week_key", week)
    return df.select(
        object_key({"COL1": F.col("snapshot_week_key"), "COL2": F.col("project")}).alias("project_summary_key"),
        "snapshot_week_key", "project", "name", "group",
        F.coalesce("new_division", "division").alias("division_name"),
        "division_code",
        unit_code(F.col("unit")).alias("unit_code"),
        "cost_object",
    )


DATE_KINDS = ("os", "cs", "forecast", "actual")
TAPEOUT = "TAPEOUT"


def schedule(dates: DataFrame, steps: DataFrame, ref: Sequence[Mapping[str, object]]) -> DataFrame:
    """Original, current, forecast and actual date of every project step, in order.

    ``dates``: one row per project with many date columns. ``steps``: ``project, step,
    status``, one row per project and step. ``ref`` says per step which date column to
    read (or none) and its place. Tape-out steps are placed after the last other step
    dated no later. A project has at most as many rows as ``ref``, so its window is small.
    """
    df = steps.join(dates, "project")
    name = F.col("step")
    for kind in DATE_KINDS:
        picks = {r["step"]: F.col(r[kind]) for r in ref if r[kind]}
        df = df.withColumn(f"{kind}_date", pick_column(name, picks).cast("date"))
    place = pick_column(name, {r["step"]: F.lit(r["sort_order"]) for r in ref})
    tapeout = F.upper(name).like(TAPEOUT + "%")
    df = df.withColumn("_own", F.when(~tapeout, place)).withColumn("_late", tapeout.cast("int"))
    line = Window.partitionBy("project").orderBy("cs_date", "_late").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    upto = F.max(F.when(F.col("cs_date").isNotNull(), F.col("_own"))).over(line)
    df = df.withColumn("_place", F.when(tapeout, F.when(F.col("cs_date").isNotNull(), upto)).otherwise(F.col("_own")))
    order = Window.partitionBy("project").orderBy(
        F.col("_place").asc_nulls_last(), F.col("cs_date").asc_nulls_last(), F.col("step").asc()
    )
    return df.select(
        "project", "step", "status", *[f"{k}_date" for k in DATE_KINDS], F.row_number().over(order).alias("sort_order")
    )


def created_vs_resolved(gates: DataFrame, weeks: DataFrame, issues: DataFrame) -> DataFrame:
    """Issues created, resolved and open per project and week between two gates.

    ``gates``: ``project, first_no, last_no``; ``weeks``: ``week_no, week`` numbered
    without gaps; ``issues``: ``project, created_week, resolved_week``. An issue belongs
    to its creation week and its resolution week. Instead of an OR join each
    pre-aggregated issue row is repeated for its one or two weeks.
    """
    counted = issues.groupBy("project", "created_week", "resolved_week").agg(F.count("*").alias("n"))
    touched = counted.withColumn(
        "week", F.explode(F.array_compact(F.array_distinct(F.array("created_week", "resolved_week"))))
    )
    made, done = F.col("created_week").isNotNull(), F.col("resolved_week").isNotNull()
    per_week = touched.groupBy("project", "week").agg(
        F.sum(F.when(made, F.col("n"))).alias("created"),
        F.sum(F.when(done, F.col("n"))).alias("resolved"),
        F.sum(F.when(made & ~done, F.col("n"))).alias("open"),
    )
    # An inverted pair of gates has no weeks; sequence would count backwards.
    ordered = gates.where(F.col("first_no") <= F.col("last_no"))
    range_ = ordered.select("project", F.explode(F.sequence("first_no", "last_no")).alias("week_no")).join(weeks, "week_no")
    zero = F.lit(0).cast("bigint")
    return range_.join(per_week, ["project", "week"], "left").select(
        "project",
        F.col("week").alias("issue_week_key"),
        F.coalesce("created", zero).alias("created_issues"),
        F.coalesce("resolved", zero).alias("resolved_issues"),
        F.coalesce("open", zero).alias("open_issues"),
    )


def risk_burndown(risks: DataFrame, mitigations: DataFrame) -> DataFrame:
    """Risk score of a project per month.

    ``risks``: ``project, risk, score, start_month``. ``mitigations``: ``project, risk,
    finish_month, rank, score``; of several in one month the largest ``rank`` counts.
    Only risks with a mitigation take part. A risk shows its own score from the
    project's first month until its first mitigation, then the newest mitigated score
    (or its own again after a mitigation to zero).

    The monthly rows of every risk are never built. Each risk only emits the months
    its score changes; the changes are summed per project and month, added up, and
    each sum is held until the next change.
    """
    mits = mitigations.groupBy("project", "risk", "finish_month").agg(F.max_by("score", "rank").alias("mit"))
    spans = (
        risks.groupBy("project").agg(F.min("start_month").alias("first_month"))
        .join(mitigations.groupBy("project").agg(F.max("finish_month").alias("last_month")), "project")
    )
    steps = (
        mits.join(risks.select("project", "risk", "score"), ["project", "risk"])
        .join(spans, "project")
    )
    w = Window.partitionBy("project", "risk").orderBy("finish_month")  # at most one row a month
    # A mitigation finished before the project's first month is not seen by any month.
    early = F.col("finish_month") < F.col("first_month")
    after = F.when(early | (F.col("mit") == 0), F.col("score")).otherwise(F.col("mit"))
    at = F.when(F.col("finish_month") == F.col("first_month"), F.col("score")).otherwise(F.col("mit"))
    steps = (
        steps.withColumn("_after", after)
        .withColumn("_at", at)
        .withColumn("_before", F.lag("_after").over(w))
        .withColumn("_was", F.coalesce("_before", F.col("score")))
    )

    def change(month: Column, d: Column) -> Column:
        return F.struct(month.alias("month"), d.cast("bigint").alias("d"))

    emitted = F.array(
        # The first mitigation of a risk also brings in its score from the project's start.
        F.when(F.col("_before").isNull(), change(F.col("first_month"), F.col("score"))),
        F.when(~early, change(F.col("finish_month"), F.col("_at") - F.col("_was"))),
        F.when(~early, change(F.add_months("finish_month", 1), F.col("_after") - F.col("_at"))),
    )
    deltas = (
        steps.select("project", "last_month", F.explode(F.array_compact(emitted)).alias("e"))
        .select("project", "last_month", "e.*")
        .where(F.col("month") <= F.col("last_month"))
        .groupBy("project", "month")
        .agg(F.sum("d").alias("d"), F.max("last_month").alias("last_month"))
    )
    line = Window.partitionBy("project").orderBy("month")  # at most one row a month
    held = deltas.select(
        "project",
        "month",
        F.sum("d").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("risk_score"),
        F.coalesce(F.add_months(F.lead("month").over(line), -1), F.col("last_month")).alias("_until"),
    )
    return expand_periods(held, "month", "_until", "process_date", "month").select(
        "project", "process_date", "risk_score"
    )


def cost_curve(wide: DataFrame, periods: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Running monthly cost from quarterly columns.

    ``periods`` maps a period name to its (quarter label ``YYYY-0q``, cost) columns.
    A quarter's cost is spread evenly over its three months; periods of the same month
    are added together.
    """
    rows = unpivot_pair(wide, ["project"], periods, "period", "quarter", "cost")
    year, quarter = F.left("quarter", F.lit(4)).try_cast("int"), F.right("quarter", F.lit(2)).try_cast("int")
    monthly = rows.where(year.isNotNull() & quarter.isNotNull()).select(
        "project", "period", "cost",
        F.explode(
            F.transform(F.sequence(F.lit(0), F.lit(2)), lambda k: F.make_date(year, (quarter - 1) * 3 + k + 1, F.lit(1)))
        ).alias("process_date"),
    )
    w = Window.partitionBy("project").orderBy("process_date").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return monthly.select("project", "period", "process_date", (F.sum("cost").over(w) / 3).alias("running_cost"))

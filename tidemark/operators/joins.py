"""Joins beyond the plain equi join.

None of these forms hints a broadcast: the planner broadcasts a side only when
its size statistics (or, at run time, its shuffle output) are under the
configured threshold, and otherwise runs a shuffle join whose hot partitions
adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import timeline
from tidemark.operators.skew import attach, spread


def enrich(
    df: DataFrame, lookups: Sequence[tuple[DataFrame, Mapping[str, str], Mapping[str, str]]]
) -> DataFrame:
    """Chain of left lookups.

    Each lookup is ``(dim, on, columns)``: ``on`` maps fact column to dimension
    key, ``columns`` maps output name to dimension column. Dimension keys are
    unique, so no row is multiplied.
    """
    for i, (dim, on, columns) in enumerate(lookups):
        names = {f"_k{i}_{j}": (l, r) for j, (l, r) in enumerate(on.items())}
        side = dim.select(
            *[F.col(r).alias(k) for k, (_, r) in names.items()],
            *[F.col(src).alias(out) for out, src in columns.items()],
        )
        df = _attach_on(df, side, {l: k for k, (l, _) in names.items()})
    return df


def _attach_on(
    df: DataFrame, side: DataFrame, on: Mapping[str, str], when: Column | None = None
) -> DataFrame:
    """Left join to a side with one row per key under other names; its key columns are dropped.

    See ``skew`` for why the key's hash takes part in the join.
    """
    left = df.select("*", spread(list(on)).alias("_lh"))
    right = side.select("*", spread(list(on.values())).alias("_rh"))
    cond = _all([F.col(l) == F.col(r) for l, r in on.items()] + [F.col("_lh") == F.col("_rh")])
    return left.join(right, cond if when is None else cond & when, "left").drop("_lh", "_rh", *on.values())


def _all(conds: Sequence[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def merge_sources(
    first: DataFrame,
    second: DataFrame,
    keys: Sequence[str],
    prefer_second: Sequence[str] = (),
) -> DataFrame:
    """Full outer merge of two masters, column by column.

    A column in both takes the first source's value unless it is listed in
    ``prefer_second``; the other source fills nulls.
    """
    keys = list(keys)
    a = first.select(*[F.col(c).alias(c if c in keys else "_a_" + c) for c in first.columns])
    b = second.select(*[F.col(c).alias(c if c in keys else "_b_" + c) for c in second.columns])
    both = a.join(b, keys, "full_outer")
    out: list[Column] = [F.col(k) for k in keys]
    for c in dict.fromkeys([*first.columns, *second.columns]):
        if c in keys:
            continue
        sides = [F.col(p + c) for p, d in (("_a_", first), ("_b_", second)) if c in d.columns]
        if c in prefer_second:
            sides.reverse()
        out.append(F.coalesce(*sides).alias(c))
    return both.select(*out)


def precedence_union(sources: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Rows of each source whose key no earlier source has.

    Keys with a null part never block a later source (unlike ``NOT IN``, where
    one null would drop every row).
    """
    keys = list(keys)
    out, taken = sources[0], sources[0].select(*keys)
    for s in sources[1:]:
        out = out.unionByName(attach(s, taken.distinct(), keys, "left_anti"), allowMissingColumns=True)
        taken = taken.unionByName(s.select(*keys))
    return out


def date_span(facts: DataFrame, date: str) -> Column:
    """First and last date of the facts, as a scalar struct ``lo, hi``.

    Compute it once and hand it to every lookup on the same facts.
    """
    d = F.col(date).cast("date")
    return facts.agg(F.struct(F.min(d).alias("lo"), F.max(d).alias("hi"))).scalar()


STEPS = {"month": "INTERVAL 1 MONTH", "quarter": "INTERVAL 3 MONTH", "year": "INTERVAL 1 YEAR"}


def join_effective(
    facts: DataFrame,
    ref: DataFrame,
    on: Sequence[str],
    date: str,
    start: str,
    end: str,
    columns: Sequence[str],
    *,
    how: str = "left",
    unit: str = "month",
    span: Column | None = None,
) -> DataFrame:
    """Join each fact to the reference rows valid on its date.

    ``on`` are columns of both sides. A range predicate alone would compare every
    fact of a key with every version of that key. Here a version is repeated for
    the calendar periods it covers, clipped to the span of the facts, and the
    period joins the equality keys; the exact bounds are checked on the few
    candidates left. A key with a long history is thereby spread over its periods.
    """
    return _join_periods(facts, clip(ref, start, end, span if span is not None else date_span(facts, date)),
                         on, date, start, end, columns, how, unit)


def clip(ref: DataFrame, start: str, end: str, span: Column) -> DataFrame:
    """Reference rows cut to a date span; rows outside it are dropped."""
    out = ref.withColumn(start, F.greatest(F.col(start).cast("date"), span.getField("lo"))).withColumn(
        end, F.least(F.col(end).cast("date"), span.getField("hi"))
    )
    return out.where(F.col(start) <= F.col(end))


def _join_periods(facts, ref, on, date, start, end, columns, how, unit) -> DataFrame:
    on = list(on)
    periods = ref.select(
        *[F.col(k).alias("_r_" + k) for k in on],
        F.col(start).alias("_r_from"),
        F.col(end).alias("_r_to"),
        *columns,
        F.explode(F.sequence(F.trunc(start, unit), F.trunc(end, unit), F.expr(STEPS[unit]))).alias("_r_period"),
    )
    d = F.col(date).cast("date")
    cond = _all(
        [F.col(k) == F.col("_r_" + k) for k in on]
        + [F.trunc(d, unit) == F.col("_r_period"), d >= F.col("_r_from"), d <= F.col("_r_to")]
    )
    return facts.join(periods, cond, how).select(*facts.columns, *columns)


def disjoint_intervals(
    ref: DataFrame, keys: Sequence[str], start: str, end: str, value: str, unit: str = "month"
) -> DataFrame:
    """Rewrite possibly overlapping validity intervals as disjoint ones per key.

    Where several overlap, the smallest value holds. The bounds of all intervals
    cut a key's time into segments; each segment takes its value from the rows
    covering its first day. Clip open-ended intervals first.
    """
    keys = list(keys)
    ref = ref.groupBy(*keys, start, end).agg(F.min(value).alias(value))  # repeats collapse on the map side
    points = ref.select(*keys, F.explode(F.array(F.col(start), F.date_add(end, 1))).alias("_p")).distinct()
    w = Window.partitionBy(*keys).orderBy("_p")  # distinct days of the clipped span, however many rows
    segments = points.withColumn("_q", F.lead("_p").over(w)).where(F.col("_q").isNotNull())
    covered = _join_periods(segments, ref, keys, "_p", start, end, [value], "inner", unit)
    return covered.groupBy(*keys, "_p", "_q").agg(F.min(value).alias(value)).select(
        *keys, F.col("_p").alias(start), F.date_sub("_q", 1).alias(end), value
    )


def lookup_effective(
    facts: DataFrame,
    ref: DataFrame,
    on: Mapping[str, str],
    date: str,
    start: str,
    end: str,
    value: str,
    out: str,
    *,
    unit: str = "month",
    overlapping: bool = True,
    span: Column | None = None,
) -> DataFrame:
    """Value of the reference row valid on a fact's date; the smallest if several are.

    ``on`` maps fact column to reference column. Overlaps are resolved on the
    reference side first, so every fact meets at most one row: facts are read
    once, joined once and never multiplied.
    """
    cols = list(on)
    side = ref.where(_all([F.col(r).isNotNull() for r in on.values()])).select(
        *[F.col(r).alias(l) for l, r in on.items()],
        F.col(start).alias("_from"),
        F.col(end).alias("_to"),
        F.col(value).alias("_value"),
    )
    side = clip(side, "_from", "_to", span if span is not None else date_span(facts, date))
    if overlapping:
        side = disjoint_intervals(side, cols, "_from", "_to", "_value", unit)
    found = _join_periods(facts, side, cols, date, "_from", "_to", ["_value"], "left", unit)
    return found.select(*facts.columns, F.col("_value").alias(out))


@dataclass(frozen=True)
class Rule:
    """One way of looking a value up: fact column -> reference column."""

    on: Mapping[str, str]
    where: Column | None = None
    when: Column | None = field(default=None)


def cascade_lookup(
    facts: DataFrame,
    ref: DataFrame,
    rules: Sequence[Rule],
    value: str,
    out: str,
    *,
    default: Column | None = None,
    rule_out: str | None = None,
    strict: bool = True,
) -> DataFrame:
    """Look a value up by several key combinations; the first hit wins.

    ``where`` limits the reference rows of a rule, ``when`` the fact rows it
    applies to. With ``strict`` the reference is reduced to one value per rule
    key (the smallest), so facts are never multiplied; without it every match of
    a rule yields a row.
    """
    df = facts
    for i, rule in enumerate(rules):
        side = ref if rule.where is None else ref.where(rule.where)
        keys = [F.col(r).alias(f"_c{i}_{l}") for l, r in rule.on.items()]
        if strict:
            side = side.groupBy(*keys).agg(F.min(value).alias(f"_v{i}"))
        else:
            side = side.select(*keys, F.col(value).alias(f"_v{i}"))
        df = _attach_on(df, side, {l: f"_c{i}_{l}" for l in rule.on}, rule.when)
    hits = [F.col(f"_v{i}") for i in range(len(rules))]
    df = df.withColumn(out, F.coalesce(*hits, *([default] if default is not None else [])))
    if rule_out:
        label = F.lit(None).cast("int")
        for i in reversed(range(len(rules))):
            label = F.when(F.col(f"_v{i}").isNotNull(), F.lit(i + 1)).otherwise(label)
        df = df.withColumn(rule_out, label)
    return df.drop(*[f"_v{i}" for i in range(len(rules))])


def cross_rates(rates: DataFrame) -> DataFrame:
    """Rates between all pairs of currencies that share a common target.

    ``rates`` has ``month, from_cur, to_cur, rate, loaded``. The self join runs
    on (month, common currency); per month that is at most the square of the
    number of currencies. Same currency is 1, a zero divisor gives 0, otherwise
    the quotient rounded to six places.
    """
    from tidemark.operators.dedup import latest

    a = rates.select("month", F.col("to_cur").alias("common"), F.col("from_cur").alias("src"), F.col("rate").alias("ra"), F.col("loaded").alias("la"))
    b = rates.select("month", F.col("to_cur").alias("common"), F.col("from_cur").alias("dst"), F.col("rate").alias("rb"), F.col("loaded").alias("lb"))
    pairs = a.join(b, ["month", "common"])
    rate = (
        F.when(F.col("rb") == 0, F.lit(0))
        .when(F.col("src") == F.col("dst"), F.lit(1))
        .otherwise(F.round(F.try_divide(F.col("ra").cast("double"), F.col("rb").cast("double")), 6))
        .cast("double")
    )
    newest = latest(
        pairs,
        ["month", "src", "dst"],
        [F.col("la").desc_nulls_last(), F.col("lb").desc_nulls_last(), F.col("common").asc()],
    )
    return newest.select("month", F.col("src").alias("from_cur"), F.col("dst").alias("to_cur"), rate.alias("rate"))


def join_any(
    left: DataFrame, right: DataFrame, conds: Sequence[Column]
) -> DataFrame:
    """Inner join on ``c1 OR c2 OR …`` where each condition contains an equality.

    An OR forces a nested loop. Here each condition is its own equi join, and
    rows already matched by an earlier condition are left out of the later ones.
    """
    out, earlier = None, None
    for c in conds:
        cond = c if earlier is None else c & ~F.coalesce(earlier, F.lit(False))
        part = left.join(right, cond)
        out = part if out is None else out.unionByName(part)
        earlier = c if earlier is None else F.coalesce(earlier, F.lit(False)) | F.coalesce(c, F.lit(False))
    return out


def expand_periods(df: DataFrame, start: str, end: str, out: str, unit: str = "month") -> DataFrame:
    """One row per calendar period that begins between two dates (inclusive).

    ``start`` and ``end`` are period start dates; a row with a null bound or an
    empty range yields nothing.
    """
    step = {
        "day": "INTERVAL 1 DAY",
        "week": "INTERVAL 7 DAYS",
        "month": "INTERVAL 1 MONTH",
        "quarter": "INTERVAL 3 MONTHS",
    }[unit]
    ok = F.col(start) <= F.col(end)
    return df.where(ok).withColumn(out, F.explode(F.sequence(F.col(start), F.col(end), F.expr(step))))


def stamp_period(df: DataFrame, period: DataFrame, column: str, out: str) -> DataFrame:
    """Each row once for every current period's key; around midnight there may be two."""
    keys = period.agg(F.array_sort(F.collect_set(column))).scalar()
    return df.withColumn(out, F.explode(keys))


def _mark_openings(
    df: DataFrame, keys: Sequence[str], order: str, is_open: Column, is_close: Column
) -> tuple[DataFrame, dict[str, timeline.Step]]:
    """Mark openings, and closings after the key's first opening, with 1 and 0.

    Also returns the running sums of both for a ``timeline.scan``.
    """
    zero = F.lit(0).cast("bigint")
    firsts = df.where(is_open).groupBy(*keys).agg(F.min(order).alias("_first_open"))
    marked = (
        attach(df, firsts, keys)
        .withColumn("_opens", F.coalesce(is_open.cast("bigint"), zero))
        .withColumn("_closes", F.coalesce((is_close & (F.col(order) > F.col("_first_open"))).cast("bigint"), zero))
        .drop("_first_open")
    )
    return marked, {"_opened": timeline.Step("sum", "_opens"), "_closed": timeline.Step("sum", "_closes")}


def pair_nth(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    is_open: Column,
    is_close: Column,
    *,
    ranged: bool = False,
) -> DataFrame:
    """Pair the nth opening row of a key with its nth closing row after the first opening.

    Returns ``keys, rn, open_id, close_id`` with one row per opening; ``close_id``
    is null where fewer closings exist. Both are numbered in one ordered scan and
    meet in a group of at most two rows.
    """
    keys = list(keys)
    marked, steps = _mark_openings(df, keys, order, is_open, is_close)
    numbered = timeline.scan(marked, keys, [order], steps, ranged=ranged, sized_by=df)
    opening = F.col("_opens") == 1
    return (
        numbered.where(opening | (F.col("_closes") == 1))
        .withColumn("rn", F.when(opening, F.col("_opened")).otherwise(F.col("_closed")))
        .groupBy(*keys, "rn")
        .agg(
            F.max(F.when(opening, F.col(order))).alias("open_id"),
            F.max(F.when(~opening, F.col(order))).alias("close_id"),
        )
        .where(F.col("open_id").isNotNull())
    )


def inside_intervals(
    df: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    order: str,
    out: str,
    *,
    ranged: bool = False,
) -> DataFrame:
    """Number of intervals (``open_id``, ``close_id``) a row lies strictly inside of.

    Opens before the row minus closes up to it: linear in the rows, where a range
    join would produce one row per covering interval. An interval without a close
    stays open; one that closes before it opens covers nothing. Bounds are
    ``order`` values of rows of ``df``.
    """
    keys = list(keys)
    real = intervals.where(F.col("close_id").isNull() | (F.col("close_id") > F.col("open_id")))
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    bounds = F.array(
        F.struct(F.col("open_id").alias(order), one.alias("_opens"), zero.alias("_closes")),
        F.struct(F.col("close_id").alias(order), zero.alias("_opens"), one.alias("_closes")),
    )
    marks = (
        real.select(*keys, F.explode(bounds).alias("_b"))
        .select(*keys, "_b.*")
        .where(F.col(order).isNotNull())
        .groupBy(*keys, order)
        .agg(F.sum("_opens").alias("_opens"), F.sum("_closes").alias("_closes"))
    )
    marked = (
        df.join(marks, [*keys, order], "left")
        .withColumn("_opens", F.coalesce("_opens", zero))
        .withColumn("_closes", F.coalesce("_closes", zero))
    )
    both = timeline.running(
        marked,
        keys,
        [order],
        {"_opened": ("sum", "_opens"), "_closed": ("sum", "_closes")},
        ranged=ranged,
        sized_by=df,
    )
    return both.withColumn(out, F.col("_opened") - F.col("_opens") - F.col("_closed")).select(*df.columns, out)


def open_count(
    df: DataFrame, keys: Sequence[str], order: str, is_open: Column, is_close: Column
) -> tuple[DataFrame, dict[str, timeline.Step], Column]:
    """Number of nth-pair intervals a row lies strictly inside of, without pairing.

    With the nth opening paired to the nth closing after the first opening, the
    number of intervals around a row is the openings before it less the closings
    up to it, not below zero. Returns the marked rows, the two running sums to put
    into a ``timeline.scan`` (next to whatever else it computes), and the count.
    """
    marked, steps = _mark_openings(df, list(keys), order, is_open, is_close)
    count = F.greatest(F.col("_opened") - F.col("_opens") - F.col("_closed"), F.lit(0).cast("bigint"))
    return marked, steps, count


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_on: str,
    right_on: str,
    columns: Sequence[str],
    *,
    allow_equal: bool = True,
    ranged: bool = False,
    tie: str | None = None,
) -> DataFrame:
    """The newest right row at or before (or strictly before) each left row.

    Both sides are put on one time line and the right payload is carried forward,
    so the cost is linear and no pair is built. ``ranged`` cuts large keys (see
    ``timeline``), also the null key of left rows; ``tie`` orders right rows of the same time.
    """
    by = list(by)
    payload = F.struct(*[F.col(c) for c in columns]).alias("_pay")
    types = {f.name: f.dataType for f in right.schema.fields}
    none = F.lit(None)
    side = F.lit(1 if allow_equal else 0)
    lrow = left.select(
        *by,
        F.col(left_on).alias("_t"),
        side.alias("_side"),
        none.cast(types[tie] if tie else "string").alias("_tie"),
        F.struct(*left.columns).alias("_row"),
        F.lit(None).cast(_struct_type(columns, types)).alias("_pay"),
    )
    rrow = right.select(
        *by,
        F.col(right_on).alias("_t"),
        F.lit(0 if allow_equal else 1).alias("_side"),
        (F.col(tie) if tie else none.cast("string")).alias("_tie"),
        none.cast(left.select(F.struct(*left.columns).alias("s")).schema["s"].dataType).alias("_row"),
        payload,
    ).where(_all([F.col(k).isNotNull() for k in by]))
    line = lrow.unionByName(rrow)
    carried = timeline.running(
        line,
        by,
        ["_t", "_side", "_tie"],
        {"_hit": ("last", "_pay")},
        ranged=ranged,
    )
    return carried.where(F.col("_row").isNotNull()).select(
        "_row.*", *[F.col("_hit").getField(c).alias(c) for c in columns]
    )


def _struct_type(columns, types):
    from pyspark.sql.types import StructField, StructType

    return StructType([StructField(c, types[c]) for c in columns])


def asof_max(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_on: str,
    right_on: str,
    value: str,
    out: str,
    *,
    ranged: bool = False,
) -> DataFrame:
    """Largest right ``value`` of the same key dated at or before each left row."""
    by = list(by)
    vtype = right.schema[value].dataType
    line = left.select(
        *by, F.col(left_on).alias("_t"), F.lit(1).alias("_side"),
        F.struct(*left.columns).alias("_row"), F.lit(None).cast(vtype).alias("_v"),
    ).unionByName(
        right.select(
            *by, F.col(right_on).alias("_t"), F.lit(0).alias("_side"),
            F.lit(None).cast(left.select(F.struct(*left.columns).alias("s")).schema["s"].dataType).alias("_row"),
            F.col(value).alias("_v"),
        ).where(_all([F.col(k).isNotNull() for k in by]))
    )
    # Equal (_t, _side) rows have equal or commuting values, so their order is free.
    run = timeline.running(
        line, by, ["_t", "_side"], {out: ("max", "_v")}, ranged=ranged
    )
    return run.where(F.col("_row").isNotNull()).select("_row.*", out)


def lookup_roles(
    df: DataFrame, ref: DataFrame, keys: Sequence[str], role: str, value: str, roles: Mapping[str, str]
) -> DataFrame:
    """One column per role from a (key, role, value) table: pivot once, join once."""
    from tidemark.operators.reshape import pivot_max

    wide = pivot_max(ref, keys, role, value, roles)
    return attach(df, wide, keys)


def choose_attribution(
    df: DataFrame, bridge: DataFrame, keys: Sequence[str], own_sale: Column, columns: Sequence[str]
) -> DataFrame:
    """The bridge's columns for own sales, the fact's own columns otherwise."""
    side = bridge.select(*keys, *[F.col(c).alias("_b_" + c) for c in columns])
    joined = df.join(side, list(keys), "left")
    return joined.select(
        *[
            F.when(own_sale, F.col("_b_" + c)).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in df.columns
        ]
    )


def exists_or_absent(
    facts: DataFrame, matrix: DataFrame, key: str, date: str, start: str, end: str, accept: Column
) -> DataFrame:
    """Keep facts whose key is not governed by the matrix, or that a valid matrix row accepts.

    ``matrix`` rows carry ``key``, ``start`` and ``end``. Whether a fact is refused depends on its
    key and date alone: that is decided on the distinct ones, and the facts are shuffled once.
    A null fact key is kept: it is governed by nothing.
    """
    governed = matrix.where(F.col(key).isNotNull()).select(key).distinct()
    # a governed key without a date is refused, so dates are compared as texts that are never null
    facts_on = facts.withColumn("_on", F.coalesce(F.col(date).cast("string"), F.lit("")))
    asked = attach(facts_on.select(key, date, "_on").distinct(), governed, [key], "left_semi")
    hits = join_effective(asked, matrix.where(accept), [key], date, start, end, [], how="inner").select(key, "_on").distinct()
    refused = asked.select(key, "_on").join(hits, [key, "_on"], "left_anti").distinct()
    return attach(facts_on, refused, [key, "_on"], "left_anti").select(*facts.columns)

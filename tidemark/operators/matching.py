"""Rules that fill only some key columns and hold for a time, matched by one equi join.

A rule set is a list of key combinations in order of preference, each with validity
dates: "product, direct and indirect customer", else "product alone", and so on. One
lookup for each combination shuffles the facts as many times. Here

* each key combination is a mask; a fact's keys are repeated once for each mask;
* a validity interval is cut into aligned cells of 1, B, B², … days, at most 2 (B - 1) of
  each size, and a date lies in one cell of each size. Cells cover an interval exactly,
  so a century costs little more than a week, nothing is left to compare after the
  equi join on (mask, keys, cell), and a key with a long history is spread over its cells;
* the rule side is reduced to one row for each (mask, keys, cell) before the join, so
  overlapping rules never multiply a fact.

The facts take part as distinct (keys, date), which one aggregate with map-side
combine gives, and only with keys that some rule has; whole rows are shuffled only
once, to fetch the answers.

Where all combinations share a key ("product" above) and few rules have the same value of
it, none of this is needed: the rules of a shared key are one short list, which
the facts fetch by their one shuffle and search in place. Shared keys with more than
``FEW_RULES`` rules take the way over cells, so that no list is long.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import date_span
from tidemark.operators.skew import attach
from tidemark.session import broadcast_bounded

#: Rules of a shared key that are searched as a list.
FEW_RULES = 32

#: A cell's number and its size class share one bigint.
SIZES = 32


def levels(days: Column, bits: int) -> Column:
    """How many cell sizes a span of ``days`` days (first to last, 0 or more) needs."""
    return F.floor((F.length(F.bin(days.cast("bigint"))) + bits - 1) / bits).cast("int")


def cells_of_day(day: Column, sizes: Column, bits: int) -> Column:
    """Cells that hold a day (counted from 0), one of each size."""
    return F.transform(
        F.sequence(F.lit(0), sizes - 1),
        lambda s: F.call_function("shiftright", day.cast("bigint"), s * bits) * SIZES + s,
    )


def cells_of_interval(first: Column, last: Column, sizes: Column, bits: int) -> Column:
    """Disjoint cells that cover the days ``first`` to ``last`` (counted from 0) and no others.

    A cell is taken if it lies inside the interval and the next larger one around it
    does not. No two cells of an interval hold the same day.
    """
    base = 1 << bits
    none = F.array().cast("array<bigint>")

    def run(lo: Column, hi: Column) -> Column:
        return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(none)

    def of_size(s: Column) -> Column:
        def inside(size: Column) -> tuple[Column, Column]:
            whole = lambda day: F.call_function("shiftright", day.cast("bigint"), size * bits)
            return whole(first - 1) + 1, whole(last + 1) - 1

        lo, hi = inside(s)
        up, down = inside(s + 1)
        whole = (s == sizes - 1) | (up > down)
        cells = F.when(whole, run(lo, hi)).otherwise(F.concat(run(lo, up * base - 1), run((down + 1) * base, hi)))
        return F.transform(cells, lambda c: c * SIZES + s)

    return F.flatten(F.transform(F.sequence(F.lit(0), sizes - 1), of_size))


@dataclass(frozen=True)
class Rule:
    """A key combination: fact column -> rule column; ``where`` picks the rule rows it takes."""

    on: Mapping[str, str]
    where: Column | None = None


@dataclass(frozen=True)
class Choice:
    """A column to look up by the first of several rules that has a valid row.

    Of the valid rows of one rule the smallest value holds or, with ``latest``, that
    of the latest start (of equal starts the smallest value). Null values and null
    bounds never match. ``rule_out`` names a column for the number of the rule, from 1.
    """

    out: str
    ref: DataFrame
    value: str
    start: str
    end: str
    rules: Sequence[Rule]
    latest: bool = False
    rule_out: str | None = None


def match_rules(
    facts: DataFrame,
    choices: Sequence[Choice],
    date: str,
    *,
    span: Column | None = None,
    bits: int = 3,
    also: DataFrame | None = None,
    few: int = FEW_RULES,
) -> DataFrame:
    """``facts`` with one column for each choice, null where no rule matches.

    ``span`` (``joins.date_span``) must cover the dates of the facts; it is computed
    if not given and needed. A cell size is ``2**bits`` times the one before. Key columns have
    the same type on both sides. A fact whose key part is null is not matched by rules that use that
    part; a null date matches nothing. Repeated facts stay repeated. ``also`` has one row for each
    value of the keys that all rules share; its other columns are fetched by the same shuffle.
    """
    keys = list(dict.fromkeys(k for c in choices for r in c.rules for k in r.on))
    shared = [k for k in keys if all(k in r.on for c in choices for r in c.rules)]
    if also is not None and not {*shared} <= {*also.columns}:
        raise ValueError(f"the rules share {shared}, which is not a key of {also.columns}")
    if not shared:
        return _match_cells(facts, choices, date, span, bits)
    named = {k: F.col(f"_r_{k}") for k in shared}
    rows = _all_rule_rows(choices, keys, dict(facts.dtypes))
    counts = rows.groupBy(*[c.alias(k) for k, c in named.items()]).agg(F.count("*").alias("_n"))
    size = counts.agg(F.count_if(F.col("_n") > few).alias("crowded"), F.coalesce(F.sum("_n"), F.lit(0)).alias("rows")).first()
    if not size.crowded:
        return _match_lists(facts, rows, choices, keys, shared, date, also, size.rows)
    crowded = broadcast_bounded(counts.where(F.col("_n") > few).drop("_n"), size.crowded)
    on = _all([named[k] == F.col(k) for k in shared])
    few_facts = facts.join(crowded, shared, "left_anti").select(*facts.columns)
    alone = _match_lists(
        few_facts, rows.join(crowded, on, "left_anti"), choices, keys, shared, date, also, size.rows
    )
    many = facts.join(crowded, shared, "left_semi")
    many = many if also is None else attach(many, also, shared)
    return alone.unionByName(_match_cells(many, choices, date, span, bits, crowded))


def _match_lists(facts, rows, choices, keys, shared, date, also, size) -> DataFrame:
    """Rules of a shared key as one list, searched by each fact that fetched it; ``size`` is their counted number."""
    best = [f"_best{i}" for i in range(len(choices))]
    own = [k for k in keys if k not in shared]
    entry = F.struct(*[f"_r_{k}" for k in own], "_start", "_end", *best)
    lists = rows.groupBy(*[F.col(f"_r_{k}").alias(k) for k in shared]).agg(F.collect_list(entry).alias("_rules"))
    extra = [] if also is None else [c for c in also.columns if c not in shared]
    found = attach(facts, broadcast_bounded(lists, size) if also is None else lists.join(also, shared, "full_outer"), shared)
    day = F.col(date).cast("date")

    def holds(e: Column) -> Column:
        same = [e.getField(f"_r_{k}").isNull() | (e.getField(f"_r_{k}") == F.col(k)) for k in own]
        return _all([e.getField("_start") <= day, e.getField("_end") >= day, *same])

    found = found.withColumn("_valid", F.filter("_rules", holds))
    answers = [F.array_min(F.col("_valid").getField(b)).alias(b) for b in best]
    return found.select(*facts.columns, *extra, *answers).select(*facts.columns, *extra, *_chosen(choices))


def _chosen(choices: Sequence[Choice]) -> list[Column]:
    out: list[Column] = []
    for i, choice in enumerate(choices):
        out.append(F.col(f"_best{i}").getField("value").alias(choice.out))
        if choice.rule_out:
            out.append(F.col(f"_best{i}").getField("rule").alias(choice.rule_out))
    return out


def _match_cells(facts, choices, date, span, bits, only: DataFrame | None = None) -> DataFrame:
    """Rules and facts meet in cells of days; ``only`` limits the rules to some values of its columns."""
    span = span if span is not None else date_span(facts, date)
    lo = span.getField("lo")
    sizes = levels(F.datediff(span.getField("hi"), lo), bits)
    keys = list(dict.fromkeys(k for c in choices for r in c.rules for k in r.on))
    numbered = _numbered(choices, keys)
    best = [f"_best{i}" for i in range(len(choices))]
    types = dict(facts.dtypes)

    rows = _all_rule_rows(choices, keys, types)
    if only is not None:
        rows = rows.join(only, _all([F.col(f"_r_{k}") == F.col(k) for k in only.columns]), "left_semi")
    rows = (
        rows.withColumn("_first", F.datediff(F.greatest("_start", lo), lo))
        .withColumn("_last", F.datediff(F.least("_end", span.getField("hi")), lo))
        .where(F.col("_first") <= F.col("_last"))
    )
    # the span is a subquery, which a lambda can not hold: its values are columns first
    cell = F.explode(cells_of_interval(F.col("_first"), F.col("_last"), F.col("_sizes"), bits)).alias("_cell")
    held = ["_mask", *[f"_r_{k}" for k in keys]]
    table = (
        rows.withColumn("_sizes", sizes)
        .select(*held, *best, cell)
        .groupBy(*held, "_cell")
        .agg(*[F.min(b).alias(b) for b in best])
        .withColumn("_rh", F.xxhash64(*held))
    )

    own = [F.col(k).alias(f"_f_{k}") for k in keys]
    asks = facts.where(F.col(date).isNotNull()).select(*own, F.col(date).cast("date").alias("_day")).distinct()
    null = {k: F.lit(None).cast(types[k]) for k in keys}
    turns = F.array(
        *[
            F.when(
                _all([F.col(f"_f_{k}").isNotNull() for k in mask]),
                F.struct(
                    F.lit(i).alias("mask"),
                    F.xxhash64(F.lit(i), *[F.col(f"_f_{k}") if k in mask else null[k] for k in keys]).alias("hash"),
                ),
            )
            for mask, i in numbered.items()
        ]
    )
    named = rows.select(F.xxhash64(*held).alias("_lh")).distinct()  # keys that some rule has; counted, then joined
    asked = (
        asks.withColumn("_turn", F.explode(F.array_compact(turns)))
        .select(*asks.columns, F.col("_turn.mask").alias("_m"), F.col("_turn.hash").alias("_lh"))
        .join(broadcast_bounded(named, named.count()), "_lh", "left_semi")
        .withColumns({"_place": F.datediff("_day", lo), "_sizes": sizes})
        .withColumn("_at", F.explode(cells_of_day(F.col("_place"), F.col("_sizes"), bits)))
    )
    same = [F.col("_m") == F.col("_mask"), F.col("_lh") == F.col("_rh"), F.col("_at") == F.col("_cell")]
    same += [F.col(f"_r_{k}").isNull() | (F.col(f"_f_{k}") == F.col(f"_r_{k}")) for k in keys]
    ask = [f"_f_{k}" for k in keys] + ["_day"]
    answers = (
        asked.join(table, _all(same))
        .groupBy(*ask)
        .agg(*[F.min(b).alias(b) for b in best])
        .withColumn("_ah", F.xxhash64(*ask))
    )

    left = facts.withColumn("_lh", F.xxhash64(*keys, F.col(date).cast("date")))
    back = [F.col("_lh") == F.col("_ah"), F.col(date).cast("date") == F.col("_day")]
    back += [F.col(k).eqNullSafe(F.col(f"_f_{k}")) for k in keys]
    return left.join(answers, _all(back), "left").select(*facts.columns, *_chosen(choices))


def _numbered(choices: Sequence[Choice], keys: Sequence[str]) -> dict[tuple[str, ...], int]:
    masks = dict.fromkeys(tuple(k for k in keys if k in r.on) for c in choices for r in c.rules)
    return {m: i for i, m in enumerate(masks)}


def _all_rule_rows(choices: Sequence[Choice], keys: Sequence[str], types: Mapping[str, str]) -> DataFrame:
    numbered = _numbered(choices, keys)
    parts = [_rule_rows(c, keys, numbered, types, i, choices) for i, c in enumerate(choices)]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def _rule_rows(choice, keys, numbered, types, place, choices) -> DataFrame:
    """One scan of a choice's table, a row repeated for each rule that takes it: mask, keys (null
    where the mask has none), first and last date, candidate values."""
    kinds = dict(choice.ref.dtypes)
    turns = []
    for number, rule in enumerate(choice.rules, 1):
        for k, r in rule.on.items():
            if kinds[r] != types[k]:
                raise TypeError(f"{k} is {types[k]}, rule column {r} is {kinds[r]}")
        takes = _all([F.col(r).isNotNull() for r in rule.on.values()])
        mask = numbered[tuple(k for k in keys if k in rule.on)]
        parts = [(F.col(rule.on[k]) if k in rule.on else F.lit(None)).cast(types[k]).alias(f"_r_{k}") for k in keys]
        turn = F.struct(F.lit(mask).alias("_mask"), F.lit(number).alias("rule"), *parts)
        turns.append(F.when(takes if rule.where is None else takes & rule.where, turn))
    start, end = F.col(choice.start).cast("date"), F.col(choice.end).cast("date")
    given = choice.ref.where(_all([F.col(c).isNotNull() for c in (choice.value, choice.start, choice.end)]))
    rows = given.select(
        start.alias("_start"),
        end.alias("_end"),
        (-F.datediff(start, F.lit("1970-01-01").cast("date")) if choice.latest else F.lit(0)).alias("order"),
        F.col(choice.value).alias("value"),
        F.explode(F.array_compact(F.array(*turns))).alias("_turn"),
    ).where(F.col("_start") <= F.col("_end"))
    # smaller is better: rule number, then a later start if asked for, then the value
    mine = F.struct(F.col("_turn.rule").alias("rule"), "order", "value")
    values = []
    for i, other in enumerate(choices):
        kind = f"struct<rule:int,order:int,value:{dict(other.ref.dtypes)[other.value]}>"
        values.append((mine if i == place else F.lit(None)).cast(kind).alias(f"_best{i}"))
    return rows.select("_turn._mask", *[f"_turn._r_{k}" for k in keys], "_start", "_end", *values)


def _all(conds: Sequence[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out

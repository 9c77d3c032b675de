"""Ordered computations over keyed rows, safe for very large keys.

A SQL window sends all rows of a key to one task. When one key holds a third of
the table that task never ends. With ``ranged`` the functions here work like a
prefix scan over even ranges of (key, order): a sample of the keys and orders gives
the bounds of as many ranges as there are shuffle partitions. A key that spans
several ranges is cut at the bounds within it, any other stays whole. The window
then runs per (key, range), and what a range needs to know of the rows before it
is a small carry value, computed from an aggregate of the cut keys' rows. Bounds
and carries have at most two rows for each range, so both are broadcast: rows are
shuffled once, and where no key spans several ranges the plan is a plain window.
Rows with a null key are a key like any other. Without ``ranged`` a plain window
runs, which is right for keys known to be small.

The sample also tells how many rows there are. If they would give the configured shuffle
partitions more than ``ROWS_A_TASK`` each, there are as many more ranges and the rows are dealt to
as many more tasks, so that what a task sorts does not grow with the table.

The order must be total within a key, and order columns must not be null but where
a function says so. The sample only sets how even the ranges are, never the result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.skew import attach

CHUNK = "_range"

#: Sampled rows for each range, and the most ranges; the sample has 100,000 rows at most.
SAMPLED = 20
MOST_RANGES = 5_000
#: Rows that one task is to sort.
ROWS_A_TASK = 500_000
#: Bounds are searched in steps of so many.
STRIDE = 64


def _same(keys: Sequence[str], prefix: str) -> Column:
    """Keys equal to their ``prefix`` names, null to null."""
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).eqNullSafe(F.col(prefix + k))
    return out


def key_bounds(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], ranges: int
) -> tuple[DataFrame | None, int]:
    """Keys that span several of the even ranges of all rows, with the ascending bounds within them,
    and about how many rows there are (0 if there are fewer than ``SAMPLED``).

    The first is None if there are none. All keys together have fewer bounds than ranges.
    """
    most = ranges * SAMPLED
    rows = df.select(*keys, F.struct(*order).alias("_at"))
    sample = rows.withColumn("_turn", F.rand(7)).orderBy("_turn").limit(most)
    whole = Window.partitionBy()  # sampled rows
    place = F.row_number().over(Window.orderBy(*[F.col(k).asc_nulls_first() for k in keys], "_at"))
    bounds = (
        sample.select(*keys, "_at", place.alias("_i"), F.max("_turn").over(whole).alias("_top"), F.count("*").over(whole).alias("_n"))
        .where(F.col("_i") % SAMPLED == 0)
        .drop("_i")
    )
    found = bounds.collect()  # as many as ranges
    if not found:
        return None, 0
    # of evenly spread turns the least ``most`` were taken: the largest of them tells how many there are
    size = found[0]._n if found[0]._n < most else round(most / found[0]._top)
    given = df.sparkSession.createDataFrame(found, bounds.schema)
    lists = given.groupBy(*keys).agg(F.array_sort(F.collect_set("_at")).alias("_bounds")).where(F.size("_bounds") > 1)
    cut = lists.collect()
    return df.sparkSession.createDataFrame(cut, lists.schema) if cut else None, size


def _range_number(at: Column) -> Column:
    """Number of ``_bounds`` up to ``at``: whole strides first, then within one."""
    upto = lambda b: b <= at
    strides = F.size(F.filter("_strides", upto))
    within = F.size(F.filter(F.slice("_bounds", strides * STRIDE + 1, F.lit(STRIDE)), upto))
    return strides * STRIDE + within


def cut_keys(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ranges: int | None = None,
    sized_by: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame] | None:
    """All rows with their range (null for whole keys), and the rows of cut keys alone.

    None if no key spans several ranges. See ``deal``.
    """
    rows, hot = deal(df, keys, order, ranges, sized_by)
    return None if hot is None else (rows, hot)


def deal(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ranges: int | None = None,
    sized_by: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Rows ready for windows by key, or if keys are cut by (key, range), and then the rows of cut keys alone.

    Rows are dealt to more tasks than there are shuffle partitions if they are too many for
    these, unless ``ranges`` is given. ``sized_by`` is a cheaper relation with the same
    keys and orders to sample, if ``df`` is costly to compute (its own input, say).
    """
    names = {*keys, *order}
    source = sized_by if sized_by is not None and names <= set(sized_by.columns) else df
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(ranges or usual, MOST_RANGES)
    bounds, size = key_bounds(source, keys, order, parts)
    tasks = parts if ranges else min(-(-size // ROWS_A_TASK), MOST_RANGES)
    if tasks > parts:
        bounds, _ = key_bounds(source, keys, order, tasks)
    more = tasks > parts
    if bounds is None:
        return df.repartition(tasks, *keys) if more else df, None
    ends = F.filter("_bounds", lambda b, i: i % STRIDE == STRIDE - 1).alias("_strides")
    cut = F.broadcast(bounds.select(*[F.col(k).alias(f"_b_{k}") for k in keys], "_bounds", ends))
    number = F.when(F.col("_bounds").isNotNull(), _range_number(F.struct(*order)))
    same = _same(keys, "_b_")
    rows, hot = (df.join(cut, same, how).withColumn(CHUNK, number).select(*df.columns, CHUNK) for how in ("left", "inner"))
    return rows.repartition(tasks, *keys, CHUNK) if more else rows, hot


def with_carry(local: DataFrame, carry: DataFrame, keys: Sequence[str], bounded: bool = True) -> DataFrame:
    """``local`` with the columns of ``carry``, which has a row for some (key, range).

    ``bounded``: there is at most one for each bound and cut key, so it is broadcast.
    """
    by = [*keys, CHUNK]
    named = carry.select(*[F.col(k).alias(f"_b_{k}") for k in by], *[c for c in carry.columns if c not in by])
    named = F.broadcast(named) if bounded else named
    return local.join(named, _same(by, "_b_"), "left").drop(*[f"_b_{k}" for k in by])


def _upto(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _before(keys: Sequence[str], order: Sequence[str] = (CHUNK,)):
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def _after(keys: Sequence[str], order: Sequence[str] = (CHUNK,)):
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(1, Window.unboundedFollowing)


def _at(order: Sequence[str], present: Column | None = None) -> Column:
    """Sort value of a row for max_by/min_by; null (so ignored) unless ``present``."""
    here = F.struct(*order)
    return here if present is None else F.when(present, here)


@dataclass(frozen=True)
class Step:
    """One output of ``scan``: what to compute from which column.

    ``lag``/``lead``: value of the row before/after. ``lag_known``/``lead_known``:
    nearest earlier/later non-null value. ``sum``/``max``/``min``: running, the row
    included. ``last``: nearest non-null value so far, the row included.
    """

    kind: str
    column: str
    default: Column | None = None

    def plain(self, keys, order) -> Column:
        c = self.column
        if self.kind == "lag":
            return F.lag(c).over(Window.partitionBy(*keys).orderBy(*order))
        if self.kind == "lead":
            return F.lead(c).over(Window.partitionBy(*keys).orderBy(*order))
        if self.kind == "lag_known":
            return F.last(c, ignorenulls=True).over(_before(keys, order))
        if self.kind == "lead_known":
            return F.first(c, ignorenulls=True).over(_after(keys, order))
        if self.kind == "last":
            return F.last(c, ignorenulls=True).over(_upto(keys, order))
        return {"sum": F.sum, "max": F.max, "min": F.min}[self.kind](c).over(_upto(keys, order))

    def edge(self, order) -> Column:
        """What later (or earlier) ranges need to know of a range."""
        c = self.column
        known = F.col(c).isNotNull()
        # A struct keeps "the edge row's value is null" apart from "no edge row".
        boxed = F.struct(F.col(c).alias("v"))
        if self.kind == "lag":
            return F.max_by(boxed, _at(order))
        if self.kind == "lead":
            return F.min_by(boxed, _at(order))
        if self.kind in ("lag_known", "last"):
            return F.max_by(c, _at(order, known))
        if self.kind == "lead_known":
            return F.min_by(c, _at(order, known))
        return {"sum": F.sum, "max": F.max, "min": F.min}[self.kind](c)

    def carry(self, edge: str, keys) -> Column:
        if self.kind in ("lag", "lag_known", "last"):
            c = F.last(edge, ignorenulls=True).over(_before(keys))
        elif self.kind in ("lead", "lead_known"):
            c = F.first(edge, ignorenulls=True).over(_after(keys))
        else:
            return {"sum": F.sum, "max": F.max, "min": F.min}[self.kind](edge).over(_before(keys))
        return c.getField("v") if self.kind in ("lag", "lead") else c

    def merge(self, local: Column, carry: Column) -> Column:
        if self.kind == "lag":
            return F.when(F.col("_not_first"), local).otherwise(carry)
        if self.kind == "lead":
            return F.when(F.col("_not_last"), local).otherwise(carry)
        if self.kind == "sum":
            return F.when(local.isNull(), carry).when(carry.isNull(), local).otherwise(local + carry)
        if self.kind == "max":
            return F.greatest(local, carry)
        if self.kind == "min":
            return F.least(local, carry)
        return F.coalesce(local, carry)

    def finish(self, c: Column) -> Column:
        return c if self.default is None else F.coalesce(c, self.default)


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    outputs: Mapping[str, Step],
    *,
    ranged: bool = False,
    ranges: int | None = None,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Add several ordered outputs in one pass.

    However many outputs there are, rows are sampled, shuffled and sorted once;
    prefer one call over a chain.
    """
    keys, order = list(keys), list(order)
    rows, hot = deal(df, keys, order, ranges, sized_by) if ranged else (df, None)
    return scan_dealt(rows, hot, keys, order, outputs)


def scan_dealt(
    rows: DataFrame, hot: DataFrame | None, keys: Sequence[str], order: Sequence[str], outputs: Mapping[str, Step]
) -> DataFrame:
    """``scan`` of what ``deal`` gave."""
    if hot is None:
        return rows.select("*", *[s.finish(s.plain(keys, order)).alias(out) for out, s in outputs.items()])

    parts = [*keys, CHUNK]
    edges = hot.groupBy(*parts).agg(*[s.edge(order).alias(f"_e_{out}") for out, s in outputs.items()])
    carry = edges.select(*parts, *[s.carry(f"_e_{out}", keys).alias(f"_c_{out}") for out, s in outputs.items()])

    w = Window.partitionBy(*parts).orderBy(*order)
    kinds = {s.kind for s in outputs.values()}
    marks = []
    if "lag" in kinds:
        marks.append(F.lag(F.lit(True)).over(w).alias("_not_first"))
    if "lead" in kinds:
        marks.append(F.lead(F.lit(True)).over(w).alias("_not_last"))
    local = rows.select("*", *marks, *[s.plain(parts, order).alias(f"_l_{out}") for out, s in outputs.items()])
    joined = with_carry(local, carry, keys)
    return joined.select(
        *[c for c in rows.columns if c != CHUNK],
        *[s.finish(s.merge(F.col(f"_l_{out}"), F.col(f"_c_{out}"))).alias(out) for out, s in outputs.items()],
    )


def previous(df, keys, order, values: Mapping[str, str], *, ranged=False, ignore_nulls=False, default=None, **hot) -> DataFrame:
    """Value of the row before (LAG), or of the nearest earlier row that has one."""
    kind = "lag_known" if ignore_nulls else "lag"
    return scan(df, keys, order, {o: Step(kind, c, default) for o, c in values.items()}, ranged=ranged, **hot)


def following(df, keys, order, values: Mapping[str, str], *, ranged=False, ignore_nulls=False, default=None, **hot) -> DataFrame:
    """Value of the next row (LEAD), or of the nearest later row that has one."""
    kind = "lead_known" if ignore_nulls else "lead"
    return scan(df, keys, order, {o: Step(kind, c, default) for o, c in values.items()}, ranged=ranged, **hot)


def running(df, keys, order, outputs: Mapping[str, tuple[str, str]], *, ranged=False, **hot) -> DataFrame:
    """Running aggregates up to and including each row: name -> (kind, column)."""
    return scan(df, keys, order, {o: Step(k, c) for o, (k, c) in outputs.items()}, ranged=ranged, **hot)


def ordinal(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, *, ranged: bool = False, **hot
) -> DataFrame:
    """1, 2, 3 … within each key (ROW_NUMBER), as a bigint."""
    tagged = df.withColumn("_one", F.lit(1).cast("bigint"))
    return running(tagged, keys, order, {out: ("sum", "_one")}, ranged=ranged, **hot).drop("_one")


COPY_BLOCK = 10_000


def copy_ordinal(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str,
    *,
    ranged: bool = False,
    block: int = COPY_BLOCK,
    ranges: int | None = None,
) -> DataFrame:
    """``ordinal`` for rows that may repeat exactly.

    No range can split equal rows, so copies are first counted (combined on the map
    side), the counts are added up along the order, and each distinct row is then
    repeated with its range of numbers. A row with very many copies is repeated in
    blocks spread over the cluster. ``order`` must be total over distinct rows.
    """
    cols = df.columns
    counted = df.groupBy(*cols).agg(F.count("*").alias("_n"))
    numbered = running(counted, keys, order, {"_hi": ("sum", "_n")}, ranged=ranged, ranges=ranges, sized_by=df)
    lo, hi = F.col("_hi") - F.col("_n") + 1, F.col("_hi")
    few = numbered.where(F.col("_n") <= block).select(*cols, F.explode(F.sequence(lo, hi)).alias(out))
    blocks = (
        numbered.where(F.col("_n") > block)
        .select(*cols, "_hi", F.explode(F.sequence(lo, hi, F.lit(block).cast("bigint"))).alias("_lo"))
        .repartition(*cols, "_lo")
    )
    many = blocks.select(
        *cols, F.explode(F.sequence(F.col("_lo"), F.least(F.col("_lo") + block - 1, F.col("_hi")))).alias(out)
    )
    return few.unionByName(many)


def change_event(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    *,
    ranged: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Counter that starts at 0 and grows by one whenever the value differs from
    the row before. A comparison with null is not a change."""
    keys, order = list(keys), list(order)
    rows, hot = deal(df, keys, order, ranges) if ranged else (df, None)
    if hot is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        step = F.coalesce((F.col(value) != F.lag(value).over(w)).cast("bigint"), F.lit(0).cast("bigint"))
        return (
            rows.withColumn("_step", step)
            .withColumn(out, F.sum("_step").over(_upto(keys, order)))
            .drop("_step")
        )

    parts = [*keys, CHUNK]
    zero = F.lit(0).cast("bigint")
    w = Window.partitionBy(*parts).orderBy(*order)

    def stepped(some: DataFrame) -> DataFrame:
        return some.withColumn("_step", F.coalesce((F.col(value) != F.lag(value).over(w)).cast("bigint"), zero))

    local = stepped(rows).withColumn("_local", F.sum("_step").over(_upto(parts, order)))
    edges = stepped(hot).groupBy(*parts).agg(
        F.sum("_step").alias("_n"),
        F.min_by(F.struct(F.col(value).alias("v")), _at(order)).alias("_first"),
        F.max_by(F.struct(F.col(value).alias("v")), _at(order)).alias("_last"),
    )
    wk = Window.partitionBy(*keys).orderBy(CHUNK)
    carry = (
        edges.withColumn(
            "_jump",
            F.coalesce((F.col("_first.v") != F.lag("_last").over(wk).getField("v")).cast("bigint"), zero),
        )
        .withColumn("_done", F.coalesce(F.sum("_n").over(_before(keys)), zero))
        .withColumn("_base", F.col("_done") + F.sum("_jump").over(_upto(keys, [CHUNK])))
        .select(*parts, "_base")
    )
    joined = with_carry(local, carry, keys)
    return joined.select(*df.columns, (F.col("_local") + F.coalesce("_base", zero)).alias(out))


def islands(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    *,
    ranged: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Difference of the row's ordinals within the key and within (key, value).

    Together with the value it names one unbroken run of that value.
    """
    keys, order = list(keys), list(order)
    # Inside a struct a null value is an ordinary key value.
    boxed = df.withColumn("_v", F.struct(value))
    rows, hot = deal(boxed, keys, order, ranges, df) if ranged else (boxed, None)
    rows = rows if hot is not None else rows.withColumn(CHUNK, F.lit(0))
    local = rows.select(
        "*",
        F.row_number().over(Window.partitionBy(*keys, CHUNK).orderBy(*order)).alias("_all"),
        F.row_number().over(Window.partitionBy(*keys, CHUNK, "_v").orderBy(*order)).alias("_own"),
    )
    diff = F.col("_all").cast("bigint") - F.col("_own")
    if hot is None:
        return local.select(*df.columns, diff.alias(out))

    zero = F.lit(0).cast("bigint")

    def earlier(by: Sequence[str], name: str) -> DataFrame:
        counts = hot.groupBy(*by, CHUNK).agg(F.count("*").alias("_n"))
        return counts.select(*by, CHUNK, F.coalesce(F.sum("_n").over(_before(by)), F.lit(0)).alias(name))

    joined = with_carry(local, earlier([*keys, "_v"], "_own0"), [*keys, "_v"], bounded=False)
    joined = with_carry(joined, earlier(keys, "_all0"), keys)
    return joined.select(*df.columns, (diff + F.coalesce("_all0", zero) - F.coalesce("_own0", zero)).alias(out))


def valid_to(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    out: str,
    *,
    ranged: bool = False,
    open_end: str = "9999-12-31",
    **hot,
) -> DataFrame:
    """Last day of validity: the day before the next start, or ``open_end``."""
    nxt = following(df, keys, [start], {"_next": start}, ranged=ranged, **hot)
    return nxt.withColumn(
        out, F.coalesce(F.date_sub("_next", 1), F.lit(open_end).cast("date"))
    ).drop("_next")


def whole_key(
    df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Column]
) -> DataFrame:
    """Attach per-key aggregates to every row.

    Aggregate, then join: the aggregate is combined on the map side and the join
    can split a hot key, which an unbounded window frame cannot.
    """
    sums = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()])
    return attach(df, sums, keys)


def first_value(c: str, order: Sequence[str]) -> Column:
    return F.min_by(c, F.struct(*order))


def last_value(c: str, order: Sequence[str]) -> Column:
    """Over the whole key, not up to the current row."""
    return F.max_by(c, F.struct(*order))


def last_known(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """One row per key with the newest non-null value of every column."""
    return df.groupBy(*keys).agg(
        *[F.max_by(c, _at(order, F.col(c).isNotNull())).alias(c) for c in columns]
    )

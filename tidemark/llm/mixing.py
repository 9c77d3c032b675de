"""Mixing sources to target weights by fitting each source's word budget as a subset sum.

Documents are counted by (source, exact length); only these counts are needed to fit a
budget. A budget of several times the source takes every document that often; the rest
is a bounded knapsack: the same share of every length first, then single documents in
seeded order, and for the last few thousand words dynamic programming over the counts
that are left. At last the planned number of documents of each length is selected in the
order of a seeded hash of what a document holds, so reruns agree however rows are dealt. For
a length that is taken in part, the place of the last document taken is found by ranking
hashes alone; each document then compares its own place, so texts are not shuffled.

A length of one source may hold a third of all documents (copies): its documents are
ranked in hash slices whose counts are added up first, never in one group.

Defined cases: a null text has length 0 and is never counted towards a budget; a null
source is a source of its own, the last; repeated rows are documents of their own; a
source without words has target 0; other columns are kept by ``mix`` and not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ROW_KEY, by_row, stored
from tidemark.operators.skew import attach

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SEED = 20
#: Words that are left to dynamic programming after the proportional and the greedy step.
TAIL_WORDS = 4096
#: Lengths of sources that are broadcast; more are joined by a shuffle.
BROADCAST_LENGTHS = 1_000_000
#: Documents of one length that are ranked in one group.
SLICE_ROWS = 50_000

KEY = ["_source", "_null"]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"_source": F.coalesce("source", F.lit("")), "_null": F.col("source").isNull()})


def targets(totals: DataFrame, weights=WEIGHTS, cap: int = MOST_REPEATS) -> DataFrame:
    """``target`` per source; ``totals`` has one row per source with ``source_size``.

    All sizes are shared by weight, but no source gets more than ``cap`` times its own
    size; what is above is shared again. In the order of size over weight the capped
    sources come first, so running sums find them.
    """
    by_name = Window.orderBy("_null", "_source")  # one row per source
    place = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights)) + 1)
    rows = totals.withColumn("weight", weight)
    whole = Window.partitionBy(F.lit(0))
    before = whole.orderBy(F.col("source_size") / F.col("weight"), "_null", "_source")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns(
        {
            "rest": F.sum("source_size").over(whole) - F.coalesce(cap * F.sum("source_size").over(before), F.lit(0)),
            "open": F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        }
    )
    rows = rows.withColumn("capped", F.col("rest") * F.col("weight") > cap * F.col("source_size") * F.col("open"))
    used = F.coalesce(F.sum(F.when(F.col("capped"), cap * F.col("source_size"))).over(whole), F.lit(0))
    free = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(whole)
    share = (F.sum("source_size").over(whole) - used) * F.col("weight") / free
    target = F.when(F.col("capped"), (cap * F.col("source_size")).cast("double")).otherwise(share)
    return rows.select(*KEY, "source_size", target.alias("target"))


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int, seed: int = SEED) -> np.ndarray:
    """How many documents of each size to take so that their sizes sum to ``budget`` or as near as found."""
    sizes, counts = sizes.astype(np.int64), counts.astype(np.int64)
    total = int((sizes * counts).sum())
    if budget >= total:
        return counts.copy()
    if budget <= 0 or not total:
        return np.zeros_like(counts)
    take = np.array([int(c) * budget // total for c in counts], np.int64)
    rest = budget - int((take * sizes).sum())
    order = np.random.default_rng(seed).permutation(len(sizes))
    while rest > TAIL_WORDS:  # one more document of each length in turn
        before = rest
        for i in order:
            if rest > TAIL_WORDS and take[i] < counts[i] and 0 < sizes[i] <= rest:
                take[i] += 1
                rest -= int(sizes[i])
        if rest == before:
            break
    _knapsack(sizes, counts, take, rest, order)
    return take


def _knapsack(sizes, counts, take, rest: int, order) -> None:
    """Add documents to ``take`` whose sizes come nearest to ``rest``: bounded knapsack over sums as bits."""
    mask = (1 << (2 * rest + 1)) - 1  # a sum of twice the rest is no better than none
    reach, steps = 1, []
    for i in order:
        left, size = int(counts[i] - take[i]), int(sizes[i])
        left = min(left, 2 * rest // size) if size else 0
        lot = 1
        while left > 0:
            n = min(lot, left)
            steps.append((i, n, reach))
            reach |= (reach << (n * size)) & mask
            left, lot = left - n, lot * 2
        if reach >> rest & 1:
            break
    below = (reach & ((1 << (rest + 1)) - 1)).bit_length() - 1
    above = reach >> rest
    over = rest + (above & -above).bit_length() - 1 if above else 2 * rest + 1
    best = below if rest - below <= over - rest else over
    for i, n, was in reversed(steps):
        if not was >> best & 1:
            take[i] += n
            best -= n * int(sizes[i])


PLAN = "_source string, _null boolean, size bigint, n bigint, base bigint, extra bigint"


def _plan_source(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("size")
    whole, target = int(rows.source_size.iloc[0]), float(rows.target.iloc[0])
    base = min(MOST_REPEATS, int(target // whole)) if whole else 0
    budget = round(target - base * whole) if base < MOST_REPEATS else 0
    extra = fit(rows["size"].to_numpy(), rows.n.to_numpy(), budget)
    out = rows[["_source", "_null", "size", "n"]].assign(base=base, extra=extra)
    return out.astype({"base": "int64", "extra": "int64"})


def word_count() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint").alias("size")


def _order(seed: int) -> Column:
    """Seeded turn of a row by what it holds, so that it does not depend on how rows are dealt."""
    return F.xxhash64(F.lit(seed), F.col("doc_id").cast("bigint"), "text")


def measured(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, row key, source, turn and ``size``, the number of words (anything between ASCII white space)."""
    rows = docs if ROW_KEY in docs.columns else by_row(docs)
    turn = _order(seed).alias("_order")
    return _keyed(rows.select(F.col("doc_id"), ROW_KEY, "source", turn, word_count())).drop("source")


def _slice() -> Column:
    """Part of a group of ``n`` rows by its turn."""
    return F.pmod(F.shiftrightunsigned("_order", 8), F.ceil(F.col("n") / SLICE_ROWS)).alias("_slice")


PLACE = ["_slice", "_order", ROW_KEY]


def plan(sizes: DataFrame) -> DataFrame:
    """Per source and length: ``base`` takes of every row, and ``last``, the place of the last row that is taken once more.

    ``sizes`` is what ``measured`` returns. Only rows of lengths that are taken in part are ranked.
    """
    totals = sizes.groupBy(*KEY).agg(F.sum("size").alias("source_size"))
    goals = targets(totals)
    lengths = sizes.groupBy(*KEY, "size").agg(F.count("*").alias("n"))
    fitted = lengths.join(goals, KEY).groupBy(*KEY).applyInPandas(_plan_source, PLAN)
    fitted = stored(fitted.join(goals, KEY), "mix-plan")
    part = fitted.where("extra > 0 and extra < n").select(*KEY, "size", "n", "extra")
    marked = attach(sizes.select(*KEY, "size", "_order", ROW_KEY), part, [*KEY, "size"], "inner").withColumn("_slice", _slice())
    group = [*KEY, "size", "_slice"]
    counts = marked.where(F.col("n") > SLICE_ROWS).groupBy(*group).agg(F.count("*").alias("m"))
    earlier = Window.partitionBy(*KEY, "size").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("m").over(earlier), F.lit(0))).drop("m")
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("_order", ROW_KEY))
    ranked = attach(marked.withColumn("_rank", rank), counts, group)
    last = ranked.where(F.col("_rank") + F.coalesce("_before", F.lit(0)) == F.col("extra"))
    last = last.select(*KEY, "size", F.struct(*PLACE).alias("last"))
    return stored(fitted.join(last, [*KEY, "size"], "left"), "mix-places")


def choose(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """``rows`` (with source key, size, turn and row key) and how many ``times`` the mix takes each.

    A row compares its place with the last one of its length, so rows are neither ranked nor
    shuffled where the plan, one row for each source and length, is small enough to broadcast.
    """
    few = planned.count() <= BROADCAST_LENGTHS
    marked = rows.join(F.broadcast(planned), [*KEY, "size"]) if few else attach(rows, planned, [*KEY, "size"], "inner")
    taken = F.struct(_slice(), "_order", ROW_KEY) <= F.col("last")
    more = F.when(F.col("last").isNull(), (F.col("extra") > 0).cast("bigint")).otherwise(taken.cast("bigint"))
    return marked.withColumn("times", F.col("base") + more)


def mixture(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The contract's columns: ``taken`` counts the words of all takes of a document."""
    sizes = stored(measured(docs, seed), "mix-sizes")
    rows = choose(sizes, plan(sizes))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it; wordless rows are kept once."""
    own = {c: F.col(c).alias(f"_own_{i}") for i, c in enumerate(docs.columns)}  # other columns may have any name
    rows = by_row(docs)
    planned = plan(stored(measured(rows, seed), "mix-sizes"))
    keyed = _keyed(rows.select(*own.values(), "source", ROW_KEY, _order(seed).alias("_order"), word_count())).drop("source")
    times = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.col("times")).cast("int")
    picked = choose(keyed, planned).withColumn("_n", times).where("_n > 0")
    repeated = picked.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    return repeated.select(*[F.col(f"_own_{i}").alias(c) for i, c in enumerate(docs.columns)])

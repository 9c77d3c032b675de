"""Walking a bill-of-material graph."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import BROADCAST_ROW_LIMIT, broadcast_bounded, cut_lineage

STATE = ["part", "site", "stage", "last_stage"]

#: Edges and seeds of a part that is walked within its row.
FEW_EDGES = 128
#: A state's place and its last stage, both numbered within the part, share one bigint.
BITS = 20


def walk_paths(edges: DataFrame, seeds: DataFrame, *, few: int = FEW_EDGES) -> DataFrame:
    """Stages reachable by each part, with the last material stage on the way.

    ``edges``: ``part, from_site, from_stage, to_site, to_stage, kind`` where kind
    'BOM' replaces the carried stage and any other kind keeps it. ``seeds``:
    ``part, site, stage``. Returns the distinct states with the step they were
    first reached at.

    The walk is breadth first over states, not over paths: a state met again is
    dropped, so parallel routes do not multiply and a cycle ends by itself. Parts do not meet,
    so a part with at most ``few`` edges and seeds, repeats included, becomes one row and is walked there, all
    rounds in one pass over the rows: its edges and seeds are shuffled once. Parts with more are
    walked together, one join of the frontier with the edges for each round.
    """
    hops = edges.where(
        F.col("part").isNotNull() & F.col("from_site").isNotNull() & F.col("from_stage").isNotNull()
    ).select("part", "from_site", "from_stage", "to_site", "to_stage", "kind")
    starts = seeds.select("part", "site", "stage")
    lone = starts.where(F.col("part").isNull()).distinct()  # no edge has a part that is missing
    starts = starts.where(F.col("part").isNotNull())
    crowded = (
        hops.select("part").unionByName(starts.select("part")).groupBy("part").agg(F.count("*").alias("_n"))
        .where(F.col("_n") > few)
        .select("part")
    )
    out = lone.select(*starts.columns, F.col("stage").alias("last_stage"), F.lit(1).alias("step"))
    number = crowded.count()
    if not number:
        return out.unionByName(_walk_rows(hops, starts))
    crowded = broadcast_bounded(crowded, number)
    small, large = ([df.join(crowded, "part", how) for df in (hops, starts)] for how in ("left_anti", "left_semi"))
    return out.unionByName(_walk_rows(*small)).unionByName(_walk_rounds(*large))


def _walk_rows(hops: DataFrame, starts: DataFrame) -> DataFrame:
    """All rounds of a part in its row. Places and stages are numbered within the part; a
    list holds the states found in each round, and a round without new ones ends it."""
    hop = F.struct("from_site", "from_stage", "to_site", "to_stage", "kind")
    start = F.struct("site", "stage")
    kind = lambda df, c: df.select(c.alias("s")).schema["s"].dataType
    both = hops.select("part", hop.alias("_hop"), F.lit(None).cast(kind(starts, start)).alias("_start")).unionByName(
        starts.select("part", F.lit(None).cast(kind(hops, hop)).alias("_hop"), start.alias("_start"))
    )
    place = lambda site, stage: F.struct(site.alias("site"), stage.alias("stage"))
    text = lambda c: F.coalesce(F.concat(F.length(c.cast("string")), F.lit(":"), c.cast("string")), F.lit("-"))
    known = lambda site, stage: F.concat(text(site), text(stage))
    ends = lambda f: F.concat(
        F.transform("_starts", lambda s: f(s.site, s.stage)),
        F.transform("_hops", lambda e: f(e.from_site, e.from_stage)),
        F.transform("_hops", lambda e: f(e.to_site, e.to_stage)),
    )
    # the number of a place or stage is where its text stands first in the list; a missing name has a text, too
    rows = (
        both.groupBy("part")
        .agg(F.collect_list("_hop").alias("_hops"), F.collect_list("_start").alias("_starts"))
        .where(F.size("_starts") > 0)
        .withColumns({"_places": ends(place), "_names": ends(known), "_stages": ends(lambda _, stage: text(stage))})
    )
    at = lambda site, stage: F.array_position("_names", known(site, stage))
    number = lambda stage: F.array_position("_stages", text(stage))
    state = lambda here, last: F.shiftleft(here, BITS).bitwiseOR(last)
    of = lambda s: F.shiftright(s, BITS)
    last = lambda s: s.bitwiseAND(F.lit((1 << BITS) - 1).cast("bigint"))

    moves = F.transform(
        "_hops",
        lambda e: F.struct(
            at(e.from_site, e.from_stage).alias("here"),
            at(e.to_site, e.to_stage).alias("there"),
            F.when(e.kind == "BOM", number(e.to_stage)).alias("stage"),  # null: the carried one stays
        ),
    )
    first = F.array_distinct(F.transform("_starts", lambda s: state(at(s.site, s.stage), number(s.stage))))

    def further(walk: Column) -> Column:
        found = walk.getField("found")
        reached = F.flatten(
            F.transform(
                F.element_at(found, -1),
                lambda s: F.transform(
                    F.filter(walk.getField("moves"), lambda m: m.here == of(s)),
                    lambda m: state(m.there, F.coalesce(m.stage, last(s))),
                ),
            )
        )
        fresh = F.array_except(reached, F.flatten(found))
        longer = F.struct(walk.getField("moves").alias("moves"), F.concat(found, F.array(fresh)).alias("found"))
        return F.when(F.size(F.element_at(found, -1)) == 0, walk).otherwise(longer)

    # every round but the last finds a state; the moves go along, so that they are numbered once
    most = F.sequence(F.lit(1), F.size(F.array_distinct("_names")) * F.size(F.array_distinct("_stages")) + 1)
    walked = rows.select(
        "part", "_places",
        F.aggregate(most, F.struct(moves.alias("moves"), F.array(first).alias("found")), lambda walk, _: further(walk))
        .getField("found").alias("_found"),
    )

    def named(s: Column, turn: Column) -> Column:
        here = F.element_at("_places", of(s).cast("int"))
        return F.struct(
            here.site.alias("site"), here.stage.alias("stage"),
            F.element_at("_places", last(s).cast("int")).stage.alias("last_stage"),
            (turn + 1).alias("step"),
        )

    states = F.flatten(F.transform("_found", lambda of_round, turn: F.transform(of_round, lambda s: named(s, turn))))
    return walked.select("part", F.inline(states))


def _walk_rounds(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """A round for all parts at a time. Each is one equi join of the frontier with the edges; the frontier is
    checkpointed to shared storage, which keeps the plan small and survives lost
    executors. Once the counted frontier is small it is broadcast, so the long tail
    of short rounds shuffles neither edges nor visited states. There are finitely many
    states and none is visited twice, so the walk ends when a round finds nothing new.
    """
    hops = cut_lineage(edges.distinct())
    frontier = cut_lineage(
        seeds.select("part", "site", "stage", F.col("stage").alias("last_stage")).distinct()
        .withColumn("step", F.lit(1))
    )
    seen, size = frontier, frontier.count()
    for depth in itertools.count(2):
        near = seen
        if size <= BROADCAST_ROW_LIMIT:
            parts = broadcast_bounded(frontier.select("part").distinct(), size)
            near = seen.join(parts, "part", "left_semi")
        stepped = (
            broadcast_bounded(frontier, size).alias("f")
            .join(
                hops.alias("h"),
                (F.col("f.part") == F.col("h.part"))
                & (F.col("f.site") == F.col("h.from_site"))
                & (F.col("f.stage") == F.col("h.from_stage")),
            )
            .select(
                "f.part",
                F.col("h.to_site").alias("site"),
                F.col("h.to_stage").alias("stage"),
                F.when(F.col("h.kind") == "BOM", F.col("h.to_stage"))
                .otherwise(F.col("f.last_stage"))
                .alias("last_stage"),
            )
            .distinct()
        )
        # Null-safe on the stages, which may be missing at the end of a route.
        fresh = stepped.alias("n").join(
            near.alias("o"),
            (F.col("n.part") == F.col("o.part"))
            & F.col("n.site").eqNullSafe(F.col("o.site"))
            & F.col("n.stage").eqNullSafe(F.col("o.stage"))
            & F.col("n.last_stage").eqNullSafe(F.col("o.last_stage")),
            "left_anti",
        )
        frontier = cut_lineage(fresh.withColumn("step", F.lit(depth)))
        size = frontier.count()
        if size == 0:
            return seen
        seen = seen.unionByName(frontier)

"""Connected components of a table of links, by alternating large-star and small-star steps.

Before the first step and after each pass every task shortens its links to stars, a bounded
number at a time, so that few passes are left. A step is a grouped minimum joined back; a hub with any
number of links is split over tasks. The minima of at most ``BROADCAST_LINKS`` links are
broadcast, so that a pass shuffles nothing but partial minima. Steps never make more links of
fewer, and repeated links do no harm, so none are looked for. Each pass is written to shared
storage: lineage stays short and a lost executor costs one pass at most. The passes end when
all links are stars.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_arrow, stored
from tidemark.operators.skew import attach

#: Links that a task holds while it shortens them.
TASK_LINKS = 1 << 18
#: Links whose least neighbours are broadcast; those of more are joined by a shuffle.
BROADCAST_LINKS = 1_000_000


def shortened(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of the same components: each node but the least of a component, with the least."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while len(a):
        least = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], least)
        np.minimum.at(root, root[b], least)
        while (root[root] != root).any():
            root = root[root]
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _shorten(most: int):
    """Links of a task as stars, with ``most`` links held at a time."""

    def batch(u, v):
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    def run(batches):
        u = v = np.zeros(0, np.int64)
        for rows in batches:
            u, v = (np.concatenate([have, rows.column(c).to_numpy()]) for have, c in ((u, "u"), (v, "v")))
            if len(u) < most:
                continue
            u, v = shortened(u, v)
            if 2 * len(u) >= most:  # little was saved
                yield batch(u, v)
                u = v = np.zeros(0, np.int64)
        yield batch(*shortened(u, v))

    return run


def _both_ways(links: DataFrame) -> DataFrame:
    """Every link from either end."""
    return links.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))


def _smallest(links: DataFrame, few: bool) -> DataFrame:
    """``u``, neighbour ``v`` and ``m``, the least of u and all its neighbours in ``links``."""
    least = links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return links.join(F.broadcast(least), "u") if few else attach(links, least, ["u"])


def _all_stars(links: DataFrame) -> bool:
    """Whether every node with a lesser neighbour has one such, and that one has none."""
    none = F.lit(None).cast("bigint")
    ends = F.array(F.struct(F.col("u").alias("node"), "v"), F.struct(F.col("v").alias("node"), none.alias("v")))
    nodes = links.select(F.inline(ends)).groupBy("node").agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.max(F.isnull("v")).alias("named")
    )
    return nodes.where("lo < hi or (named and lo is not null)").isEmpty()


def _written(links: DataFrame) -> DataFrame:
    return stored(in_arrow(links, _shorten(TASK_LINKS), "u bigint, v bigint"), "links")


def stars(links: DataFrame) -> DataFrame:
    """``u`` and ``v``: every node of ``links`` (u, v) but the least of its component, with the least; rows may repeat.

    No step raises the least neighbour of a node, and while one of them falls there are passes; if none falls in a pass,
    each node is linked with the least of its component, and the next pass leaves stars only.
    """
    found = _written(links.select(*[F.col(c).cast("bigint").alias(c) for c in "uv"]))
    few = found.count() <= BROADCAST_LINKS
    while not _all_stars(found):
        large = _smallest(_both_ways(found), few).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _smallest(large, few)
        # a node keeps its least neighbour, its other neighbours are handed to that one
        higher = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
        found = _written(small.select(higher.alias("u"), F.col("m").alias("v")))
    return found


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for every node of ``links`` (u, v)."""
    edges = stars(links).distinct()
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)

"""Near duplicates by 64-bit SimHash fingerprints and pigeonhole blocks.

Fingerprint: every word shingle of a text, repeats included, is hashed (XXH64, seed 42);
bit i of the fingerprint is set if bit i is set in more than half of the hashes.

Search: a fingerprint is cut into ``m`` blocks. Two fingerprints that differ in at most
``most`` bits agree in at least ``m - most`` blocks, so they share one of the keys that
keep ``m - most`` blocks and blank the others. ``m`` is the least number of blocks whose keys
tell as many values apart as there are fingerprints; every ``m`` finds the same pairs.
Rows are joined on the keys, and members of a bucket are verified by their Hamming distance.

Bounds: equal fingerprints are one node, so copies never meet. A bucket of more than
``MOST_MEMBERS`` fingerprints is cut again by the same principle over the bits its key leaves
open; once ``OPEN_BITS`` or fewer are open a bucket cannot be larger than the limit. So no
task gets a larger bucket. A bucket yields the links of a spanning forest, never its pairs.

Defined cases: a text of fewer words than a shingle is one shingle; a null text and one without
words have fingerprint zero and are linked like any other; rows without an id link others but
give a component no id, which is null if no member has one; repeated rows are separate rows;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, by_block, stored
from tidemark.llm.components import components
from tidemark.operators.skew import attach

BITS = 64
SEED = 42
#: Bytes of a text whose shingles are held at once.
PIECE = 1 << 20
#: Open bits of a key, and so the largest number of distinct fingerprints in a bucket of a task.
OPEN_BITS = 14
MOST_MEMBERS = 1 << OPEN_BITS
#: Buckets up to this size are compared together, offset by offset.
SMALL = 16
#: The most blocks a fingerprint is cut into at first: keys of 42 bits.
MOST_BLOCKS = 12

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_LOWER = LOWER.tobytes()
_digest = xxhash.xxh64_intdigest


# ---- fingerprints --------------------------------------------------------------------


def shingle_hashes(data: bytes, size: int) -> Iterator[np.ndarray]:
    """Hashes of all shingles of a text, a piece of it at a time."""
    carry: list[bytes] = []
    at, full = 0, False
    while at < len(data):
        cut = _SPACE.search(data, at + PIECE)
        to = cut.start() if cut else len(data)
        words = carry + data[at:to].translate(_LOWER).split()
        if len(words) >= size:
            joined = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words])
            starts = (ends[: len(words) - size + 1] - [len(w) + 1 for w in words[: len(words) - size + 1]]).tolist()
            spans = zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True)
            yield np.fromiter((_digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(starts))
            full = True
        carry, at = words[-(size - 1) :] if size > 1 and len(words) >= size else [] if len(words) >= size else words, to
    if carry and not full:
        yield np.array([_digest(b" ".join(carry), SEED)], np.uint64)


def fingerprint(data: bytes, size: int) -> int:
    """SimHash of one text, as a signed 64-bit integer."""
    total, ones = 0, np.zeros(BITS, np.int64)
    for hashes in shingle_hashes(data, size):
        total += len(hashes)
        for at in range(0, len(hashes), 8192):
            part = hashes[at : at + 8192].view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0])


def _mark_block(size: int):
    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        texts = block.column("text").cast(pa.large_binary()).to_pylist()
        marks = [fingerprint(t, size) if t else 0 for t in texts]
        return pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(marks, pa.int64())], names=["doc_id", "mark"])

    return work


def marks(docs: DataFrame, size: int = 4) -> DataFrame:
    """``doc_id`` and ``mark``, the fingerprint as a long, of each row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(by_block(_mark_block(size)), "doc_id bigint, mark bigint")


# ---- keys ----------------------------------------------------------------------------


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def masks(open_bits: list[int], blocks: int, most: int) -> list[int]:
    """Masks of the open bits that keep all but ``most`` of ``blocks`` even blocks."""
    cuts = [len(open_bits) * i // blocks for i in range(blocks + 1)]
    parts = [sum(1 << b for b in open_bits[x:y]) for x, y in zip(cuts, cuts[1:], strict=False)]
    return [sum(keep) for keep in combinations(parts, blocks - most)]


def first_masks(fingerprints: int, most: int) -> list[int]:
    """Masks of the first keys: the fewest blocks whose keys have as many values as there are fingerprints."""
    blocks = most + 2
    while blocks < MOST_BLOCKS and (1 << (BITS // blocks) * (blocks - most)) < fingerprints:
        blocks += 1
    return masks(list(range(BITS)), blocks, most)


def finer_masks(mask: int, most: int) -> list[int]:
    """Masks that refine ``mask``: the same principle over the bits that it leaves open."""
    open_bits = [b for b in range(BITS) if not mask >> b & 1]
    return [mask | m for m in masks(open_bits, most + 2, most)]


# ---- buckets -------------------------------------------------------------------------


def _forest(fp: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of a spanning forest of the fingerprints of one bucket."""
    left = fp.copy()
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            node = front.pop()
            near = np.bitwise_count(left ^ node) <= most
            if near.any():
                met = left[near]
                yield np.full(len(met), node), met
                front.extend(met)
                left = left[~near]


def bucket_links(group: np.ndarray, fp: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the groups; ``group`` is ascending."""
    bounds = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]])
    sizes = np.diff(bounds)
    found = []
    small = np.repeat(sizes <= SMALL, sizes)
    g, f = group[small], fp[small]
    for step in range(1, SMALL):
        here = np.flatnonzero(g[:-step] == g[step:])
        if not len(here):
            break
        near = here[np.bitwise_count(f[here] ^ f[here + step]) <= most]
        found.append((f[near], f[near + step]))
    for k in np.flatnonzero(sizes > SMALL):
        found.extend(_forest(fp[bounds[k] : bounds[k + 1]], most))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate([u for u, _ in found]), np.concatenate([v for _, v in found])


def _linker(most: int):
    def links(mask, value, mark):
        new = np.zeros(len(mask), np.int64)
        new[1:] = (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])
        u, v = bucket_links(np.cumsum(new), mark.view(np.uint64), most)
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    def run(batches):
        kept = None  # the last bucket of what has come may go on in the next batch
        for batch in batches:
            got = [batch.column(c).to_numpy() for c in ("mask", "value", "mark")]
            if not len(got[0]):
                continue
            if kept is not None:
                got = [np.concatenate(x) for x in zip(kept, got, strict=True)]
            last = (got[0] == got[0][-1]) & (got[1] == got[1][-1])
            kept = [c[last] for c in got]
            if not last.all():
                yield links(*[c[~last] for c in got])
        if kept is not None:
            yield links(*kept)

    return run


def _keyed(rows: DataFrame) -> DataFrame:
    """``mask``, ``value`` and ``mark`` from ``mark`` and the array ``into`` of masks."""
    rows = rows.select("mark", F.explode("into").alias("mask"))
    return rows.select("mask", F.col("mark").bitwiseAND(F.col("mask")).alias("value"), "mark")


def links(nodes: DataFrame, most: int = 4, most_members: int = MOST_MEMBERS) -> DataFrame:
    """Links (u, v) that connect all pairs of the distinct ``mark`` of ``nodes`` within ``most`` bits."""
    first = first_masks(nodes.count(), most)
    into = F.array(*[F.lit(_signed(m)) for m in first])
    rows = _keyed(nodes.select("mark", into.alias("into")))
    out = None
    while True:
        counts = rows.groupBy("mask", "value").agg(F.count("*").alias("n")).where("n > 1")
        shared = stored(attach(rows, counts, ["mask", "value"], "inner"), "simhash-members")
        fits = shared.where(F.col("n") <= most_members).select("mask", "value", "mark")
        fits = fits.repartition("mask", "value").sortWithinPartitions("mask", "value")
        found = stored(fits.mapInArrow(_linker(most), "u bigint, v bigint"), "simhash-links")
        out = found if out is None else out.unionByName(found)
        large = shared.where(F.col("n") > most_members)
        hot = [r.mask for r in large.select("mask").distinct().collect()]  # at most one row a mask
        hot = [m for m in hot if BITS - (m & (2**BITS - 1)).bit_count() > OPEN_BITS or most_members < MOST_MEMBERS]
        finer = {m: [f for f in finer_masks(m & (2**BITS - 1), most) if f != m & (2**BITS - 1)] for m in hot}
        finer = {m: f for m, f in finer.items() if f}
        if not finer:
            return out
        table = [(m, [_signed(f) for f in fine]) for m, fine in finer.items()]
        table = nodes.sparkSession.createDataFrame(table, "mask bigint, into array<bigint>")
        rows = _keyed(large.join(F.broadcast(table), "mask").select("mark", "into")).distinct()


def near_duplicates(docs: DataFrame, size: int = 4, most: int = 4) -> DataFrame:
    """``doc_id``, ``fingerprint`` in hexadecimal and ``component_id`` of each row of ``docs``.

    ``size`` words make a shingle; fingerprints of at most ``most`` different bits are linked.
    """
    rows = stored(marks(docs, size), "simhash-marks")
    nodes = stored(rows.groupBy("mark").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    roots = components(links(nodes.select("mark"), most)).select(F.col("node").alias("mark"), "component")
    nodes = attach(nodes, roots, ["mark"]).withColumn("component", F.coalesce("component", "mark"))
    least = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    nodes = attach(nodes, least, ["component"]).select("mark", "component_id")
    found = attach(rows, nodes, ["mark"])
    return found.select("doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id")

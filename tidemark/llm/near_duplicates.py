"""Near duplicates by fast similarity sketches, banding and exact verification.

Sketch: a document's set of word shingles is thrown into bins in rounds. In round i every
shingle falls into a hashed bin with a hashed value; a bin keeps the least value of its
first round with any. Most documents fill all bins in two or three rounds; from round
``BINS`` on, round i puts every shingle into bin i - BINS, so that no bin stays empty.
Two sets agree in a bin with the probability of their Jaccard similarity, and the share
of agreeing bins is concentrated as with independent functions.

Banding: bins are hashed in ``BANDS`` bands of ``ROWS``; documents with a common band are
candidates. A pair of similarity 0.8 has no common band with probability 3e-6.

Verification: candidates are confirmed on the full shingle sets. Documents with equal sets
are one class and are never paired. In a bucket, members are first compared with one pivot
in each of ``PIVOT_ROUNDS`` rounds, and a bucket whose members are all connected is done: a group
of n near copies costs about n comparisons a band. What is left of a bucket is then compared
within one task, on sizes and one-bit sketches first and on the sets of those that may be alike;
the task gives back links of a spanning forest, never pairs. A bucket with more than
``SLICE_ROWS`` open members or ``SLICE_SHINGLES`` shingles is cut into slices, and each two slices
are compared by a task of their own, so that what a task holds is bounded. So no pair of candidates goes unanswered.
A pair of similarity 0.8 is lost by the one-bit sketches with probability below 1e-6.

Defined cases: documents without words have an empty set and are linked with nothing;
equal rows are linked; every row takes part, also one without an id or with one that others
have; a component without any id is null; other columns are not read by ``near_duplicates``
and kept by ``keep_one``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import NOT_SPACE, Words, by_block, in_arrow, lists, mix, stored, without
from tidemark.llm.components import stars
from tidemark.operators.skew import attach

BINS = 160
ROWS = 5
BANDS = BINS // ROWS
#: Differing one-bit sketches of a pair that is still compared; 16 are expected at a similarity of 0.8.
MOST_BITS = 36
#: Texts that are picked by a broadcast of their hashes; more are joined by a shuffle.
BROADCAST_TEXTS = 1_000_000
#: Rounds in which the members of a bucket are compared with a pivot; more rounds cost more than they save the tasks after.
PIVOT_ROUNDS = 1
#: Members and shingles of a slice of a bucket; a task compares two slices.
SLICE_ROWS = 1024
SLICE_SHINGLES = 500_000
#: Members whose likeness to all others is looked at at once.
LOOK_ROWS = 256

SKETCH = (
    "doc_id bigint, h1 bigint, h2 bigint, n_shingles bigint, key binary, bands array<bigint>, "
    "b0 bigint, b1 bigint, b2 bigint"
)
#: Columns by which members of a bucket are first compared: size of the set and one-bit sketch.
LOOKS = ("n", "b0", "b1", "b2")
_STEP = np.uint64(0xD6E8FEB86659FD93)
_LARGEST = np.uint64(2**64 - 1)
_SEEDS = np.arange(1, 2 * BINS + 1, dtype=np.uint64) * _STEP


def _chain(ids: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Id of the ``n`` words from ``at`` on."""
    h = np.full(len(at), n, np.uint64)
    for k in range(n):
        h = mix(h * _STEP + ids[at + k])
    return h


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle ids of each text, ascending, and the bounds of the texts in them."""
    words = Words(texts, NOT_SPACE)
    ids, first, counts = words.ids(), words.first_word[:-1], words.counts
    many = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(many)])
    values = np.zeros(bounds[-1], np.uint64)
    full = np.repeat(counts >= size, many)
    at = np.repeat(first - bounds[:-1], many) + np.arange(bounds[-1])
    values[full] = _chain(ids, at[full], size)
    for n in range(1, size):
        short = np.flatnonzero(counts == n)
        values[bounds[short]] = _chain(ids, first[short], n)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a > 1:
            values[a:b].sort()
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    new[bounds[:-1][many > 0]] = True
    kept = np.concatenate([[0], np.cumsum(new)])
    return values[new], kept[bounds]


def sketches(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Fast similarity sketch of each non-empty set: an array of ``BINS`` 64-bit values."""
    n = len(bounds) - 1
    out = np.full((n, BINS), _LARGEST, np.uint64)
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(n), sizes)
    live = values
    for turn in range(2 * BINS):
        h = mix(live + _SEEDS[turn])
        if turn < BINS:
            into = ((h >> np.uint64(40)) * np.uint64(BINS) >> np.uint64(24)).astype(np.int64)
        else:
            into = np.full(len(h), turn - BINS)
        place = owner * BINS + into
        flat = out.reshape(-1)
        open_ = flat[place] == _LARGEST  # filled in an earlier round otherwise
        place, h = place[open_], h[open_]
        order = np.argsort(h)[::-1]  # the least value of a bin is written last
        flat[place[order]] = h[order]
        if turn < 4 or turn % 8 == 0:
            empty = (out == _LARGEST).any(axis=1) & (sizes > 0)
            if not empty.any():
                break
            stay = empty[owner]
            owner, live = owner[stay], live[stay]
    return out


def _sketch_block(size: int):
    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        values, bounds = shingle_sets(block.column("text"), size)
        filled = np.diff(bounds) > 0
        bins = sketches(values, bounds)
        bands = np.zeros((len(bins), BANDS), np.uint64)
        for k in range(BANDS):
            h = np.full(len(bins), k + 1, np.uint64)
            for j in range(ROWS):
                h = mix(h * _STEP + bins[:, k * ROWS + j])
            bands[:, k] = h
        bits = np.zeros((len(bins), 192), np.uint8)
        bits[:, :BINS] = (bins >> np.uint64(17)).astype(np.uint8) & 1
        packed = np.packbits(bits, axis=1).view(np.int64)
        keys = [
            hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest() if b > a else None
            for a, b in zip(bounds[:-1], bounds[1:], strict=True)
        ]
        cut = np.arange(len(bins) + 1) * BANDS
        return pa.RecordBatch.from_arrays(
            [
                *(block.column(c) for c in ("doc_id", "h1", "h2")),
                pa.array(np.diff(bounds), pa.int64()),
                pa.array(keys, pa.binary()),
                lists(bands.reshape(-1).view(np.int64), cut, pa.int64()),
                *(pa.array(np.ascontiguousarray(packed[:, k]), mask=~filled) for k in range(3)),
            ],
            names=["doc_id", "h1", "h2", "n_shingles", "key", "bands", "b0", "b1", "b2"],
        )

    return work


def _verify(size: int, percent: int):
    """Pairs (a, b) whose sets have percent * union <= 100 * intersection."""

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        left, lb = shingle_sets(block.column("text_a"), size)
        right, rb = shingle_sets(block.column("text_b"), size)
        keep = np.zeros(len(block), bool)
        for i in range(len(block)):
            x, y = left[lb[i] : lb[i + 1]], right[rb[i] : rb[i + 1]]
            at = np.minimum(np.searchsorted(y, x), max(len(y) - 1, 0))
            common = int((y[at] == x).sum()) if len(y) else 0
            keep[i] = common and 100 * common >= percent * (len(x) + len(y) - common)
        return block.select(["a", "b"]).filter(pa.array(keep))

    return work


class _Pairs:
    """Compares candidate pairs on the texts of the classes."""

    def __init__(self, texts: DataFrame, size: int, percent: int):
        self.texts, self.size, self.percent = texts, size, percent

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs that sizes and one-bit sketches, columns ``_a`` and ``_b``, allow."""
        off = sum((F.bit_count(F.col(f"b{k}_a").bitwiseXOR(F.col(f"b{k}_b"))) for k in range(3)), F.lit(0))
        near = 100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b")
        return pairs.where(near & (off <= MOST_BITS))

    def links(self, pairs: DataFrame) -> DataFrame:
        rows = pairs
        for side in "ab":
            texts = self.texts.select(F.col("node").alias(side), F.col("text").alias(f"text_{side}"))
            rows = rows.join(texts, side)
        found = in_arrow(rows, by_block(_verify(self.size, self.percent), "text_a", 1 << 20), "a bigint, b bigint")
        return stored(found.select(F.col("a").alias("u"), F.col("b").alias("v")), "near-links")


def _open_members(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members of buckets that hold more than one component, with their component."""
    if labels is None:
        return members.withColumn("component", F.col("node"))
    rows = attach(members, labels, ["node"]).withColumn("component", F.coalesce("component", "node"))
    mixed = rows.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    return stored(attach(rows, mixed.select("band"), ["band"], "left_semi"), "near-open")


def _pivot_pairs(members: DataFrame, turn: int, pairs: _Pairs) -> DataFrame:
    """Every member with the pivot of its bucket, if they are of different components and may be alike."""
    order = F.xxhash64("node", F.lit(turn)) if turn else F.col("node")
    first = F.min(F.struct(order.alias("order"), "node", "component", *LOOKS))
    pivots = members.groupBy("band").agg(first.alias("p"))
    pivots = pivots.select("band", *[F.col(f"p.{c}").alias(f"{c}_b") for c in ("node", "component", *LOOKS)])
    rows = attach(members.withColumnsRenamed({c: f"{c}_a" for c in LOOKS}), pivots, ["band"])
    rows = pairs.likely(rows.where("component <> component_b"))
    return rows.select(F.greatest("node", "node_b").alias("a"), F.least("node", "node_b").alias("b")).distinct()


# ---- comparing what is left of a bucket ----------------------------------------------


def whole_groups(batches, keys: list[str]):
    """Batches that end where a group of equal ``keys`` ends; rows come sorted by them."""
    kept = None
    for batch in batches:
        rows = batch if kept is None else pa.concat_batches([kept, batch])
        if not len(rows):
            continue
        values = [rows.column(k).to_numpy() for k in keys]
        first = int(np.argmax(np.logical_and.reduce([v == v[-1] for v in values])))
        if first:
            yield rows.slice(0, first)
        kept = rows.slice(first)
    if kept is not None:
        yield kept


def _bounds(rows: pa.RecordBatch) -> np.ndarray:
    """Bounds of the groups of equal band and cell."""
    band, cell = (rows.column(c).to_numpy() for c in ("band", "cell"))
    new = np.flatnonzero((band[1:] != band[:-1]) | (cell[1:] != cell[:-1])) + 1
    return np.concatenate([[0], new, [len(band)]])


class _Group:
    """Members of one cell: which may be alike by component, size and one-bit sketch."""

    def __init__(self, rows: pa.RecordBatch, percent: int):
        self.component, self.part, self.n = (rows.column(c).to_numpy() for c in ("component", "part", "n"))
        self.bits = [rows.column(f"b{k}").to_numpy().view(np.uint64) for k in range(3)]
        self.two_slices = self.part.min() != self.part.max()
        self.percent = percent

    def likely(self, a: int, b: int) -> np.ndarray:
        """Table of rows ``a`` to ``b`` against all rows."""
        at = slice(a, b)
        n, m = self.n[at, None], self.n[None, :]
        out = self.component[at, None] != self.component[None, :]
        out &= 100 * np.minimum(n, m) >= self.percent * np.maximum(n, m)
        if self.two_slices:
            out &= self.part[at, None] != self.part[None, :]
        off = sum(np.bitwise_count(x[at, None] ^ x[None, :]).astype(np.uint16) for x in self.bits)
        return out & (off <= MOST_BITS)


def _alive(percent: int):
    """Members that may be like another of their cell."""

    def run(batches):
        for rows in whole_groups(batches, ["band", "cell"]):
            keep = np.zeros(len(rows), bool)
            bounds = _bounds(rows)
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                if b - a > 1:
                    group = _Group(rows.slice(a, b - a), percent)
                    for at in range(0, b - a, LOOK_ROWS):
                        to = min(at + LOOK_ROWS, b - a)
                        keep[a + at : a + to] = group.likely(at, to).any(axis=1)
            yield rows.filter(pa.array(keep))

    return run


def group_links(rows: pa.RecordBatch, percent: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the members of one cell, by their sets."""
    group, nodes = _Group(rows, percent), rows.column("node").to_numpy()
    sets = rows.column("set")
    cut = np.concatenate([[0], np.cumsum(group.n)])
    _, codes = np.unique(sets.flatten().to_numpy(), return_inverse=True)
    mark = np.zeros(codes.max() + 1, bool)
    component = group.component.copy()
    found = []
    for at in range(0, len(rows), LOOK_ROWS):
        table = group.likely(at, min(at + LOOK_ROWS, len(rows)))
        for i in range(at, at + len(table)):
            other = np.flatnonzero(table[i - at, :i])
            other = other[component[other] != component[i]]
            if not len(other):
                continue
            sizes = group.n[other]
            ends = np.cumsum(sizes)
            place = np.repeat(cut[other] - (ends - sizes), sizes) + np.arange(ends[-1])
            own = codes[cut[i] : cut[i + 1]]
            mark[own] = True
            common = np.add.reduceat(mark[codes[place]], ends - sizes, dtype=np.int64)
            mark[own] = False
            alike = other[100 * common >= percent * (group.n[i] + sizes - common)]
            for j in alike:
                if component[j] != component[i]:
                    found.append((int(nodes[i]), int(nodes[j])))
                    component[component == component[j]] = component[i]
    return found


def _linker(percent: int):
    def run(batches):
        for rows in whole_groups(batches, ["band", "cell"]):
            bounds = _bounds(rows)
            found = []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                if b - a > 1:
                    found.extend(group_links(rows.slice(a, b - a), percent))
            u, v = np.array(found, np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return run


def _cells(members: DataFrame) -> DataFrame:
    """Members with the ``cell`` of their bucket: a bucket itself, or each two of its slices."""
    per = members.groupBy("band").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    slices = F.ceil(F.greatest(F.col("c") / SLICE_ROWS, F.col("s") / SLICE_SHINGLES)).cast("bigint").alias("slices")
    rows = attach(members, per.select("band", slices), ["band"])
    rows = rows.withColumn("part", F.pmod(F.xxhash64("node"), F.col("slices")))
    other = F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)
    cells = F.transform(other, lambda t: F.least("part", t) * F.col("slices") + F.greatest("part", t))
    return rows.withColumn("cell", F.explode(cells)).drop("slices")


def _sets(texts: DataFrame, size: int) -> DataFrame:
    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        values, bounds = shingle_sets(block.column("text"), size)
        return pa.RecordBatch.from_arrays([block.column("node"), lists(values.view(np.int64), bounds, pa.int64())], names=["node", "set"])

    return in_arrow(texts, by_block(work), "node bigint, set array<bigint>")


def _within(members: DataFrame, pairs: _Pairs) -> DataFrame:
    """Links between members of one bucket and different components."""
    dealt = _cells(members).repartition("band", "cell").sortWithinPartitions("band", "cell")
    alive = stored(in_arrow(dealt, _alive(pairs.percent), dealt.schema), "near-alive")
    texts = attach(pairs.texts, alive.select("node").distinct(), ["node"], "left_semi")
    dealt = attach(alive, _sets(texts, pairs.size), ["node"], "inner")
    dealt = dealt.repartition("band", "cell").sortWithinPartitions("band", "cell")
    return stored(in_arrow(dealt, _linker(pairs.percent), "u bigint, v bigint"), "near-links")


def _class_texts(docs: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """One text of each class in ``nodes``, found by its hash."""
    picked = attach(classes.select("node", "pick.*"), nodes, ["node"], "left_semi")
    picked = stored(picked.withColumnRenamed("doc_id", "_id"), "near-picked")
    rows = _hashed(docs).where("text is not null")
    n = picked.count()
    few = n <= BROADCAST_TEXTS
    same = rows.h1.eqNullSafe(picked.h1) & (rows.h2 == picked.h2) & rows.doc_id.eqNullSafe(picked._id)
    rows = rows.join(F.broadcast(picked) if few else picked, same).select("node", "text")
    rows = stored(rows, "near-texts")
    if rows.count() == n:
        return rows
    return stored(rows.groupBy("node").agg(F.first("text").alias("text")), "near-texts")  # repeated rows


def _hashed(docs: DataFrame) -> DataFrame:
    hashes = [F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2")]
    return docs.select(F.col("doc_id").cast("bigint"), "text", *hashes)


def class_components(docs: DataFrame, sketched: DataFrame, size: int, percent: int) -> DataFrame:
    """``key`` (of a shingle set) and ``component``, the smallest document id it is linked with."""
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h1", "h2")
    classes = sketched.where("key is not null").groupBy("key").agg(
        F.min("doc_id").alias("least"), F.min(row).alias("pick"), F.first("n_shingles").alias("n"),
        *[F.first(c).alias(c) for c in ("b0", "b1", "b2", "bands")],
    )
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "near-classes")
    banded = classes.select("node", F.explode(F.array_distinct("bands")).alias("band"))
    shared = banded.groupBy("band").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    members = attach(banded, shared.select("band"), ["band"], "left_semi")
    members = stored(attach(members, classes.select("node", *LOOKS), ["node"], "inner"), "near-members")
    pairs = _Pairs(_class_texts(docs, classes, members.select("node").distinct()), size, percent)

    links = labels = None  # an empty relation made in Python would start Python workers of its own kind
    for turn in range(PIVOT_ROUNDS + 1):
        left = _open_members(members, labels)
        if left.isEmpty():
            break
        new = pairs.links(_pivot_pairs(left, turn, pairs)) if turn < PIVOT_ROUNDS else _within(left, pairs)
        if not new.isEmpty():
            links = stars(new if links is None else links.unionByName(new))
            labels = links.distinct().select(F.col("u").alias("node"), F.col("v").alias("component"))
    if labels is None:
        return classes.select("key", F.col("least").alias("component"))
    both = attach(classes.select("key", "node", "least"), labels, ["node"])
    both = both.select("key", "least", F.coalesce("component", "node").alias("root"))
    least = both.groupBy("root").agg(F.min("least").alias("component"))
    return attach(both.select("key", "root"), least, ["root"]).select("key", "component")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: its set size, component and whether it is the one to keep.

    ``size`` words make a shingle; documents are linked from a Jaccard similarity of ``percent`` on.
    """
    sketched = stored(in_arrow(_hashed(docs), by_block(_sketch_block(size)), SKETCH), "near-sketches")
    found = attach(sketched.select("doc_id", "n_shingles", "key"), class_components(docs, sketched, size, percent), ["key"])
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    found = found.select("doc_id", "n_shingles", component.alias("component_id"))
    kept = F.when(F.col("component_id").isNull(), True).otherwise(F.col("doc_id").eqNullSafe(F.col("component_id")))
    return found.withColumn("kept", kept)


def keep_one_row(docs: DataFrame, key: str, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group, that of the smallest id; ``key`` is not null and unlike in all rows."""
    found = near_duplicates(docs.select(F.col(key).alias("doc_id"), "text"), size, percent)
    found = found.select(F.col("doc_id").alias(key), "component_id").join(docs.select(key, "doc_id"), key)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", key))
    kept = found.groupBy("component_id").agg(first.alias("m")).select(F.col(f"m.{key}").alias(key))
    return without(docs, attach(found.select(key), kept, [key], "left_anti"), key).select(*docs.columns)


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group; rows without an id are kept."""
    ids = near_duplicates(docs, size, percent).where("kept and doc_id is not null").select("doc_id").distinct()
    named = docs.where("doc_id is not null").select(F.col("doc_id"), F.struct("*").alias("_row")).join(ids, "doc_id")
    turn = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("_row.text")))
    one = named.withColumn("_turn", turn).where("_turn = 1")
    one = one.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
    return one.unionByName(docs.where("doc_id is null"))

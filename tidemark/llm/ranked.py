"""Ranked lexical search over bit-sliced Bloom signatures.

Index: documents of like size form a block. Each document has a Bloom signature of its
(term, level) pairs, level l being present if the term occurs at least 2**l times; a block
stores the signatures turned round, one bitmap of document rows for each signature bit.

Bounds: a query term's bitmap is the intersection of the bitmaps of its hashed bits. Filters
have no misses, so it overestimates where the term (or the level) is. The highest level
bounds the term's frequency and thereby its share of the score for the document's length;
adding the weighted bitmaps of a query's terms gives each document an upper bound.

Search: the documents of the highest bounds are scored exactly on their texts. The least of
a query's ``top`` best scores found is its threshold. Every document whose bound reaches the
threshold is scored exactly as well; all others are provably below. So the result is that of
scoring everything, ties included.

Scores are 64-bit integers. N is the number of documents with a term, L that of all terms,
n that of a document's, df the documents that hold a term; a term weighs
floor(1000 ln((2N + 2) / (2 df + 1))), and a document's m is 25 + (75 n N) div L. A
document's score is the sum over the query's terms, repeats included, of the weight times
(10**9 tf) div (1000 tf + 8 m). Terms are told apart by 64-bit ids.

Bounds of what is held: queries are searched in slices of ``SLICE_TERMS`` terms; a task
keeps ``PROBES`` documents for each query of a slice; a block has at most ``BLOCK_DOCS``
rows and ``BLOCK_BITS`` bits (or one document). Candidates are joined to the texts by a
broadcast below ``BROADCAST_KEYS`` keys, else by a shuffle.

Defined cases: null and empty texts have no terms, are no documents in N and are never
returned; rows that share an id, or have none, are documents of their own (none: last among
equal scores); queries without an id or without terms give nothing; queries that share an id are
separate and joined by no rule: each gives its own ranks; empty tables give an empty result;
other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ALNUM, Words, blocks, lists, mix, stored
from tidemark.operators.skew import attach

TOP = 10
#: A level l is in a signature if the term occurs 2**l times or more.
LEVELS = 5
#: Bits a signature has for each entry, at least; powers of two in all.
BITS_PER_ENTRY = 10
HASHES = 4
BLOCK_DOCS = 512
BLOCK_BITS = 1 << 25
#: Documents scored for each query to find its threshold.
PROBES = 20
SLICE_TERMS = 200_000
BROADCAST_KEYS = 500_000
#: Upper bounds are sums of doubles; they are raised by this share.
ROUNDING = 1e-9

_STEP = np.uint64(0x9FB21C651E98DF25)


# ---- index ---------------------------------------------------------------------------


def term_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, id and frequency of each distinct term of each text, in order; and the terms of each text."""
    words = Words(texts, ALNUM)
    ids, doc = words.ids(), words.doc
    order = np.lexsort((ids, doc))
    ids, doc = ids[order], doc[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return doc[at], ids[at], np.diff(np.append(at, len(ids))), words.counts.astype(np.int64)


def level_ids(ids: np.ndarray, level: int) -> np.ndarray:
    return mix(ids + np.array([level + 1], np.uint64) * _STEP)


def places(entries: np.ndarray, width: int) -> list[np.ndarray]:
    """Signature bits of some entries, an array for each hash."""
    step = mix(entries) | np.uint64(1)
    return [((entries + np.uint64(k) * step) & np.uint64(width - 1)).astype(np.int64) for k in range(HASHES)]


def width_of(entries: np.ndarray) -> np.ndarray:
    """Signature bits of documents with so many entries."""
    least = np.maximum(entries * BITS_PER_ENTRY, 64)
    return np.int64(1) << np.ceil(np.log2(least)).astype(np.int64)


class _Open:
    """Documents of one signature width that wait for their block."""

    def __init__(self, width: int):
        self.width = width
        self.most = max(1, min(BLOCK_DOCS, BLOCK_BITS // width))
        self.keys: list[int] = []
        self.lengths: list[int] = []
        self.entries: list[np.ndarray] = []

    def block(self) -> pa.RecordBatch:
        n = len(self.keys)
        bits = np.zeros((self.width, n), bool)
        row = np.repeat(np.arange(n), [len(e) for e in self.entries])
        for place in places(np.concatenate(self.entries), self.width):
            bits[place, row] = True
        cells = [
            pa.array([self.width], pa.int64()),
            lists(np.array(self.keys, np.int64), np.array([0, n]), pa.int64()),
            lists(np.array(self.lengths, np.int64), np.array([0, n]), pa.int64()),
            pa.array([np.packbits(bits, axis=1).tobytes()], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(cells, names=["width", "keys", "lengths", "slices"])


INDEX = "width bigint, keys array<bigint>, lengths array<bigint>, slices binary"


def _indexer(batches):
    open_: dict[int, _Open] = {}
    for block in blocks(batches, "text"):
        doc, ids, tf, n_terms = term_counts(block.column("text"))
        keys = block.column("key").to_numpy()
        levels = [np.flatnonzero(tf >= 1 << k) for k in range(LEVELS)]
        entry = np.concatenate([level_ids(ids[at], k) for k, at in enumerate(levels)])
        owner = np.concatenate([doc[at] for at in levels])
        order = np.argsort(owner, kind="stable")
        entry, owner = entry[order], owner[order]
        bounds = np.searchsorted(owner, np.arange(len(keys) + 1))
        widths = width_of(np.diff(bounds))
        for i in np.flatnonzero(n_terms):
            into = open_.setdefault(int(widths[i]), _Open(int(widths[i])))
            into.keys.append(int(keys[i]))
            into.lengths.append(int(n_terms[i]))
            into.entries.append(entry[bounds[i] : bounds[i + 1]].copy())
            if len(into.keys) >= into.most:
                yield open_.pop(into.width).block()
    for rest in open_.values():
        yield rest.block()


def _rows(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and a ``key`` by which a row, or an equal one, is found again."""
    doc = F.col("doc_id").cast("bigint")
    return docs.select(doc.alias("doc_id"), "text", F.xxhash64(doc, "text").alias("key")).where("text is not null")


def build_index(docs: DataFrame) -> DataFrame:
    """Signature blocks of ``docs`` (doc_id, text), on shared storage."""
    return stored(_rows(docs).select("key", "text").mapInArrow(_indexer, INDEX), "signatures")


# ---- queries -------------------------------------------------------------------------


class Queries:
    """Terms of some queries: distinct ids, ascending, and for each query term numbers and repeats."""

    def __init__(self, rows: list[tuple[int, str]]):
        doc, ids, tf, _ = term_counts(pa.array([text for _, text in rows], pa.string()))
        self.names = [name for name, _ in rows]
        self.ids = np.unique(ids)
        bounds = np.searchsorted(doc, np.arange(len(rows) + 1))
        number = np.searchsorted(self.ids, ids)
        self.terms = [number[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
        self.repeats = [tf[a:b].astype(np.int64) for a, b in zip(bounds, bounds[1:], strict=False)]

    def weigh(self, n_docs: int, total: int, holders: dict[int, int]) -> None:
        """Set the weights: ``holders`` has the number of documents with a term, by its number."""
        df = [holders.get(t, 0) for t in range(len(self.ids))]
        weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df]
        self.n_docs, self.total = n_docs, total
        self.weights = np.array(weight, np.int64)
        self.factors = [self.weights[t] * r for t, r in zip(self.terms, self.repeats, strict=True)]

    def m(self, lengths: np.ndarray) -> np.ndarray:
        return 25 + (75 * lengths * self.n_docs) // self.total


def share(tf, m):
    """Part of a weight that a term of frequency ``tf`` earns."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


COUNTS = "term int, n bigint"


def _counter(shared):
    """Documents that hold each query term; term -1: documents with a term, -2: all terms."""

    def run(batches):
        ids = shared.value
        held, docs, total = np.zeros(len(ids), np.int64), 0, 0
        for block in blocks(batches, "text"):
            _, found, _, n_terms = term_counts(block.column("text"))
            at = np.minimum(np.searchsorted(ids, found), max(len(ids) - 1, 0))
            same = ids[at] == found if len(ids) else np.zeros(0, bool)
            held += np.bincount(at[same], minlength=len(ids))
            docs, total = docs + int((n_terms > 0).sum()), total + int(n_terms.sum())
        some = np.flatnonzero(held)
        names, values = np.append(some, [-1, -2]), np.append(held[some], [docs, total])
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(values, pa.int64())], names=["term", "n"])

    return run


# ---- upper bounds --------------------------------------------------------------------


class _Bounds:
    """Upper bounds of some queries for the documents of a block."""

    def __init__(self, queries: Queries):
        self.queries = queries
        self.at: dict[int, list[list[np.ndarray]]] = {}

    def _places(self, width: int):
        if width not in self.at:
            if len(self.at) >= 8:
                self.at.clear()
            self.at[width] = [places(level_ids(self.queries.ids, k), width) for k in range(LEVELS)]
        return self.at[width]

    def of(self, block: dict):
        """Keys of the block, and a bound for each query and document."""
        width = block["width"]
        lengths = np.array(block["lengths"], np.int64)
        n, m = len(lengths), self.queries.m(np.array(block["lengths"], np.int64))
        slices = np.frombuffer(block["slices"], np.uint8).reshape(width, -1)
        value = np.zeros((len(self.queries.ids), n))
        held, rows, below = None, np.arange(len(self.queries.ids)), 0
        for level, at in enumerate(self._places(width)):
            maps = slices[at[0][rows]]
            for more in at[1:]:
                maps &= slices[more[rows]]
            held = maps if held is None else held & maps
            some = held.any(axis=1)
            rows, held = rows[some], held[some]
            if not len(rows):
                break
            bound = share((2 << level) - 1, m) if level < LEVELS - 1 else np.full(n, 1_000_000)
            value[rows] += np.unpackbits(held, axis=1, count=n) * (bound - below)
            below = bound
        out = np.zeros((len(self.queries.terms), n))
        for q, (terms, factors) in enumerate(zip(self.queries.terms, self.queries.factors, strict=True)):
            out[q] = factors @ value[terms]
        return np.array(block["keys"], np.int64), np.floor(out * (1 + ROUNDING))


def _blocks_of(batches):
    for batch in batches:
        for i in range(len(batch)):
            yield {c: batch.column(c)[i].as_py() for c in ("width", "keys", "lengths", "slices")}


FOUND = "query int, key bigint, bound double"


def _highest(shared, probes: int):
    """The documents of the highest bounds for each query, ``probes`` of each task."""

    def run(batches):
        bounds = _Bounds(shared.value)
        n = len(shared.value.terms)
        keys, best = np.zeros((n, 0), np.int64), np.zeros((n, 0))
        for block in _blocks_of(batches):
            own, value = bounds.of(block)
            best = np.concatenate([best, value], axis=1)
            keys = np.concatenate([keys, np.broadcast_to(own, value.shape)], axis=1)
            if best.shape[1] > probes:
                first = np.argpartition(-best, probes - 1, axis=1)[:, :probes]
                best, keys = np.take_along_axis(best, first, 1), np.take_along_axis(keys, first, 1)
        q, k = np.nonzero(best > 0)
        cells = [pa.array(q, pa.int32()), pa.array(keys[q, k]), pa.array(best[q, k])]
        yield pa.RecordBatch.from_arrays(cells, names=["query", "key", "bound"])

    return run


def _reaching(shared, least: np.ndarray):
    """All documents whose bound for a query is at least ``least`` of the query."""

    def run(batches):
        bounds = _Bounds(shared.value)
        for block in _blocks_of(batches):
            own, value = bounds.of(block)
            q, k = np.nonzero(value >= least[:, None])
            cells = [pa.array(q, pa.int32()), pa.array(own[k]), pa.array(value[q, k])]
            yield pa.RecordBatch.from_arrays(cells, names=["query", "key", "bound"])

    return run


# ---- exact scores --------------------------------------------------------------------

SCORED = "query int, doc_id bigint, key bigint, score bigint"


def _scorer(shared):
    def run(batches):
        queries = shared.value
        for block in blocks(batches, "text"):
            doc, ids, tf, n_terms = term_counts(block.column("text"))
            at = np.minimum(np.searchsorted(queries.ids, ids), max(len(queries.ids) - 1, 0))
            same = queries.ids[at] == ids if len(queries.ids) else np.zeros(0, bool)
            doc, term, tf = doc[same], at[same], tf[same].astype(np.int64)
            bounds = np.searchsorted(doc, np.arange(len(block) + 1))
            earned = share(tf, queries.m(n_terms)[doc])
            out = []
            for i, asked in enumerate(block.column("queries").to_pylist()):
                own, value = term[bounds[i] : bounds[i + 1]], earned[bounds[i] : bounds[i + 1]]
                for q in asked if len(own) else ():
                    wanted = queries.terms[q]
                    k = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
                    score = int((queries.factors[q] * np.where(own[k] == wanted, value[k], 0)).sum())
                    if score > 0:
                        out.append((q, i, score))
            q, i, score = np.array(out, np.int64).reshape(-1, 3).T
            doc_id, key = (block.column(c).take(pa.array(i)) for c in ("doc_id", "key"))
            cells = [pa.array(q, pa.int32()), doc_id, key, pa.array(score)]
            yield pa.RecordBatch.from_arrays(cells, names=["query", "doc_id", "key", "score"])

    return run


def _score(docs: DataFrame, pairs: DataFrame, shared, name: str) -> DataFrame:
    """Exact scores of the (query, key) ``pairs``."""
    asked = stored(pairs.groupBy("key").agg(F.collect_set("query").alias("queries")), f"{name}-asked")
    rows = _rows(docs)
    few = asked.count() <= BROADCAST_KEYS
    rows = rows.join(F.broadcast(asked), "key") if few else attach(rows, asked, ["key"], "inner")
    return stored(rows.mapInArrow(_scorer(shared), SCORED), f"{name}-scores")


def _first(rows: DataFrame, top: int) -> DataFrame:
    """``rank`` and the columns of ``rows`` for the ``top`` rows of each query."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("key")]
    rank = F.row_number().over(Window.partitionBy("query").orderBy(*order))
    return rows.withColumn("rank", rank).where(F.col("rank") <= top)


# ---- search --------------------------------------------------------------------------


def _sliced(items: DataFrame, slice_terms: int) -> tuple[DataFrame, int]:
    """Queries with the number of their slice, and the number of slices of about ``slice_terms`` bytes / 4."""
    rows = items.where("item_id is not null and text is not null").select(F.col("item_id").cast("bigint"), "text")
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    slices = max(1, -(-total // (4 * slice_terms)))
    return rows.withColumn("slice", F.pmod(F.xxhash64("item_id", "text"), F.lit(slices))), slices


RESULT = "item_id bigint, rank int, doc_id bigint, score bigint"


def _search_slice(docs: DataFrame, index: DataFrame, rows: list[tuple[int, str]], top: int, probes: int) -> DataFrame:
    spark = docs.sparkSession
    queries = Queries(rows)
    ids = spark.sparkContext.broadcast(queries.ids)
    counts = _rows(docs).select("text").mapInArrow(_counter(ids), COUNTS).groupBy("term").agg(F.sum("n").alias("n"))
    held = dict(counts.collect())  # one row a query term
    ids.unpersist()
    if not held.get(-2):
        return spark.createDataFrame([], RESULT)
    queries.weigh(held[-1], held[-2], held)
    shared = spark.sparkContext.broadcast(queries)
    probed = index.mapInArrow(_highest(shared, probes), FOUND).distinct()
    order = Window.partitionBy("query").orderBy(F.col("bound").desc(), "key")
    probed = probed.withColumn("r", F.row_number().over(order)).where(F.col("r") <= probes)
    known = _score(docs, probed, shared, "probe")
    worst = _first(known, top).groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("s")).collect()
    least = np.ones(len(rows))
    for r in worst:  # one row a query
        if r.n == top:
            least[r.query] = r.s
    near = index.mapInArrow(_reaching(shared, least), FOUND).select("query", "key").distinct()
    scores = _score(docs, near, shared, "near")
    names = spark.createDataFrame([(i, name) for i, name in enumerate(queries.names)], "query int, item_id bigint")
    return stored(_first(scores, top).join(names, "query").select("item_id", "rank", "doc_id", "score"), "ranked")


def search(
    docs: DataFrame, index: DataFrame, items: DataFrame, top: int = TOP, probes: int = PROBES, slice_terms: int = SLICE_TERMS
) -> DataFrame:
    """The ``top`` documents of ``docs`` for each row of ``items`` (item_id, text); ``index`` is that of ``docs``."""
    numbered, slices = _sliced(items, slice_terms)
    out = docs.sparkSession.createDataFrame([], RESULT)
    for k in range(slices):
        rows = [(r.item_id, r.text) for r in numbered.where(F.col("slice") == k).orderBy("item_id", "text").collect()]
        if rows:
            out = out.unionByName(_search_slice(docs, index, rows, top, max(probes, top)))
    return out


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of the best documents of each item."""
    return search(docs, build_index(docs), items, top)

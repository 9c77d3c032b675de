"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` cuts the documents into blocks of whole documents and stores, per block,
every distinct term with its ascending posting list. ``search`` tests phrases of the
benchmark against every block: the posting list of a phrase's rarest term, moved by the
term's place in the phrase, is intersected with the moved lists of the next rarer terms
until it is empty or all terms agree. What is left are exact matches; with a slop each
term may also stand up to that many words off its place (a proximity match).

Blocks are independent, so nothing is shuffled by term: a word or passage that a third
of all documents share is spread as the documents are. Terms are told apart in a block
by 64-bit ids and stored as strings; phrases are compared with the strings.

Defined cases: a null text has no words; a null or empty item has no phrases; equal
items and repeated item ids count once by id; items without an id are not searched;
documents are returned once per input row, in any number of copies, null ids included;
other columns of the inputs are not read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ALNUM, Words, by_block, in_arrow, lists, stored, without

#: Largest number of benchmark words that are sent to the executors at once; more are searched in slices.
SLICE_WORDS = 2_000_000
#: Room between the documents of a block, so that no match spans two of them; larger than any slop.
GAP = 16
#: Bytes of text in a block of the index.
INDEX_BYTES = 2 << 20
#: Blocks in a file of the index; a reader holds all of a file's blocks.
FILE_BLOCKS = 4

INDEX = (
    "block string, doc_ids array<bigint>, n_words array<int>, terms array<string>, counts array<int>, positions array<int>"
)


def _index_block(block: pa.RecordBatch) -> pa.RecordBatch:
    words = Words(block.column("text"), ALNUM)
    ids = words.ids()
    places = (np.arange(len(ids)) + GAP * words.doc).astype(np.int32)
    order = np.argsort(ids, kind="stable")
    ranked = ids[order]
    begin = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ids) else np.zeros(0, np.int64)
    counts = np.diff(np.append(begin, len(ids)))
    one = lambda values, kind: lists(values, np.array([0, len(values)]), kind)
    terms = words.strings(order[begin]).cast(pa.string())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([uuid.uuid4().hex]),
            pa.ListArray.from_arrays([0, len(block)], block.column("doc_id").cast(pa.int64())),
            one(words.counts, pa.int32()),
            pa.ListArray.from_arrays([0, len(terms)], terms),
            one(counts, pa.int32()),
            one(places[order], pa.int32()),
        ],
        names=["block", "doc_ids", "n_words", "terms", "counts", "positions"],
    )


def build_index(docs: DataFrame) -> DataFrame:
    """Positional index of ``docs`` (doc_id, text), one row per block, on shared storage."""
    picked = docs.select(F.col("doc_id").cast("bigint"), "text")
    return stored(in_arrow(picked, by_block(_index_block, size=INDEX_BYTES), INDEX), "postings", FILE_BLOCKS)


class Phrases:
    """Distinct word windows of some items, as numbers into a vocabulary."""

    def __init__(self, items: list[tuple[int, list[str]]], size: int):
        number: dict[str, int] = {}
        windows: dict[tuple[int, ...], set[int]] = {}
        for item, words in items:
            coded = [number.setdefault(w, len(number)) for w in words]
            for at in range(max(1, len(coded) - size + 1) if coded else 0):
                windows.setdefault(tuple(coded[at : at + size]), set()).add(item)
        self.vocabulary = pa.array(list(number), pa.string())
        by_length: dict[int, list] = {}
        for window, owners in windows.items():
            by_length.setdefault(len(window), []).append((window, sorted(owners)))
        self.groups = []
        for length, rows in by_length.items():
            owners = [o for _, own in rows for o in own]
            bounds = np.cumsum([0] + [len(own) for _, own in rows])
            self.groups.append((length, np.array([w for w, _ in rows]), np.array(owners, np.int64), bounds))


def _moved(length, terms, counts, begins, keys, span, slop, most=2_000_000):
    """Matches of phrases: (phrase, place, exact), from the rarest term on, in runs of bounded size."""
    order = np.argsort(counts[terms], axis=1, kind="stable")
    rows = np.arange(len(terms))
    lead = terms[rows, order[:, 0]]
    sizes = counts[lead]
    runs = np.searchsorted(np.cumsum(sizes), np.arange(most, sizes.sum() + most, most), "left") + 1
    for a, b in zip(np.concatenate([[0], runs[:-1]]), np.minimum(runs, len(rows)), strict=True):
        if a >= b:
            continue
        part = rows[a:b]
        phrase = np.repeat(part, sizes[part])
        firsts = np.cumsum(sizes[part]) - sizes[part]
        at = np.arange(len(phrase)) - np.repeat(firsts, sizes[part]) + np.repeat(begins[lead[part]], sizes[part])
        place = keys[at] - lead[phrase].astype(np.int64) * span - order[phrase, 0]
        exact = np.ones(len(phrase), bool)
        for rank in range(1, length):
            if not len(phrase):
                break
            off = order[phrase, rank]
            want = terms[phrase, off].astype(np.int64) * span + place + off
            lo = np.minimum(np.searchsorted(keys, want - slop), len(keys) - 1)
            keep = (keys[lo] >= want - slop) & (keys[lo] <= want + slop)
            if slop:
                here = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
                exact &= keys[here] == want
            phrase, place, exact = phrase[keep], place[keep], exact[keep]
        yield phrase, place, exact


def _search_block(row: dict, phrases: Phrases, slop: int) -> dict:
    n_words = row["n_words"]
    firsts = np.concatenate([[0], np.cumsum(n_words)[:-1]]) + GAP * np.arange(len(n_words))
    counts = row["counts"].astype(np.int64)
    begins = np.cumsum(counts) - counts
    span = int(n_words.sum()) + GAP * (len(n_words) + 2)
    keys = np.repeat(np.arange(len(counts)), counts) * span + row["positions"] + GAP  # ascending
    firsts = firsts + GAP
    known = pc.index_in(phrases.vocabulary, value_set=row["terms"])
    known = known.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    cover = np.zeros(span + 1, np.int32)
    pairs, near = [], []
    for length, windows, owners, bounds in phrases.groups:
        terms = known[windows]
        there = np.flatnonzero((terms >= 0).all(axis=1))
        if not len(there):
            continue
        for phrase, place, exact in _moved(length, terms[there], counts, begins, keys, span, slop):
            doc = np.searchsorted(firsts, place, "right") - 1
            phrase = there[phrase]
            np.add.at(cover, place[exact], 1)
            np.add.at(cover, place[exact] + length, -1)
            many = (bounds[1:] - bounds[:-1])[phrase]
            at = np.repeat(bounds[phrase] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            found = np.stack([np.repeat(doc, many), owners[at]], axis=1)
            here = np.repeat(exact, many)
            pairs.append(np.unique(found[here], axis=0))
            near.append(np.unique(found[~here], axis=0))
    hit = np.cumsum(cover[:-1]) > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    runs = edge.reshape(-1, 2)
    owner = np.searchsorted(firsts, runs[:, 0], "right") - 1
    join = lambda found: np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
    return {"runs": runs - firsts[owner][:, None], "owner": owner, "pairs": join(pairs), "near": join(near)}


FOUND = (
    "block string, row int, doc_id bigint, n_words bigint, "
    "hits array<struct<a:int,b:int>>, items array<bigint>, near_items array<bigint>"
)


def _column(batch: pa.RecordBatch, name: str, i: int) -> pa.Array:
    return batch.column(name)[i].values


def _searcher(shared, slop: int):
    def run(batches):
        for batch in batches:
            for i in range(len(batch)):
                row = {k: _column(batch, k, i) for k in ("n_words", "counts", "positions", "terms")}
                numbers = ("n_words", "counts", "positions")
                row |= {k: row[k].to_numpy(zero_copy_only=False).astype(np.int64) for k in numbers}
                n = len(row["n_words"])
                if not n:
                    continue
                got = _search_block(row, shared.value, slop)
                cut = lambda owner, n=n: np.searchsorted(owner, np.arange(n + 1))
                spans = pa.StructArray.from_arrays(
                    [pa.array(got["runs"][:, k], pa.int32()) for k in (0, 1)], names=["a", "b"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("block")[i].as_py()] * n),
                        pa.array(np.arange(n), pa.int32()),
                        _column(batch, "doc_ids", i),
                        pa.array(row["n_words"], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(cut(got["owner"]), pa.int32()), spans),
                        lists(got["pairs"][:, 1], cut(got["pairs"][:, 0]), pa.int64()),
                        lists(got["near"][:, 1], cut(got["near"][:, 0]), pa.int64()),
                    ],
                    names=["block", "row", "doc_id", "n_words", "hits", "items", "near_items"],
                )

    return run


def item_words(items: DataFrame) -> DataFrame:
    """``item_id`` and the words of its text, for items that have an id and words."""
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.regexp_extract_all(lowered, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), 1)
    rows = items.where("item_id is not null and text is not null")
    return rows.select(F.col("item_id").cast("bigint"), found.alias("words")).where(F.size("words") > 0)


def search(index: DataFrame, items: DataFrame, size: int = 10, slop: int = 0, slice_words: int = SLICE_WORDS) -> DataFrame:
    """Test every phrase of ``items`` (item_id, text) against every block of the index.

    A phrase is ``size`` consecutive words, or a whole shorter item. One row per document:
    ``hits`` (word ranges covered by exact matches), ``items`` with an exact match and
    ``near_items`` with an inexact one within ``slop``. A test set of more than
    ``slice_words`` words is searched in slices, so that what an executor holds is bounded.
    """
    if not 0 <= slop < GAP:
        raise ValueError(f"slop must be from 0 to {GAP - 1}")
    spark = index.sparkSession
    words = item_words(items).distinct()
    total = words.agg(F.coalesce(F.sum(F.size("words")), F.lit(0)).alias("n")).first().n
    slices = max(1, -(-total // slice_words))
    numbered = words.withColumn("slice", F.pmod(F.xxhash64("item_id", "words"), F.lit(slices)))
    found = None
    for k in range(slices):
        rows = [(r.item_id, r.words) for r in numbered.where(F.col("slice") == k).collect()]
        shared = spark.sparkContext.broadcast(Phrases(rows, size))
        part = in_arrow(index, _searcher(shared, slop), FOUND)
        found = part if found is None else found.unionByName(part)
    if slices > 1:
        found = found.groupBy("block", "row").agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
            F.array_distinct(F.flatten(F.collect_list("near_items"))).alias("near_items"),
        )
    return found


def hit_words(hits: str = "hits"):
    """Number of words in a sorted list of word ranges that may overlap."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("to"))
    step = lambda s, r: F.struct(
        (s.n + F.greatest(r.b - F.greatest(r.a, s.to), F.lit(0))).alias("n"), F.greatest(s.to, r.b).alias("to")
    )
    return F.aggregate(hits, zero, step, lambda s: s.n)


def contamination(docs: DataFrame, items: DataFrame, size: int = 10, slop: int = 0) -> DataFrame:
    """Per document: words, words hit, items found, their digest, items near, and the verdict."""
    found = search(build_index(docs), items, size, slop)
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        hit_words().alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        F.size(F.array_except("near_items", "items")).cast("bigint").alias("n_near_items"),
    )


def clean(docs: DataFrame, items: DataFrame, size: int = 10, key: str = "doc_id") -> DataFrame:
    """``docs`` without the documents that hold a phrase of an item; rows without a key are kept."""
    found = contamination(docs.select(F.col(key).alias("doc_id"), "text"), items, size)
    bad = found.where("contaminated and doc_id is not null").select(F.col("doc_id").alias(key)).distinct()
    return without(docs, bad, key).select(*docs.columns)

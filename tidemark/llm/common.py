"""Shared helpers: tables on shared storage, ordered chunks, and words as arrays.

The word helpers work on whole Arrow batches. A batch of texts is one byte array; word
bounds come from a byte class table and word ids from prefix sums of a polynomial over
the bytes, so no Python object is made per word. UTF-8 keeps this exact: every byte of
a character above 0x7F is itself above 0x7F.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.skew import attach
from tidemark.session import checkpoint_dir

BLOCK_BYTES = 1 << 20

#: Bytes of rows that go to a Python worker at once (Spark's default is 64 MB, held by the executor and by the worker).
BATCH_BYTES = 4 * BLOCK_BYTES
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the folder that the whole cluster shares."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, file_rows: int = 0) -> DataFrame:
    """Write ``df`` to shared storage and read it back: no later step recomputes it.

    Readers hold some thousand rows of a file at once; ``file_rows`` bounds the rows of a file where rows are large.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Name of the row key that ``by_row`` adds.
ROW_KEY = "_row_key"


#: Keys or files that are broadcast; more are joined by a shuffle.
BROADCAST_KEYS = 1_000_000
BROADCAST_FILES = 100_000


def by_row(docs: DataFrame) -> DataFrame:
    """``docs`` with a key of its own for each row: null and repeated ids are told apart by it.

    Rows of Parquet files are numbered by their place: rows of earlier files (a prefix sum over
    files) plus the place in the file, so nothing is copied and every read gives the same keys.
    Other relations are stored with a number first.
    """
    try:
        placed = docs.withColumns({"_file": F.col("_metadata.file_path"), "_at": F.col("_metadata.row_index")})
    except AnalysisException:
        return stored(docs.withColumn(ROW_KEY, F.monotonically_increasing_id()), "rows")
    counts = placed.groupBy("_file").agg(F.count("*").alias("n"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    bases = counts.select("_file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    bases = stored(bases, "files")
    bases = F.broadcast(bases) if bases.count() <= BROADCAST_FILES else bases
    return placed.join(bases, "_file").select(*docs.columns, (F.col("_base") + F.col("_at")).alias(ROW_KEY))


def without(docs: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``docs`` but the rows with one of the distinct ``keys``: texts are not shuffled for a counted few."""
    keys = stored(keys, "left-out")
    few = keys.count() <= BROADCAST_KEYS
    return docs.join(F.broadcast(keys), key, "left_anti") if few else attach(docs, keys, [key], "left_anti")


def ordered_chunks(df: DataFrame, key: str, chunks: int) -> Column:
    """Chunk number of a row, ascending with ``key``; nulls are in chunk 0.

    Chunk bounds are quantiles of the key over all rows, at most ``chunks`` values, so
    the chunks are even for sparse and clustered keys too.
    """
    if chunks < 2:
        return F.lit(0)
    steps = [i / chunks for i in range(1, chunks)]
    bounds = df.agg(F.percentile_approx(key, steps, max(10_000, 10 * chunks)).alias("b")).first().b
    if not bounds:
        return F.lit(0)
    cut = F.array(*[F.lit(int(b)) for b in sorted(set(bounds))])
    return F.coalesce(F.size(F.filter(cut, lambda b: b < F.col(key))), F.lit(0))


def text_chunks(spark: SparkSession) -> int:
    """Number of ordered chunks: a few per shuffle partition, so they grow with the cluster's setting."""
    return 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---- words of a block of texts -------------------------------------------------------


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Table of 256 flags, true for the bytes of the inclusive ranges."""
    table = np.zeros(256, bool)
    for a, b in ranges:
        table[a : b + 1] = True
    return table


ALNUM = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []


def _pow_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, grown when a longer block comes."""
    if not _powers or len(_powers[0]) <= n:
        size = max(n + 1, BLOCK_BYTES + (BLOCK_BYTES >> 2))
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        _powers[:] = out
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """Words of some texts: ``start`` and ``end`` byte offsets, ``doc`` row of each word, ``data`` the bytes."""

    def __init__(self, texts: pa.Array, word_bytes: np.ndarray, lower: bool = True):
        self.data, self.offsets = flat_bytes(texts)
        if lower:
            self.data = LOWER[self.data]
        inside = word_bytes[self.data]
        n = len(inside)
        first = np.zeros(n + 1, bool)
        first[self.offsets] = True  # a word never goes on in the next text
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | first[1:n]
        ends[:-1] &= ~inside[1:] | first[1:n]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first_word = np.searchsorted(self.start, self.offsets)  # of each text, and the total
        self.counts = np.diff(self.first_word)
        self._sums = None

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def ids(self, start: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """64-bit id of each word, or of the given byte spans."""
        power, inverse = _pow_tables(len(self.data))
        if self._sums is None:
            sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * power[: len(self.data)], out=sums[1:])
            self._sums = sums
        start = self.start if start is None else start
        end = self.end if end is None else end
        return mix((self._sums[end] - self._sums[start]) * inverse[start])

    def strings(self, which: np.ndarray) -> pa.Array:
        """The words of the given numbers as strings."""
        start, length = self.start[which], (self.end - self.start)[which]
        bounds = np.zeros(len(which) + 1, np.int64)
        np.cumsum(length, out=bounds[1:])
        at = np.repeat(start - bounds[:-1], length) + np.arange(bounds[-1])
        return pa.LargeStringArray.from_buffers(
            len(which), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(self.data[at]))
        )


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each; a null text has no bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batches: Iterator[pa.RecordBatch], text: str, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a block has about ``size`` bytes of text, or one longer text."""
    for batch in batches:
        column = batch.column(text).cast(pa.large_string()).fill_null("")
        if not len(column):
            continue
        _, offsets = flat_bytes(column)
        at = 0
        while at < len(column):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def by_block(work: Callable[[pa.RecordBatch], pa.RecordBatch], text: str = "text", size: int = BLOCK_BYTES):
    """A ``mapInArrow`` function that applies ``work`` to one block after the other."""

    def run(batches):
        for block in blocks(batches, text, size):
            yield work(block)

    return run


def in_arrow(df: DataFrame, work, schema) -> DataFrame:
    """``df.mapInArrow`` on batches of at most ``BATCH_BYTES`` and a row.

    The bound is a setting of the session, as Spark has no other; one that the user has set stays.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH_SETTING, None) is None:
        conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    return df.mapInArrow(work, schema)


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """List column with ``values[bounds[i]:bounds[i + 1]]`` in row i."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, kind))

"""What executors and their Python workers hold at once."""

import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.conftest import BASE, NEAR, frame
from tidemark.llm import decontamination, near_duplicates, tokens
from tidemark.llm.common import _BATCH_SETTING, BATCH_BYTES, in_arrow


def _sizes(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([len(b)], pa.int64()), pa.array([b.nbytes], pa.int64())], names=["n", "bytes"])


def test_batches_are_bounded_by_bytes(spark):
    spark.conf.unset(_BATCH_SETTING)
    try:
        docs = frame(spark, [(1, BASE, "a"), (2, NEAR, "a"), (3, "another", "b")])
        assert near_duplicates.near_duplicates(docs).count() == 3
        wide = spark.range(0, 2000, 1, 1).select(F.repeat(F.lit("x"), 20_000).alias("text"))
        got = wide.mapInArrow(_sizes, "n bigint, bytes bigint").collect()  # as the operator left the session
        assert sum(r.n for r in got) == 2000
        assert max(r.bytes for r in got) < BATCH_BYTES + 100_000
    finally:
        spark.conf.unset(_BATCH_SETTING)


def test_the_users_bound_stays(spark):
    spark.conf.set(_BATCH_SETTING, "1m")
    try:
        wide = spark.range(0, 500, 1, 1).select(F.repeat(F.lit("x"), 20_000).alias("text"))
        got = in_arrow(wide, _sizes, "n bigint, bytes bigint").collect()
        assert sum(r.n for r in got) == 500
        assert max(r.bytes for r in got) < (1 << 20) + 100_000
    finally:
        spark.conf.unset(_BATCH_SETTING)


def test_near_duplicates_make_no_relation_in_python(spark, monkeypatch):
    docs = frame(spark, [(1, BASE, "a"), (2, NEAR, "a"), (3, "another", "b")])

    def refuse(*args, **named):
        raise AssertionError("a relation made in Python")

    monkeypatch.setattr(type(spark), "createDataFrame", refuse)
    got = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_index_files_hold_few_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "INDEX_BYTES", 1)
    docs = frame(spark, [(i, f"some words of text {i}", "a") for i in range(50)]).coalesce(1)
    per_file = decontamination.build_index(docs).groupBy(F.input_file_name().alias("f")).count().collect()
    assert sum(r["count"] for r in per_file) == 50
    assert max(r["count"] for r in per_file) <= decontamination.FILE_BLOCKS


def test_reading_token_files_lets_the_words_go():
    path = public_tokenizers.path("word_bpe_49k.json")
    tokens.encoder(path, 2).encode(pa.array(["some words"]))
    assert tokens._encoders
    assert list(tokens._reader(iter([]))) == []
    assert not tokens._encoders

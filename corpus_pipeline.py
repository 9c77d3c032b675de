"""Documents to token files: toxicity, near duplicates, decontamination, mixing, token ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet on
shared storage and reread as the next stage's ``docs``. All stages but the last keep the
columns of ``documents``; rows are judged one by one, also those without an id or with one that others have.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, mixing, near_duplicates, tokens, toxicity
from tidemark.llm.common import ROW_KEY, by_row, stored
from tidemark.llm.registry import table

END_OF_DOCUMENT = 2


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not call toxic."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at 80 % of five-word shingles."""
    return near_duplicates.keep_one_row(by_row(docs), ROW_KEY, size=5, percent=80).drop(ROW_KEY)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word phrase of ``benchmark``."""
    return decontamination.clean(by_row(docs), table(spark, sf_dir, "benchmark"), key=ROW_KEY).drop(ROW_KEY)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their target words."""
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, length and checksum of each document in the token files."""
    return tokens.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"), END_OF_DOCUMENT)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

#: A trained classifier, components of links and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

"""Incremental upsert of newly arrived staging files.

The same load as a watermark batch (newest row per key, then a change-detecting
upsert), with the stream's checkpoint as the watermark: each run picks up the
files that arrived since the last one and stops (``availableNow``). A micro-batch
may be replayed after a failure; the upsert compares hashes, so replaying a batch
changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.hashing import row_hash
from tidemark.operators.dedup import latest
from tidemark.sources.sinks import upsert_table

HASH = "row_md5"


def load_new_files(
    spark: SparkSession,
    source: str,
    schema,
    target: str,
    keys: Sequence[str],
    order: Sequence[Column],
    checkpoint: str,
    *,
    update_cols: Sequence[str] | None = None,
    partition_by: Sequence[str] = (),
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start the load; call ``awaitTermination`` on the result.

    ``files_per_batch`` bounds the size of a micro-batch. ``update_cols`` lists the
    columns an update may change (the hash is always among them).
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def upsert_batch(batch: DataFrame, _: int) -> None:
        newest = latest(batch, keys, order)
        hashed = newest.withColumn(HASH, row_hash(newest, exclude=keys))
        cols = None if update_cols is None else [*update_cols, HASH]
        upsert_table(
            batch.sparkSession, target, hashed, keys, cols, hash_col=HASH, partition_by=partition_by
        )

    return (
        reader.parquet(source)
        .writeStream.foreachBatch(upsert_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

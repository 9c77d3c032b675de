"""Load watermarks: one row per job run, kept as a small parquet table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.dedup import latest
from tidemark.sources.sinks import table_exists

EPOCH = "1900-01-01 00:00:00"
SCHEMA = "job string, batch_id bigint, lwm string, hwm string, started string, status string"


@dataclass(frozen=True)
class Batch:
    job: str
    batch_id: int
    lwm: str
    hwm: str


class Watermarks:
    """``begin`` hands out [low, high); ``commit`` makes high the next low.

    A batch that was begun but not committed is simply begun again with the same
    low mark, so a failed load is retried over the same rows plus newer ones.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def table(self) -> DataFrame:
        if table_exists(self.spark, self.path):
            return self.spark.read.schema(SCHEMA).parquet(self.path)
        return self.spark.createDataFrame([], SCHEMA)

    def _log(self, batch: Batch, now: str, status: str) -> None:
        row = (batch.job, batch.batch_id, batch.lwm, batch.hwm, now, status)
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def begin(self, job: str, now: str) -> Batch:
        runs = self.table().where(F.col("job") == job)
        state = runs.agg(
            F.max(F.when(F.col("status") == "success", F.col("hwm"))).alias("low"),
            F.max("batch_id").alias("last"),
        ).first()
        batch = Batch(job, (state.last or 0) + 1, state.low or EPOCH, now)
        self._log(batch, now, "running")
        return batch

    def commit(self, batch: Batch, now: str) -> None:
        self._log(batch, now, "success")


def watermark_plan(loads: DataFrame, job: str, batch: str, loaded: str) -> DataFrame:
    """Low and high marks of each past batch of each job, from its load log.

    The low mark of a batch is the high mark of the one before it. The log has
    one row per batch, so a job's rows are few.
    """
    from pyspark.sql import Window

    runs = loads.groupBy(job, batch).agg(F.max(loaded).alias("hwm"))
    w = Window.partitionBy(job).orderBy(batch)
    return runs.withColumn("lwm", F.coalesce(F.lag("hwm").over(w), F.lit(EPOCH).cast("timestamp_ntz")))

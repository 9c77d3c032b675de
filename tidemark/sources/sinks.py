"""Table writes: full refresh, upsert, retention, correlated update, logical delete.

Plain parquet has no MERGE. Each operation is a pure function
``(target, source) -> new target`` built on one full outer join, and
``replace_table`` swaps the result in. Tables partitioned by a snapshot or date
key are rewritten partition by partition (dynamic overwrite), so a daily load
touches only the days it has rows for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.skew import attach


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full refresh."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions ``df`` has rows for."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


STAGED = ".next"


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the table is there, after finishing a swap that was cut short."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        staged, _ = _fs(spark, path.rstrip("/") + STAGED)
        done, _ = _fs(spark, path.rstrip("/") + STAGED + "/_SUCCESS")
        if fs.exists(done):
            fs.rename(staged, p)
    return fs.exists(p)


def replace_table(df: DataFrame, path: str) -> None:
    """Write next to the table, then swap, so ``df`` may read the table it replaces.

    If the driver dies between the two steps of the swap, the complete new table is
    picked up by the next ``table_exists``.
    """
    spark = df.sparkSession
    staged = path.rstrip("/") + STAGED
    write_table(df, staged)
    src, fs = _fs(spark, staged)
    dst, _ = _fs(spark, path)
    if fs.exists(dst):
        fs.delete(dst, True)
    if not fs.rename(src, dst):
        raise OSError(f"could not move {staged} to {path}")


def _side(df: DataFrame, keys: Sequence[str], prefix: str, mark: str) -> DataFrame:
    cols = [F.col(c).alias(c if c in keys else prefix + c) for c in df.columns]
    return df.select(*cols, F.lit(True).alias(mark))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    *,
    hash_col: str | None = None,
) -> DataFrame:
    """Insert new keys, update ``update_cols`` of known keys, keep the rest.

    Columns not listed (insert time and the like) keep the target's value. With
    ``hash_col`` a known key whose hash is the same is left untouched. Keys are
    unique on both sides, so the join has no hot key.
    """
    keys = list(keys)
    updatable = set(update_cols if update_cols is not None else source.columns) - set(keys)
    t = _side(target, keys, "_t_", "_in_t")
    s = _side(source, keys, "_s_", "_in_s")
    joined = t.join(s, keys, "full_outer")
    is_new = F.col("_in_t").isNull()
    changed = F.col("_in_s").isNotNull()
    if hash_col:
        same = F.col("_t_" + hash_col).eqNullSafe(F.col("_s_" + hash_col))
        changed = changed & (is_new | ~same)
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c not in source.columns:
            out.append(F.col("_t_" + c).alias(c))
        else:
            take = changed if c in updatable else is_new
            out.append(F.when(take, F.col("_s_" + c)).otherwise(F.col("_t_" + c)).alias(c))
    return joined.select(*out)


def upsert_table(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    *,
    hash_col: str | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Upsert into a parquet table.

    With ``partition_by`` (which must be part of the key) only the partitions
    present in ``source`` are read and rewritten: the semi join on the partition
    columns turns into dynamic partition pruning.
    """
    if not table_exists(spark, path):
        write_table(source, path, partition_by)
        return
    target = spark.read.parquet(path)
    if partition_by:
        if not set(partition_by) <= set(keys):
            raise ValueError("partition columns must be part of the key")
        touched = source.select(*partition_by).distinct()
        part = target.join(touched, list(partition_by), "left_semi")
        merged = upsert(part, source, keys, update_cols, hash_col=hash_col)
        overwrite_partitions(merged, path, partition_by)
    else:
        replace_table(upsert(target, source, keys, update_cols, hash_col=hash_col), path)


def purge(df: DataFrame, ts: str, asof: Column, days: int) -> DataFrame:
    """Drop rows older than ``days`` before ``asof``; prunes date partitions."""
    return df.where(F.col(ts) >= asof - F.expr(f"INTERVAL {int(days)} DAYS"))


def append_with_retention(
    target: DataFrame, source: DataFrame, ts: str, asof: Column, days: int
) -> DataFrame:
    """Append, then drop rows older than ``days`` before ``asof``."""
    return purge(target.unionByName(source, allowMissingColumns=True), ts, asof, days)


def update_from(
    target: DataFrame,
    stage: DataFrame,
    keys: Sequence[str],
    columns: Mapping[str, str],
) -> DataFrame:
    """Set target columns from the stage row with the same key; a null never overwrites.

    ``columns`` maps target column to stage column; the stage has one row per key.
    """
    s = stage.select(*keys, *[F.col(v).alias(f"_s_{k}") for k, v in columns.items()])
    joined = target.join(s, list(keys), "left")
    return joined.select(
        *[
            F.coalesce(F.col(f"_s_{c}"), F.col(c)).alias(c) if c in columns else F.col(c)
            for c in target.columns
        ]
    )


def logical_delete(
    target: DataFrame, inactive: DataFrame, keys: Sequence[str], flag: str
) -> DataFrame:
    """Flag (never remove) rows whose key is in the inactive set."""
    gone = inactive.select(*keys).distinct().withColumn("_gone", F.lit(True))
    return (
        attach(target, gone, keys)
        .withColumn(flag, F.when(F.col("_gone"), F.lit("Y")).otherwise(F.lit("N")))
        .drop("_gone")
    )

"""Session settings and the few places that need to know about the cluster."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Writes to partitioned tables replace only the partitions they bring.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or get) a session with the settings the library is tested under."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    ``spark.checkpoint.dir`` of the session wins. Only a local session with
    nothing set gets a temporary folder, because on a cluster that folder would
    be private to one machine and lost with it.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        if not current.isDefined():
            sc.setCheckpointDir(folder)
        return folder
    if current.isDefined():
        return current.get()
    if not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package where it is neither installed nor on their path."""
    sc = spark.sparkContext
    root = Path(__file__).resolve().parent.parent
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(sc, "_tidemark_shipped", False):
        return
    sc.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/tidemark", "zip", root, "tidemark"))
    sc._tidemark_shipped = True


BROADCAST_ROW_LIMIT = 100_000


def broadcast_bounded(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast for a relation whose row count is bounded by construction.

    ``rows`` is the bound the caller can prove (a literal table, a one-row
    aggregate, the minutes of a day). Above the limit the relation is returned
    unhinted and the planner picks a shuffle join.
    """
    return F.broadcast(df) if rows <= BROADCAST_ROW_LIMIT else df

"""Usage-log history: a hot table of recent rows kept by incremental loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from tidemark.sources.sinks import purge, upsert
from tidemark.sources.tables import LoadWindow


def refresh_log(
    hot: DataFrame, log: DataFrame, keys: Sequence[str], ts: str, window: LoadWindow, asof: Column, days: int
) -> DataFrame:
    """Hot table after one load: new and changed rows of the window in, expired rows out.

    Expired rows of the old table are dropped before the join, not after it.
    """
    recent = purge(hot, ts, asof, days)
    return purge(upsert(recent, window.read(log, ts), keys), ts, asof, days)

"""Directory users: current rows and the groups they are members of."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.operators.dedup import latest_batch
from tidemark.operators.reshape import explode_tokens


def current_users(history: DataFrame, keys: Sequence[str], valid_from: str) -> DataFrame:
    """The newest valid rows of each user; rows of the same date are all kept."""
    return latest_batch(history, keys, valid_from)


def member_rows(
    history: DataFrame, keys: Sequence[str], valid_from: str, members: str, separators: str, out: str
) -> DataFrame:
    """One row per current user row and group member named in a separated text."""
    return explode_tokens(current_users(history, keys, valid_from), members, separators, out)

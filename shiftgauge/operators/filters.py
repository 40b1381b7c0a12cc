"""Restriction to a set of users."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftgauge.operators.sizing import BROADCAST_BYTES, broadcast_if_small


def in_users(
    df: DataFrame,
    allow: Iterable[str] | DataFrame,
    column: str = "user_azon",
    limit_bytes: int = BROADCAST_BYTES,
    allow_bytes: int | None = None,
) -> DataFrame:
    """Rows whose user is in ``allow``; NULL users never are.

    A short list of values becomes an IN predicate, which reaches the scan. A
    DataFrame (its first column is used) becomes a left semi join; ``allow_bytes`` is
    the payload of that column if it is known already.
    """
    if not isinstance(allow, DataFrame):
        return df.where(F.col(column).isin(list(allow)))
    users = allow.select(F.col(f"`{allow.columns[0]}`").alias(column))
    return df.join(broadcast_if_small(users, limit_bytes, allow_bytes), column, "left_semi")

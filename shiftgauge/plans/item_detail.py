"""Items processed by selected users on one day."""

from __future__ import annotations

import datetime
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftgauge.checkpoints import store
from shiftgauge.functions.days import day_before, on_day
from shiftgauge.functions.text import number_to_text
from shiftgauge.operators.filters import in_users
from shiftgauge.operators.key_filter import (
    FILTER_BYTES,
    blocks_for,
    can_filter,
    key_blocks,
    with_possible_keys,
)
from shiftgauge.operators.sizing import BROADCAST_BYTES, broadcast_if_small, payload
from shiftgauge.schemas import ITEM_KEY


def select_actions(
    log: DataFrame,
    allow: Iterable[str] | DataFrame,
    as_of: datetime.date | str | Column | None = None,
    offset_days: int = 1,
    status: str = "67",
    day_partition: str | None = None,
    limit_bytes: int = BROADCAST_BYTES,
    allow_bytes: int | None = None,
) -> DataFrame:
    """Log rows of the allowed users with the given status on the one day.

    ``day_partition`` names a date column the log is partitioned by, if there is one.
    """
    day = on_day(F.col("azon_forgtet_mod_idopont"), as_of, offset_days)
    picked = log.where(day & (F.col("allapot_azon_feldolg") == status))
    if day_partition is not None:
        picked = picked.where(F.col(day_partition) == day_before(as_of, offset_days))
    picked = picked.select("user_azon", *ITEM_KEY, "azon_forgtet_mod_idopont")
    return in_users(picked, allow, limit_bytes=limit_bytes, allow_bytes=allow_bytes)


def select_items(items: DataFrame, direction: str = "J") -> DataFrame:
    """Items of one direction."""
    return items.where(F.col("forgtet_irany") == direction).select(*ITEM_KEY, "ceg_szlaszam")


def join_items(
    actions: DataFrame,
    items: DataFrame,
    keys: list[str] = ITEM_KEY,
    limit_bytes: int = BROADCAST_BYTES,
    actions_bytes: int | None = None,
) -> DataFrame:
    """Actions with their items; every pair of equal keys is kept.

    Columns are those of ``actions`` and the non-key columns of ``items``. The
    actions are the selective side: if their payload is known as ``actions_bytes`` and
    fits they are broadcast, and the items are neither shuffled nor exposed to a hot key.
    Where it is not known, adaptive execution chooses by the sizes it meets; measuring
    here would run the plan of the actions once more.
    """
    a = actions
    if actions_bytes is not None:
        a = broadcast_if_small(a, limit_bytes, actions_bytes)
    a, b = a.alias("a"), items.alias("b")
    same = reduce(lambda x, y: x & y, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys])
    extra = [F.col(f"b.{name}") for name in items.columns if name not in keys]
    return a.join(b, same, "inner").select("a.*", *extra)


def join_users(
    detail: DataFrame, users: DataFrame, limit_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Add ``torzsszam``; unknown users keep their rows, users listed twice double them."""
    known = broadcast_if_small(users.select("user_azon", "torzsszam"), limit_bytes)
    return detail.join(known, "user_azon", "left")


def processed_items(
    log: DataFrame,
    items: DataFrame,
    users: DataFrame,
    allow: Iterable[str] | DataFrame,
    as_of: datetime.date | str | Column | None = None,
    offset_days: int = 1,
    status: str = "67",
    direction: str = "J",
    day_partition: str | None = None,
    limit_bytes: int = BROADCAST_BYTES,
    filter_bytes: int = FILTER_BYTES,
) -> DataFrame:
    """One row per processed item: user, personnel number, item key, account, time.

    ``offset_days=1`` is yesterday, ``3`` the single day three days before ``as_of``.
    The selected actions are stored and measured in one pass over the log: their size
    decides how they are joined, and the range of their keys reaches the scan of the
    items. They are rebalanced first, as each task of a large log finds a few rows only.
    Actions too large to broadcast are a shuffle join, for which a Bloom filter of their keys
    takes the items out that match none, before these are shuffled.
    """
    allow_bytes = None
    if isinstance(allow, DataFrame):
        allow = allow.select(allow.columns[0])
        allow, measured = store(allow, bytes=payload(allow))
        allow_bytes = measured["bytes"]
    else:
        allow = list(allow)
    actions = select_actions(
        log, allow, as_of, offset_days, status, day_partition, limit_bytes, allow_bytes
    )
    ends = {f"{end}_{k}": of(k) for k in ITEM_KEY for end, of in (("least", F.min), ("most", F.max))}
    actions, measured = store(
        actions.hint("rebalance"), bytes=payload(actions), n=F.count(F.lit(1)), **ends
    )
    for key in ITEM_KEY:
        # Values of different types are ordered differently, though some may be equal.
        if log.schema[key].dataType == items.schema[key].dataType:
            least, most = (F.lit(measured[f"{end}_{key}"]) for end in ("least", "most"))
            items = items.where(F.col(key).between(least, most))
    chosen = select_items(items, direction)
    if measured["bytes"] > limit_bytes and can_filter(actions, chosen, ITEM_KEY):
        blocks = blocks_for(measured["n"], filter_bytes)
        if blocks is not None:
            filters = key_blocks(actions, ITEM_KEY, blocks)
            chosen = with_possible_keys(chosen, ITEM_KEY, filters, blocks)
    detail = join_items(
        actions,
        chosen,
        limit_bytes=limit_bytes,
        actions_bytes=measured["bytes"],
    )
    known = in_users(users, allow, limit_bytes=limit_bytes, allow_bytes=allow_bytes)
    detail = join_users(detail, known, limit_bytes)
    account = number_to_text(F.col("ceg_szlaszam"), items.schema["ceg_szlaszam"].dataType)
    return detail.select(
        "user_azon",
        "torzsszam",
        *ITEM_KEY,
        account.alias("ceg_szlaszam"),
        F.col("azon_forgtet_mod_idopont").alias("datum"),
    )

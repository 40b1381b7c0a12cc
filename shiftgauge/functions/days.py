"""Whole-day predicates relative to a reference day."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_before(as_of: datetime.date | str | Column | None, offset_days: int) -> Column:
    """The day ``offset_days`` before ``as_of`` (default: today in the session time zone)."""
    if as_of is None:
        as_of = F.current_date()
    elif not isinstance(as_of, Column):
        as_of = F.to_date(F.lit(as_of))
    return F.date_sub(as_of, offset_days)


def on_day(
    timestamp: Column, as_of: datetime.date | str | Column | None = None, offset_days: int = 1
) -> Column:
    """True on exactly one calendar day.

    Comparing ``to_date`` with a foldable day is turned into a timestamp range by
    Catalyst and reaches the scan; ``date_trunc`` would not.
    """
    return F.to_date(timestamp) == day_before(as_of, offset_days)

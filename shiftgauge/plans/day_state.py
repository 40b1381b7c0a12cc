"""Work hours kept day by day, so that a new day does not read the days before.

Two Parquet tables below one root, both partitioned by day:

* ``partials``: per team and user the sum of the known minutes, the rows and the missing ones.
  Partials add up, so rows that arrive late are merged with what is there.
* ``flags``: per team and user the hours and whether the day is suspicious. A flag depends on
  its day only, so an update computes those of the days it brings.

An update reads and replaces the partitions of its days alone, by dynamic partition overwrite;
a day delivered again replaces itself. ``partials`` is written before ``flags``: a run that
fails in between leaves the old flags, and running it again repairs both.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftgauge.checkpoints import store
from shiftgauge.functions.strict import strict_sum
from shiftgauge.plans import wide_hours
from shiftgauge.plans.work_hours import COUNT, FLAG, HOURS, suspicious_flags
from shiftgauge.schemas import DAY, MINUTES, TEAM, USER
from shiftgauge.sources.partitions import replace_partitions, stored_partitions

# Columns of the partials beside the keys and the minutes.
ROWS, MISSING = "rows", "missing"

_ORDER = [DAY, TEAM, USER]


def update_days(
    rows: DataFrame,
    root: str,
    *,
    add: bool = False,
    days: Iterable[datetime.date | str | None] = (),
) -> None:
    """Bring the days of ``rows`` (day, team, user, minutes) into the state at ``root``.

    ``rows`` holds all rows of its days and replaces what was there; with ``add`` they are more
    rows of days that may be known already. ``days`` names days that are delivered even if they
    have no rows: without rows they are emptied. Floating-point minutes can be replaced, not
    added to: their partial sums would be rounded.
    """
    spark = rows.sparkSession
    kind = rows.schema[MINUTES].dataType
    if add and wide_hours.is_floating(kind):
        raise ValueError("floating-point minutes do not add up exactly; give whole days")
    if add and list(days):
        raise ValueError("rows are added to days or replace them")
    if wide_hours.is_floating(kind):
        flags = _flags(rows)
        replace_partitions(flags, f"{root}/flags", [DAY], [(d,) for d in days])
        return
    parts = rows.groupBy(DAY, TEAM, USER).agg(
        F.coalesce(F.sum(MINUTES), F.lit(0)).cast(_sum_type(kind)).alias(MINUTES),
        F.count(F.lit(1)).alias(ROWS),
        F.count_if(F.col(MINUTES).isNull()).alias(MISSING),
    )
    parts, _ = store(parts)
    if add and stored_partitions(spark, f"{root}/partials"):
        own = [r[0] for r in parts.select(DAY).distinct().collect()]  # days, a calendar at most
        known = read_partials(spark, root, parts.schema, own)
        both = known.select(parts.columns).unionByName(parts)
        both = both.groupBy(DAY, TEAM, USER).agg(*[F.sum(c).alias(c) for c in (MINUTES, ROWS, MISSING)])
        parts, _ = store(both.withColumn(MINUTES, F.col(MINUTES).cast(_sum_type(kind))))
    expected = [(d,) for d in days]
    replace_partitions(_clustered(parts), f"{root}/partials", [DAY], expected)
    replace_partitions(_flags(_as_rows(parts)), f"{root}/flags", [DAY], expected)


def read_partials(
    spark: SparkSession, root: str, schema: T.StructType, days: list | None = None
) -> DataFrame:
    """Partials, of the named days if any are named; other partitions are not read."""
    parts = spark.read.schema(schema).parquet(f"{root}/partials")
    return parts if days is None else parts.where(_among(days))


def read_flags(
    spark: SparkSession,
    root: str,
    first: datetime.date | str | None = None,
    last: datetime.date | str | None = None,
    day_type: str = "date",
) -> DataFrame:
    """Hours and flags per day, team and user, from ``first`` to ``last`` (both included)."""
    schema = f"{TEAM} string, {USER} string, {HOURS} double, {FLAG} boolean, {DAY} {day_type}"
    flags = spark.read.schema(schema).parquet(f"{root}/flags")
    if first is not None:
        flags = flags.where(F.col(DAY) >= F.lit(first).cast(day_type))
    if last is not None:
        flags = flags.where(F.col(DAY) <= F.lit(last).cast(day_type))
    return flags.select(DAY, TEAM, USER, HOURS, FLAG)


def count_days(spark: SparkSession, root: str, **period) -> DataFrame:
    """Number of suspicious days per team and user, from the stored flags."""
    flags = read_flags(spark, root, **period)
    return flags.groupBy(TEAM, USER).agg(strict_sum(F.col(FLAG).cast("bigint")).alias(COUNT))


def _sum_type(kind: T.DataType) -> T.DataType:
    """Room for the sums of many deliveries; a sum that leaves it raises."""
    return T.DecimalType(38, kind.scale if isinstance(kind, T.DecimalType) else 0)


def _as_rows(parts: DataFrame) -> DataFrame:
    minutes = F.when(F.col(MISSING) == 0, F.col(MINUTES))
    return parts.select(DAY, TEAM, USER, minutes.alias(MINUTES))


def _flags(rows: DataFrame) -> DataFrame:
    return _clustered(suspicious_flags(rows).select(DAY, TEAM, USER, HOURS, FLAG))


def _clustered(df: DataFrame) -> DataFrame:
    """Few files for a small day, several for a large one, each in the order of teams."""
    return df.hint("rebalance", DAY).sortWithinPartitions(*_ORDER)


def _among(days: list):
    named = [d for d in days if d is not None]
    chosen = F.col(DAY).isin(named) if named else F.lit(False)
    return chosen | F.col(DAY).isNull() if None in days else chosen

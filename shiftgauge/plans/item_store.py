"""Daily results of the item queries as a table: one partition per reference day and offset."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftgauge.sources.partitions import replace_partitions

# Partition columns.
AS_OF, OFFSET = "as_of", "offset_days"


def write_items(
    detail: DataFrame, path: str, as_of: datetime.date | str, offset_days: int = 1
) -> None:
    """Store the ``processed_items`` of one reference day and offset.

    A rerun replaces its own partition only, also if it has no items any more. Rows are
    rebalanced into files by size and ordered by user.
    """
    day = as_of if isinstance(as_of, datetime.date) else datetime.date.fromisoformat(as_of)
    rows = detail.hint("rebalance").withColumns(
        {AS_OF: F.lit(day), OFFSET: F.lit(offset_days).cast("int")}
    )
    replace_partitions(
        rows.sortWithinPartitions("user_azon", "datum"), path, [AS_OF, OFFSET], [(day, offset_days)]
    )


def read_items(
    spark: SparkSession,
    path: str,
    as_of: datetime.date | str | None = None,
    offset_days: int | None = None,
) -> DataFrame:
    """Stored items with ``as_of`` and ``offset_days``; only the named partitions are read."""
    rows = spark.read.parquet(path)
    if as_of is not None:
        rows = rows.where(F.col(AS_OF) == F.lit(as_of).cast("date"))
    if offset_days is not None:
        rows = rows.where(F.col(OFFSET) == offset_days)
    return rows.withColumn(AS_OF, F.col(AS_OF).cast("date"))

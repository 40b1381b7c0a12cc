"""Consecutive row numbers without a single-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftgauge.checkpoints import cut

_POSITION_BITS = (1 << 33) - 1


def number_rows(df: DataFrame, order: list[Column], column: str = "row_no") -> DataFrame:
    """Number the rows 1..n in the given order.

    The rows are range-sorted once and materialised. A row's number is its position
    in its partition plus the number of rows in the partitions before it; only the
    per-partition counts meet in one place.
    """
    ordered, _ = cut(df.orderBy(*order))
    placed = ordered.select(
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)).alias("_seq"),
        "*",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    number = (F.col("_before") + F.col("_seq") + 1).cast("bigint").alias(column)
    return placed.join(F.broadcast(offsets), "_part").select(number, *df.columns)

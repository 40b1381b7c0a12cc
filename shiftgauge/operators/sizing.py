"""Broadcast only what has been measured."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Measured payload up to which a join side is broadcast.
BROADCAST_BYTES = 128 * 1024 * 1024

_ROW_OVERHEAD = 32


def _width(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.lit(8) + F.coalesce(F.octet_length(column), F.lit(0))
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        raise TypeError(f"cannot measure nested column {field.name}")
    wide = isinstance(field.dataType, T.DecimalType) and field.dataType.precision > 18
    return F.lit(24 if wide else 8)


def payload(df: DataFrame) -> Column:
    """Aggregate: bytes the rows of ``df`` take in a broadcast relation."""
    widths = [_width(field) for field in df.schema.fields]
    row = reduce(lambda a, b: a + b, widths, F.lit(_ROW_OVERHEAD)).cast("bigint")
    return F.coalesce(F.sum(row), F.lit(0).cast("bigint"))


def payload_bytes(df: DataFrame) -> int:
    """Measure the payload of ``df``, which reads it once."""
    return df.agg(payload(df).alias("bytes")).first()["bytes"]


def broadcast_if_small(
    df: DataFrame, limit_bytes: int = BROADCAST_BYTES, measured: int | None = None
) -> DataFrame:
    """Mark ``df`` for broadcast if its payload fits, else return it unchanged.

    The payload is measured here unless it is known already. Unmarked, the join is a
    shuffle join whose oversized partitions are split by adaptive execution, by their
    real sizes and on both sides of an inner join.
    """
    if measured is None:
        measured = payload_bytes(df)
    return F.broadcast(df) if measured <= limit_bytes else df

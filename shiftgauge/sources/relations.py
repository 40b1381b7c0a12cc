"""Database extracts and tables: action log, items, users."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftgauge.functions.casts import exact_cast


def read_relation(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    *,
    fmt: str = "parquet",
    blank_is_null: bool = False,
    padded: Iterable[str] = (),
    only: dict[str, Iterable[str]] | None = None,
    **options: str,
) -> DataFrame:
    """Read the columns of ``schema`` from a path, a catalog table or a database table.

    ``fmt="table"`` takes a catalog name, quoted here, so names with ``$`` work.
    ``fmt="jdbc"`` takes a database table; pass ``url`` and, for a parallel read,
    ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``.
    ``blank_is_null`` is for databases in which the empty string is NULL, ``padded``
    names fixed-width text columns to be right-trimmed. Numbers that the schema would
    round raise.

    ``only`` keeps the rows whose text column, as returned, is one of the values. A
    predicate on a cleaned or cast column does not reach the scan; this one is also put
    in terms of the column as stored, which does.
    """
    if fmt == "table":
        df = spark.read.table(".".join(f"`{part}`" for part in source.split(".")))
    elif fmt == "jdbc":
        df = spark.read.format("jdbc").options(dbtable=source, **options).load()
    else:
        df = spark.read.format(fmt).options(**options).load(source)
    padded = set(padded)
    only = {name: list(values) for name, values in (only or {}).items()}
    for name, values in only.items():
        df = df.where(_as_stored(df, name, values, name in padded))
    df = df.select(*[_conform(df, f, blank_is_null, f.name in padded) for f in schema.fields])
    for name, values in only.items():
        df = df.where(F.col(name).isin(values))
    return df


def _as_stored(df: DataFrame, name: str, values: list[str], padded: bool) -> Column:
    """Holds wherever the cleaned column is one of ``values``, and maybe for more."""
    column, data_type = F.col(name), df.schema[name].dataType
    if not isinstance(data_type, T.StringType):
        return column.isin([F.lit(v).try_cast(data_type) for v in values])
    if not padded:
        return column.isin(values)
    return reduce(lambda a, b: a | b, [column.startswith(v) for v in values], F.lit(False))


def _conform(df: DataFrame, field: T.StructField, blank_is_null: bool, padded: bool) -> Column:
    column = exact_cast(df, field)
    if padded:
        column = F.rtrim(column)
    if blank_is_null and isinstance(field.dataType, T.StringType):
        column = F.when(column != "", column)
    return column.alias(field.name)

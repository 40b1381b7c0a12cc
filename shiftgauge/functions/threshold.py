"""The "below mean minus one standard deviation" test without rounding.

In floating point the answer at ties depends on the order of summation: three
members with 1, 2 and 3 hours have a threshold of exactly 1 hour, and the rule is
a strict "less than". With whole units of time ``t`` for each of ``n`` members,
``S`` the sum and ``Q`` the sum of squares, put ``V = n*Q - S*S``. Then
``t < mean - sd`` holds exactly if ``S - n*t > 0`` and
``(S - n*t)**2 > V*n/(n-1) = V + V/(n-1)``. The left side is a whole number, so the
right side may be rounded down to ``T``, and with ``r`` the whole square root of
``T`` the test is ``n*t <= S - r - 1``. That is one largest suspicious value per
group: members need a plain comparison, and no intermediate exceeds ``n*n*t*t``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = T.DecimalType(38, 0)
MOST_DECIMALS = 18

_BLOCK = 10**19


def is_exact(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.IntegralType, T.DecimalType))


def scale_of(data_type: T.DataType) -> int:
    return max(data_type.scale, 0) if isinstance(data_type, T.DecimalType) else 0


def require_ansi(spark: SparkSession) -> None:
    """Refuse sessions in which a product out of range is NULL, as if minutes were missing."""
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise RuntimeError("exact decimals need spark.sql.ansi.enabled=true")


def decimals(column: Column) -> Column:
    """Digits behind the point of a decimal number, trailing zeros left out."""
    text = F.rtrim(column.cast("string"), F.lit("0"))
    return F.length(F.substring_index(text, ".", -1))


def whole_units(column: Column, data_type: T.DataType) -> Column:
    """A decimal or integer column as a whole number of its smallest unit.

    Types of more than ``MOST_DECIMALS`` decimals are refused.
    """
    scale = scale_of(data_type)
    if scale == 0:
        return column.cast(WHOLE)
    if scale > MOST_DECIMALS:
        raise ValueError(f"{scale} decimals do not fit the exact threshold")
    # Leaves room for the product: 38 digits hold it without dropping any of the scale.
    narrow = column.cast(T.DecimalType(36 - scale, scale))
    return (narrow * F.lit(10**scale).cast(T.DecimalType(scale + 1, 0))).cast(WHOLE)


def from_units(units: Column, data_type: T.DataType) -> Column:
    """The inverse of ``whole_units``, again exact."""
    scale = scale_of(data_type)
    if scale == 0:
        return units
    narrow = units.cast(T.DecimalType(37 - scale, 0))
    return narrow * F.lit(Decimal(1).scaleb(-scale)).cast(T.DecimalType(scale, scale))


def spread() -> Column:
    """``V`` of a group, from ``_n``, ``_sum`` and ``_squares``."""
    total = F.col("_sum")
    return (F.col("_n") * F.col("_squares") - total * total).cast(WHOLE)


def with_largest_below(df: DataFrame, name: str) -> DataFrame:
    """Add the largest whole number below mean - sd per group; NULL for one member.

    ``df`` has ``_n``, ``_sum`` and ``_squares``; the spread ``V`` is added as
    ``_spread``. Each step is a column of its own, so nothing is evaluated twice.
    """
    require_ansi(df.sparkSession)
    n, total, v = F.col("_n"), F.col("_sum"), F.col("_spread")
    df = df.withColumn("_spread", spread())
    others = F.nullif(n - F.lit(1), F.lit(0))
    df = df.withColumn("_bound", (v + _floor_divide(v, others)).cast(WHOLE))
    df = with_whole_root(df, "_bound", "_root")
    df = df.withColumn("_room", (total - F.col("_root") - 1).cast(WHOLE))
    return df.withColumn(name, _floor_divide(F.col("_room"), n)).drop("_bound", "_root", "_room")


def with_whole_root(df: DataFrame, square: str, name: str) -> DataFrame:
    """Add the square root of a whole number >= 0, rounded down.

    The double root is off by its 53 bits; one Newton step leaves at most one.
    """
    s, near, step = F.col(square), F.col("_near"), F.col("_step")
    df = df.withColumn("_near", F.nullif(F.sqrt(s.cast("double")).cast(WHOLE), F.lit(0)))
    df = df.withColumn("_step", F.floor((near + s / near) / 2).cast("decimal(19,0)"))
    root = (
        F.when((step + 1) * (step + 1) <= s, step + 1)
        .when(step * step > s, step - 1)
        .otherwise(step)
    )
    root = F.when(s == 0, F.lit(0)).otherwise(root).cast(WHOLE)
    return df.withColumn(name, root).drop("_near", "_step")


def _floor_divide(a: Column, b: Column) -> Column:
    """Whole quotient rounded down, in two blocks of 19 digits.

    Spark gives quotients of wide decimals six decimals and so 32 whole digits at most.
    """
    block = F.lit(Decimal(_BLOCK)).cast(T.DecimalType(20, 0))
    low = F.pmod(a, block)
    high = ((a - low) / block).cast(WHOLE)
    left = F.pmod(high, b)
    rest = (left * block + low).cast(WHOLE)
    first = ((high - left) / b).cast(WHOLE)
    second = ((rest - F.pmod(rest, b)) / b).cast(WHOLE)
    return (first * block + second).cast(WHOLE)

"""Numbers as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def number_to_text(column: Column, data_type: T.DataType) -> Column:
    """All digits of an exact number, without exponent, trailing zeros or a leading zero.

    Whole numbers are their digits (``123``); fractions drop what carries no value
    (``1.50`` gives ``1.5``, ``0.50`` gives ``.5``, ``2.00`` gives ``2``).
    """
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        raise TypeError("floating-point ids lose digits; cast to a decimal or an integer first")
    if not isinstance(data_type, T.DecimalType) or data_type.scale <= 0:
        return column.cast("string")
    short = F.regexp_replace(column.cast("string"), r"\.?0+$", "")
    return F.when(column == 0, F.lit("0")).otherwise(F.regexp_replace(short, r"^(-?)0\.", "$1."))

"""Casts that raise where they would lose something."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def exact_cast(df: DataFrame, field: T.StructField) -> Column:
    """The column of that name in the type of ``field``; a value that would change raises.

    A number must not be rounded, be it given as a number or as text, and a time must be
    midnight to become a day. Blank text is a missing number. A column that has the type
    already, or a wider one of the same kind, stays a plain cast, so that predicates on it
    reach the scan.
    """
    name = f"`{field.name}`"
    given, wanted = df.schema[field.name].dataType, field.dataType
    column = F.col(name)
    if given == wanted:
        return column
    made = column.cast(wanted)
    numbers = isinstance(given, T.NumericType) and isinstance(wanted, T.NumericType)
    widened = isinstance(given, T.IntegralType) and isinstance(wanted, (T.LongType, T.DecimalType))
    if isinstance(given, T.StringType) and not isinstance(wanted, T.StringType):
        return _from_text(field, column).alias(field.name)
    if isinstance(given, (T.TimestampType, T.TimestampNTZType)) and isinstance(wanted, T.DateType):
        kept = made.cast(given).eqNullSafe(column)
    elif not numbers or widened:
        return made.alias(field.name)
    else:
        kept = made.cast(given).eqNullSafe(column)
    return F.when(kept, made).otherwise(_refused(field, column)).alias(field.name)


def _refused(field: T.StructField, column: Column) -> Column:
    message = F.concat(
        F.lit(f"{field.name} does not fit {field.dataType.simpleString()}: "),
        F.coalesce(column.cast("string"), F.lit("")),
    )
    return F.raise_error(message).cast(field.dataType)


def _from_text(field: T.StructField, column: Column) -> Column:
    """Text as a number, day or time that says the same; anything else raises."""
    wanted, text = field.dataType, F.trim(column)
    made = text.try_cast(wanted)
    if isinstance(wanted, (T.IntegralType, T.DecimalType)):
        # All digits of the text, in a type that has them: a decimal for what it can hold
        # (38 digits, up to 18 of them decimals), whole numbers of 38 digits.
        places = 18 if not isinstance(wanted, T.DecimalType) else max(18, wanted.scale)
        whole = text.try_cast("decimal(38,0)")
        # Compared in one type: a common type of two wide decimals may round.
        fine = T.DecimalType(38, places)
        same = (text.try_cast(fine) == made.try_cast(fine)) & (_decimals(text) <= places)
        plain = text.rlike(r"^[+-]?[0-9]+$") & (whole == made)
        kept = F.coalesce(plain, F.lit(False)) | F.coalesce(same, F.lit(False))
    elif isinstance(wanted, T.DateType):
        moment = text.try_cast(T.TimestampNTZType())
        kept = F.coalesce(made.cast(T.TimestampNTZType()) == moment, F.lit(False))
    else:
        kept = made.isNotNull()
    blank = column.isNull() | (text == "")
    return F.when(blank, F.lit(None).cast(wanted)).when(kept, made).otherwise(_refused(field, column))


def _decimals(text: Column) -> Column:
    """Digits behind the point that count; of a number with an exponent, none are known."""
    digits = F.rtrim(F.regexp_extract(text, r"^[+-]?[0-9]*\.([0-9]*)$", 1), F.lit("0"))
    return F.when(text.rlike("[eE]"), F.lit(99)).otherwise(F.length(digits))

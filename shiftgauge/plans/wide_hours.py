"""Work hours of minutes that need more than 38 digits, or are floating-point numbers.

Same results as ``work_hours``, and exact: minutes are summed in pieces as whole numbers, so
no order of rows or partitions changes a sum, a mean or a flag. A floating-point number counts
as the number it is (0.1 is a little more than a tenth). The comparison ``t < mean - sd``,
``(S - n t) > 0 and (n - 1) (S - n t)^2 > n (n Q - S S)``, is decided in floating point where
both sides are apart by more than that can be wrong, and otherwise with all digits.
Numbers of at most ``wide.NARROW`` limbs have a column a limb wherever every user-day passes.

User-days carry their minutes as limbs (``functions/wide.py``) that are aligned: all of a
result count the same unit, the least that occurs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftgauge.checkpoints import store
from shiftgauge.functions import wide
from shiftgauge.operators.members import attach_to_members
from shiftgauge.operators.sizing import payload
from shiftgauge.schemas import DAY, MINUTES, TEAM, USER

LIMBS = "_limbs"
_HIGH, _LOW = "_high", "_low"

#: Both sides of the comparison, rounded, are wrong by far less than this share.
_MARGIN = 1e-9
#: The same for narrow numbers, beyond what the two parts of ``S - n t`` are wrong by.
_NARROW_MARGIN, _PART_MARGIN = 1e-12, 2.0**-45
#: Whole digits up to which a decimal type's sums cannot overflow (10 digits more for 10^10 rows).
_SAFE_DIGITS = 28


@dataclass(frozen=True)
class WideDays:
    """Stored user-days with aligned ``_limbs`` (NULL: minutes are missing)."""

    days: DataFrame
    base: int
    exponent: int  # the unit is 2^exponent (binary) or 10^exponent (decimal) minutes
    width: int  # limbs of the longest

    @property
    def narrow(self) -> bool:
        return self.width <= wide.NARROW


def is_floating(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.FloatType, T.DoubleType))


def may_overflow(data_type: T.DataType) -> bool:
    """Can a sum of user-days leave the 38 digits of a decimal?"""
    return isinstance(data_type, T.DecimalType) and data_type.precision > _SAFE_DIGITS


# --- user-days ---------------------------------------------------------------------


def floating_days(rows: DataFrame) -> WideDays:
    """User-days of floating-point minutes; NaN and infinite ones are missing.

    The classes of exponents that occur are found first, from the minutes alone. If they are
    few, every limb is one sum. If not, rows are summed per class in the partial aggregation
    before the shuffle, and the classes of a user-day are joined to one number after it.
    """
    minutes = F.col(MINUTES).cast("double")
    finite = F.when(~F.isnan(minutes) & (F.abs(minutes) != float("inf")), minutes)
    pieces = wide.binary_pieces(F.col("_x"))
    values = rows.select(finite.alias("_x")).select(pieces["class"].alias("_class"))
    seen = values.agg(F.min("_class").alias("least"), F.max("_class").alias("most")).first()
    rows = rows.select(DAY, TEAM, USER, finite.alias("_x"))
    rows = rows.select(DAY, TEAM, USER, *[c.alias(f"_{k}") for k, c in pieces.items()])
    least, most = seen["least"] or 0, seen["most"] or 0
    if most - least + 3 + _ROOM + 1 <= wide.NARROW:
        return _narrow_days(rows, least, most)
    return _classed_days(rows)


#: Limbs that the sums of 2^34 rows may need more than a row, the sign apart.
_ROOM = 3


def _narrow_days(rows: DataFrame, least: int, most: int) -> WideDays:
    """User-days of rows whose classes lie from ``least`` to ``most``: a sum for each limb."""
    of = F.col("_class")
    sums = []
    for k in range(least, most + 3):
        piece = F.when(of == k, F.col("_p0")).when(of == k - 1, F.col("_p1"))
        piece = piece.when(of == k - 2, F.col("_p2")).otherwise(F.lit(0).cast("bigint"))
        sums.append(F.sum(piece).alias(f"_s{k - least}"))
    stray = F.max(F.coalesce((of < least) | (of > most), F.lit(False))).alias("_stray")
    days = rows.groupBy(DAY, TEAM, USER).agg(F.max(of.isNull()).alias("_lost"), stray, *sums)
    limbs = wide.carried_bits([F.col(f"_s{i}") for i in range(len(sums))], _ROOM)
    days = days.select(
        DAY, TEAM, USER, "_stray", F.when(~F.col("_lost"), F.array(*limbs)).alias(LIMBS)
    )
    at = [F.get(LIMBS, F.lit(i)) for i in range(len(limbs))]
    filled = at[-1].bitwiseAND(F.lit(wide.BINARY - 1))  # what limbs above a number hold
    used = F.lit(0)
    for i, limb in enumerate(at[:-1]):
        used = F.when(limb != filled, F.lit(i + 1)).otherwise(used)
    # The largest place counts, so the last condition that holds is asked first.
    days, seen = store(days, used=F.max(used), stray=F.max("_stray"))
    if seen["stray"]:
        raise RuntimeError("the rows changed between two reads")
    used = seen["used"] or 0
    short = F.when(F.col(LIMBS).isNotNull(), F.array(*at[:used], at[-1]))
    days = days.select(DAY, TEAM, USER, short.alias(LIMBS))
    return WideDays(days, wide.BINARY, wide.BITS * least - wide.SHIFT, used + 1)


def _classed_days(rows: DataFrame) -> WideDays:
    """User-days of rows of any classes."""
    classes = rows.groupBy(DAY, TEAM, USER, "_class").agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(f"_p{i}").alias(f"p{i}") for i in range(3)]
    )
    part = F.struct(F.col("_class").alias("class"), "p0", "p1", "p2")
    days = classes.groupBy(DAY, TEAM, USER).agg(
        F.max(F.col("_class").isNull()).alias("_lost"),
        F.min("_class").alias("_least"),
        F.max("_class").alias("_most"),
        # One entry for each class that occurs, at most 77.
        F.collect_list(F.when(F.col("_class").isNotNull(), part)).alias("_parts"),
    )
    joined = wide.joined_pieces(F.col("_parts"), F.col("_least"), F.col("_most"))
    limbs = F.when(~F.col("_lost"), wide.carried(joined, wide.BINARY))
    days = days.select(DAY, TEAM, USER, "_least", limbs.alias(LIMBS))
    end = F.col("_least") + F.size(LIMBS)
    days, seen = store(days, least=F.min("_least"), end=F.max(end))
    least, end = seen["least"] or 0, seen["end"] or 1
    aligned = wide.shifted(F.col(LIMBS), F.col("_least") - F.lit(least))
    days = days.select(DAY, TEAM, USER, aligned.alias(LIMBS))
    return WideDays(days, wide.BINARY, wide.BITS * least - wide.SHIFT, end - least)


def split_sums(data_type: T.DecimalType) -> list[Column]:
    """Sums of the high and the low part of decimal minutes, neither of which can overflow."""
    part = _part(data_type)
    low = F.col(MINUTES) % part
    high = ((F.col(MINUTES) - low) / part).cast("decimal(28,0)")
    return [F.sum(high).alias(_HIGH), F.sum(low).alias(_LOW)]


def _part(data_type: T.DecimalType) -> Column:
    places = _part_digits(data_type)
    return F.lit(10**places).cast(T.DecimalType(places + 1, 0))


def _part_digits(data_type: T.DecimalType) -> int:
    return max(0, data_type.precision - max(data_type.scale, 0) - 24)


def split_minutes(data_type: T.DecimalType) -> Column:
    """The minutes of split sums as a floating-point number; NULL if some are missing."""
    whole = F.col(_HIGH).cast("double") * 10.0 ** _part_digits(data_type)
    return F.when(F.col("_complete"), whole + F.col(_LOW).cast("double"))


def decimal_days(days: DataFrame, given: T.DataType) -> WideDays:
    """User-days with whole or decimal minutes, or the split sums of ``given``, as limbs."""
    scale = given.scale if isinstance(given, T.DecimalType) else 0
    if _HIGH in days.columns:
        factor = _part_digits(given) + scale
        up = wide.times(wide.decimal_limbs(F.col(_HIGH)), F.lit(10 ** (factor % wide.DIGITS)))
        up = wide.shifted(up, factor // wide.DIGITS)
        limbs = wide.plus(up, wide.decimal_limbs(F.col(_LOW)))
    else:
        scale = days.schema[MINUTES].dataType.scale if scale else 0
        limbs = wide.decimal_limbs(F.col(MINUTES).cast(T.DecimalType(38, scale)))
    known = F.col("_complete") if "_complete" in days.columns else F.col(MINUTES).isNotNull()
    days = days.select(DAY, TEAM, USER, F.when(known, limbs).alias(LIMBS))
    days = days.withColumn(LIMBS, wide.carried(F.col(LIMBS), wide.DECIMAL))
    days, seen = store(days, width=F.max(F.size(LIMBS)))
    return WideDays(days, wide.DECIMAL, -scale, seen["width"] or 1)


# --- teams -------------------------------------------------------------------------


def team_days(own: WideDays) -> DataFrame:
    """_n, limbs of _total and _spread (n (n Q - S S)), mean and deviation in minutes."""
    base = own.base
    teams = _narrow_sums(own) if own.narrow else _wide_sums(own)
    teams = teams.select(
        DAY,
        TEAM,
        "_members",
        F.when(F.col("_complete"), wide.carried(F.col("_total"), base)).alias("_total"),
        F.when(F.col("_complete"), wide.carried(F.col("_squares"), base)).alias("_squares"),
    )
    several = wide.times(F.col("_squares"), F.col("_members"))
    spread = wide.plus(several, wide.product(F.col("_total"), F.col("_total")), -1)
    teams = teams.withColumn("_spread", wide.carried(spread, base)).drop("_squares")
    members = F.col("_members").cast("double")
    mean = wide.to_double(F.col("_total"), base, own.exponent) / members
    spread = wide.to_double(F.col("_spread"), base, 2 * own.exponent)
    variance = spread / members / F.nullif(members - 1, F.lit(0.0))
    teams = teams.withColumns({"_mean": mean, "_deviation": F.sqrt(variance)})
    return teams.withColumn(
        "_spread", wide.carried(wide.times(F.col("_spread"), F.col("_members")), base)
    )


def _narrow_sums(own: WideDays) -> DataFrame:
    """_members, _complete and not carried limbs of _total and _squares, per day and team."""
    limbs = {f"_l{i}": c for i, c in enumerate(wide.spelt(F.col(LIMBS), own.width))}
    days = own.days.select(
        DAY, TEAM, F.col(LIMBS).isNotNull().alias("_known"), *[c.alias(k) for k, c in limbs.items()]
    )
    squares = {f"_p{k}": c for k, c in enumerate(wide.square([F.col(name) for name in limbs]))}
    days = days.select("*", *[c.alias(k) for k, c in squares.items()])
    sums = [F.sum(name).alias(name) for name in limbs]
    for k, name in enumerate(squares):  # products may take all 64 bits, their halves do not
        low, high = wide.halves(F.col(name), own.base)
        sums += [F.sum(low).alias(f"_low{k}"), F.sum(high).alias(f"_high{k}")]
    n = F.count(F.lit(1))
    teams = days.groupBy(DAY, TEAM).agg(
        n.alias("_members"), (F.count_if(F.col("_known")) == n).alias("_complete"), *sums
    )
    last = len(squares) - 1
    square = [F.col("_low0")]
    square += [F.col(f"_low{k}") + F.col(f"_high{k - 1}") for k in range(1, last + 1)]
    return teams.select(
        DAY,
        TEAM,
        "_members",
        "_complete",
        F.array(*limbs).alias("_total"),
        F.array(*square, F.col(f"_high{last}")).alias("_squares"),
    )


def _wide_sums(own: WideDays) -> DataFrame:
    """``_narrow_sums`` for limbs of any number."""
    t, base = F.col(LIMBS), own.base
    squares = wide.carried(wide.product(t, t), base)
    zero = F.lit(0).cast("bigint")
    sums = [F.sum(F.coalesce(F.get(t, F.lit(i)), zero)).alias(f"_s{i}") for i in range(own.width)]
    wider = 2 * own.width + 3
    sums += [F.sum(F.coalesce(F.get("_square", F.lit(i)), zero)).alias(f"_q{i}") for i in range(wider)]
    days = own.days.select(DAY, TEAM, LIMBS, squares.alias("_square"))
    n = F.count(F.lit(1))
    teams = days.groupBy(DAY, TEAM).agg(
        n.alias("_members"), (F.count(LIMBS) == n).alias("_complete"), *sums
    )
    return teams.select(
        DAY,
        TEAM,
        "_members",
        "_complete",
        F.array(*[f"_s{i}" for i in range(own.width)]).alias("_total"),
        F.array(*[f"_q{i}" for i in range(wider)]).alias("_squares"),
    )


def with_team(
    own: WideDays, wanted: list[str], limit_bytes: int, large_share: int
) -> DataFrame:
    """User-days with ``wanted`` of the columns of their ``team_days``; limbs travel as text."""
    texts = {c: wide.to_text(F.col(c)) for c in ("_total", "_spread") if c in wanted}
    stats = team_days(own)
    rounded = {r: wide.to_double(F.col(c), own.base, 0) for r, c in _ROUNDED.items() if r in wanted}
    stats = stats.withColumns(rounded).withColumns(texts)
    stats = stats.select(DAY, TEAM, F.col("_members").cast("decimal(20,0)").alias("_n"), *wanted)
    stats, measured = store(stats, bytes=payload(stats.drop("_n")), members=F.sum("_n"))
    return attach_to_members(
        own.days,
        stats,
        keys=[DAY, TEAM],
        size="_n",
        spread_by=USER,
        stats_bytes=measured["bytes"],
        total_members=measured["members"],
        limit_bytes=limit_bytes,
        large_share=large_share,
    )


_ROUNDED = {"_total_near": "_total", "_spread_near": "_spread"}


def flag_needs(own: WideDays) -> list[str]:
    return ["_members", "_total", "_spread", *(_ROUNDED if own.narrow else [])]


def with_flag(joined: DataFrame, own: WideDays, name: str) -> DataFrame:
    """Add the flag from ``_limbs`` and ``flag_needs``; NULL for one member or missing minutes."""
    if own.narrow:
        return joined.withColumn(name, _narrow_flag(own))
    base, n = own.base, F.col("_members")
    below = wide.plus(wide.from_text(F.col("_total")), wide.times(F.col(LIMBS), n), -1)
    joined = joined.withColumn("_below", wide.carried(below, base))
    joined = joined.withColumn("_spread", wide.from_text(F.col("_spread")))
    joined = joined.withColumns(
        {
            "_left": F.pow(wide.to_double(F.col("_below"), base, 0), F.lit(2.0)) * (n - 1),
            "_right": wide.to_double(F.col("_spread"), base, 0),
        }
    )
    square = wide.carried(wide.product(F.col("_below"), F.col("_below")), base)
    rest = wide.plus(wide.carried(wide.times(square, n - 1), base), F.col("_spread"), -1)
    flag = (
        F.when((n < 2) | F.col("_below").isNull(), F.lit(None).cast("boolean"))
        .when(~wide.is_positive(F.col("_below")), F.lit(False))
        .when(F.col("_left") > F.col("_right") * (1 + _MARGIN), F.lit(True))
        .when(F.col("_left") < F.col("_right") * (1 - _MARGIN), F.lit(False))
        .otherwise(wide.is_positive(wide.carried(rest, base)))
    )
    return joined.withColumn(name, flag)


def _narrow_flag(own: WideDays) -> Column:
    """The flag where rounded numbers decide it; all digits only where they do not."""
    base, n = own.base, F.col("_members")
    t = wide.approximately(wide.spelt(F.col(LIMBS), own.width), base) * n.cast("double")
    below = F.col("_total_near") - t
    wrong = (F.abs(F.col("_total_near")) + F.abs(t)) * _PART_MARGIN
    least, most = below - wrong, below + wrong
    least, most = least * least * (n - 1), most * most * (n - 1)
    right = F.col("_spread_near")
    missing = F.col(LIMBS).isNull() | F.col("_total").isNull()
    return (
        F.when((n < 2) | missing, F.lit(None).cast("boolean"))
        .when((right == 0) | (below + wrong < 0), F.lit(False))
        .when((below - wrong > 0) & (least > right * (1 + _NARROW_MARGIN)), F.lit(True))
        .when(most < right * (1 - _NARROW_MARGIN), F.lit(False))
        .otherwise(_exact_flag(base))
    )


def _exact_flag(base: int) -> Column:
    n = F.col("_members")

    def beyond(below: Column) -> Column:
        square = wide.carried(wide.product(below, below), base)
        sides = wide.carried(wide.times(square, n - 1), base)
        rest = wide.carried(wide.plus(sides, wide.from_text(F.col("_spread")), -1), base)
        return wide.is_positive(below) & wide.bound(rest, wide.is_positive)

    below = wide.plus(wide.from_text(F.col("_total")), wide.times(F.col(LIMBS), n), -1)
    return wide.bound(wide.carried(below, base), beyond)


def minutes_of(own: WideDays) -> Column:
    """The minutes of a user-day as a floating-point number."""
    if own.narrow and own.base == wide.BINARY:
        value = wide.bits_to_double(wide.spelt(F.col(LIMBS), own.width), own.exponent)
        return F.when(F.col(LIMBS).isNotNull(), value)
    return wide.to_double(F.col(LIMBS), own.base, own.exponent)

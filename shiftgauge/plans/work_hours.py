"""Work hours per day, team and user, and days on which a user fell behind the team.

All functions take period rows (day, team, user, minutes). Missing minutes make
every result that depends on them NULL, and NULL teams and users are groups like
any other. Days without rows do not count for anybody.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftgauge.checkpoints import store
from shiftgauge.functions import threshold
from shiftgauge.functions.strict import if_complete, strict_avg, strict_stddev, strict_sum
from shiftgauge.operators.members import LARGE_SHARE, attach_to_members
from shiftgauge.operators.sizing import BROADCAST_BYTES, payload
from shiftgauge.plans import wide_hours
from shiftgauge.schemas import DAY, MINUTES, TEAM, USER

# Output columns.
HOURS, MEAN, DEVIATION = "MUNKAORA", "MUNKAORA_ATLAG", "MUNKAORA_SZORAS"
FLAG, COUNT = "GYANUS_NAP", "GYANUS_NAPO_DB"

MINUTES_PER_HOUR = 60

_CUTOFF = "_largest"
#: Decimals up to which the type of the minutes is taken as it is. Of wider types, only
#: the decimals that occur are kept, which leaves the exact threshold more whole digits.
_PLAIN_DECIMALS = 6


def user_day_hours(rows: DataFrame) -> DataFrame:
    """Hours per day, team and user."""
    kind = rows.schema[MINUTES].dataType
    if wide_hours.is_floating(kind):
        own = wide_hours.floating_days(rows)
        return own.days.select(DAY, TEAM, USER, _wide_hours(own).alias(HOURS))
    days, hours = _user_days(rows), _hours()
    if wide_hours.may_overflow(kind):
        hours = F.coalesce(hours, wide_hours.split_minutes(kind) / MINUTES_PER_HOUR)
    return days.select(DAY, TEAM, USER, hours.alias(HOURS))


def team_day_stats(rows: DataFrame) -> DataFrame:
    """Mean and sample standard deviation of the hours of the users present, per day and team."""
    kind, days = rows.schema[MINUTES].dataType, _user_days(rows)
    if wide_hours.is_floating(kind) or wide_hours.may_overflow(kind) or _has_wide_scale(days):
        days, _ = _measured(rows)
    if isinstance(days, wide_hours.WideDays):
        return wide_hours.team_days(days).select(DAY, TEAM, *_wide_stats())
    return _team_days(days, [MEAN, DEVIATION]).select(DAY, TEAM, MEAN, DEVIATION)


def user_day_with_stats(
    rows: DataFrame, limit_bytes: int = BROADCAST_BYTES, large_share: int = LARGE_SHARE
) -> DataFrame:
    """Hours per day, team and user next to the mean and deviation of the team that day."""
    joined = _with_team(rows, [MEAN, DEVIATION], limit_bytes, large_share)
    return joined.select(DAY, TEAM, USER, HOURS, MEAN, DEVIATION)


def suspicious_flags(
    rows: DataFrame, limit_bytes: int = BROADCAST_BYTES, large_share: int = LARGE_SHARE
) -> DataFrame:
    """Per day, team and user: are the hours below the team's mean minus one deviation?

    NULL if the user was alone in the team that day or anybody's minutes are missing.
    The comparison is exact for every type of minutes, whatever the order of the rows. A
    floating-point number counts as what it is; NaN and infinite ones are missing.
    """
    joined = _with_team(rows, [MEAN, DEVIATION, FLAG], limit_bytes, large_share)
    return joined.select(DAY, TEAM, USER, HOURS, MEAN, DEVIATION, FLAG)


def suspicious_days(
    rows: DataFrame, limit_bytes: int = BROADCAST_BYTES, large_share: int = LARGE_SHARE
) -> DataFrame:
    """Number of suspicious days per team and user; NULL if any of the days is undecided."""
    joined = _with_team(rows, [FLAG], limit_bytes, large_share)
    return joined.groupBy(TEAM, USER).agg(strict_sum(F.col(FLAG).cast("bigint")).alias(COUNT))


def _hours() -> Column:
    return F.col(MINUTES).cast("double") / MINUTES_PER_HOUR


def _wide_hours(own: wide_hours.WideDays) -> Column:
    return wide_hours.minutes_of(own) / MINUTES_PER_HOUR


def _wide_stats() -> list[Column]:
    names = {"_mean": MEAN, "_deviation": DEVIATION}
    return [(F.col(c) / MINUTES_PER_HOUR).alias(name) for c, name in names.items()]


def _user_days(rows: DataFrame) -> DataFrame:
    """Summed minutes; types whose sums can overflow have their split sums beside them."""
    keys, minutes = [DAY, TEAM, USER], F.col(MINUTES)
    kind = rows.schema[MINUTES].dataType
    if not wide_hours.may_overflow(kind):
        return rows.groupBy(*keys).agg(strict_sum(minutes).alias(MINUTES))
    complete = (F.count(minutes) == F.count(F.lit(1))).alias("_complete")
    total = if_complete(minutes, F.try_sum(minutes)).alias(MINUTES)
    return rows.groupBy(*keys).agg(total, complete, *wide_hours.split_sums(kind))


def _measured(rows: DataFrame) -> tuple[DataFrame | wide_hours.WideDays, bool]:
    """Stored user-days, as limbs if a sum was too large; do exact team sums have 38 digits?

    They do if the product of all user-days and the largest of them stays below 10^19.
    """
    kind = rows.schema[MINUTES].dataType
    if wide_hours.is_floating(kind):
        return wide_hours.floating_days(rows), False
    days = _user_days(rows)
    threshold.require_ansi(days.sparkSession)
    minutes = F.col(MINUTES)
    measures = {"most": F.max(F.abs(minutes.cast("double"))), "n": F.count(F.lit(1))}
    if _has_wide_scale(days):
        measures["decimals"] = F.max(threshold.decimals(minutes))
    if "_complete" in days.columns:
        measures["lost"] = F.count_if(F.col("_complete") & minutes.isNull())
    days, seen = store(days, **measures)
    if seen.get("lost"):
        return wide_hours.decimal_days(days, kind), False
    scale = threshold.scale_of(days.schema[MINUTES].dataType)
    if "decimals" in seen:
        # Minutes of a wide type get one of as many decimals as occur.
        wide, scale = days.schema[MINUTES].dataType, seen["decimals"] or 0
        narrow = T.DecimalType(wide.precision - wide.scale + scale, scale)
        days = days.withColumn(MINUTES, minutes.cast(narrow))
    days = days.select(DAY, TEAM, USER, MINUTES)
    return days, (seen["most"] or 0) * 10.0**scale * max(1, seen["n"]) < 9e18


def _has_wide_scale(days: DataFrame) -> bool:
    data_type = days.schema[MINUTES].dataType
    return threshold.is_exact(data_type) and threshold.scale_of(data_type) > _PLAIN_DECIMALS


def _team_days(days: DataFrame, wanted: list[str]) -> DataFrame:
    """One row per day and team, from one row per day, team and user: ``_n`` and ``wanted``.

    The cutoff is exact: totals are known to fit. Mean and deviation are floating-point numbers, made
    from exact sums as far as these fit, and otherwise from floating-point sums.
    """
    data_type = days.schema[MINUTES].dataType
    members = F.count(F.lit(1)).cast("decimal(20,0)").alias("_n")
    floating = [strict_avg(_hours()).alias("_mean"), strict_stddev(_hours()).alias("_deviation")]
    whole = threshold.is_exact(data_type)
    if not whole or (_CUTOFF not in wanted and threshold.scale_of(data_type) > _PLAIN_DECIMALS):
        rows = days.groupBy(DAY, TEAM).agg(members, *floating)
        return rows.select(
            DAY, TEAM, "_n", F.col("_mean").alias(MEAN), F.col("_deviation").alias(DEVIATION)
        )

    t = F.col("_t")
    units = threshold.whole_units(F.col(MINUTES), data_type).alias("_t")
    units = days.select(DAY, TEAM, MINUTES, units).groupBy(DAY, TEAM)
    n, total, spread = (F.col(c).cast("double") for c in ("_n", "_sum", "_spread"))
    per_hour = F.lit(float(MINUTES_PER_HOUR * 10 ** threshold.scale_of(data_type)))
    mean = total / n / per_hour
    deviation = F.sqrt(spread / F.nullif(n * (n - 1), F.lit(0.0))) / per_hour
    if _CUTOFF in wanted:
        squares = if_complete(t, F.sum(t * t)).alias("_squares")
        totals = units.agg(members, strict_sum(t).alias("_sum"), squares)
        totals = threshold.with_largest_below(totals, "_units")
    else:
        # What could leave 38 digits is not taken.
        small = (t < 10**18) & (t > -(10**18))
        squares = if_complete(t, F.try_sum(F.when(small, t * t))).alias("_squares")
        most = F.max(F.abs(t.cast("double"))).alias("_most")
        sums = if_complete(t, F.try_sum(t)).alias("_sum")
        totals = units.agg(members, sums, squares, most, *floating)
        fits = F.col("_most") * n < 9e18
        totals = totals.withColumn("_spread", F.when(fits, threshold.spread()))
        mean = F.coalesce(mean, F.col("_mean"))
        deviation = F.when(fits, deviation).otherwise(F.col("_deviation"))
    largest = threshold.from_units(F.col("_units"), data_type)
    made = {_CUTOFF: largest, MEAN: mean, DEVIATION: deviation}
    return totals.select(DAY, TEAM, "_n", *[made[c].alias(c) for c in wanted])


def _with_team(
    rows: DataFrame, wanted: list[str], limit_bytes: int, large_share: int
) -> DataFrame:
    """User-days with their hours and ``wanted``: mean, deviation, flag.

    The user-days are needed twice, once to be summarised and once to be compared.
    They are stored in between, so the period rows are read and shuffled once. The
    statistics are stored too: their size is known before the join is chosen. Where the
    exact threshold needs more than 38 digits, the user-days are compared as limbs.
    """
    days, fits = _measured(rows)
    if FLAG in wanted and not fits and not isinstance(days, wide_hours.WideDays):
        days = wide_hours.decimal_days(days, days.schema[MINUTES].dataType)
    if isinstance(days, wide_hours.WideDays):
        needs = [*(wide_hours.flag_needs(days) if FLAG in wanted else [])]
        needs += ["_mean", "_deviation"] if MEAN in wanted else []
        joined = wide_hours.with_team(days, needs, limit_bytes, large_share)
        if FLAG in wanted:
            joined = wide_hours.with_flag(joined, days, FLAG)
        made = [*(_wide_stats() if MEAN in wanted else []), *([FLAG] if FLAG in wanted else [])]
        return joined.select(DAY, TEAM, USER, _wide_hours(days).alias(HOURS), *made)
    needs = [_CUTOFF if c == FLAG else c for c in wanted]
    stats = _team_days(days, needs)
    stats, measured = store(stats, bytes=payload(stats.drop("_n")), members=F.sum("_n"))
    joined = attach_to_members(
        days,
        stats,
        keys=[DAY, TEAM],
        size="_n",
        spread_by=USER,
        stats_bytes=measured["bytes"],
        total_members=measured["members"],
        limit_bytes=limit_bytes,
        large_share=large_share,
    )
    if FLAG in wanted:
        joined = joined.withColumn(FLAG, F.col(MINUTES) <= F.col(_CUTOFF))
    return joined.select(DAY, TEAM, USER, _hours().alias(HOURS), *wanted)

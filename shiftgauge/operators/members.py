"""Give every member of a group the statistics of its group."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftgauge.operators.sizing import BROADCAST_BYTES

#: A group is "large" if it holds more than 1/LARGE_SHARE of all members, so there
#: are always fewer than LARGE_SHARE large groups.
LARGE_SHARE = 1000


def attach_to_members(
    members: DataFrame,
    stats: DataFrame,
    keys: list[str],
    size: str,
    spread_by: str,
    stats_bytes: int,
    total_members: Decimal | None,
    limit_bytes: int = BROADCAST_BYTES,
    large_share: int = LARGE_SHARE,
) -> DataFrame:
    """Left join ``members`` to ``stats`` (one row per key), NULL keys matching NULL keys.

    ``size`` names the member count in ``stats``, which members do not get; ``spread_by``
    is a column that is distinct within a group. ``stats_bytes`` and ``total_members`` are
    the measured payload of the other columns of ``stats`` and the sum of its counts. Both inputs should be cheap to
    read again.

    Statistics that fit are broadcast, and the members stay where they are.
    Otherwise the fewer than ``large_share`` large groups are attached by a broadcast,
    and the rest by a shuffle join in which the members of large groups, already
    served, get keys that spread them over all tasks. No task then receives much
    more than 1/``large_share`` of the members on account of one group.
    """
    extra = [name for name in stats.columns if name not in (*keys, size)]
    if stats_bytes <= limit_bytes:
        joined = members.alias("m").join(F.broadcast(stats).alias("s"), _same(keys, "m", "s"), "left")
        return joined.select("m.*", *[F.col(f"s.{name}") for name in extra])

    packed = F.struct(*[F.col(name) for name in extra])
    is_large = F.col(size) * large_share > F.lit(total_members)
    large = stats.where(is_large).select(*keys, packed.alias("_large"))
    served = serve_large(members, large, keys, spread_by, large_share)
    # Not a literal: a constant would be optimised out of the join keys, and with it
    # the spreading of the members.
    spread = F.when(is_large, F.lit(-1)).otherwise(F.lit(0)).alias("_spread")
    rest = stats.select(*keys, packed.alias("_rest"), spread)
    joined = served.alias("m").join(
        rest.alias("s"),
        _same(keys, "m", "s") & (F.col("m._spread") == F.col("s._spread")),
        "left",
    )
    found = F.coalesce("_large", "_rest")
    return joined.select(
        *[F.col(f"m.{name}") for name in members.columns],
        *[found.getField(name).alias(name) for name in extra],
    )


def serve_large(
    members: DataFrame, large: DataFrame, keys: list[str], spread_by: str, large_share: int
) -> DataFrame:
    """Attach ``large`` (keys and ``_large``, fewer than ``large_share`` rows) by a broadcast.

    ``_spread`` is 0 for members still to be served and 1..``large_share``, by their own
    value, for those that need nothing more but a way through the shuffle.
    """
    joined = members.alias("m").join(F.broadcast(large).alias("s"), _same(keys, "m", "s"), "left")
    own = F.pmod(F.xxhash64(F.col(f"m.{spread_by}")), F.lit(large_share)) + 1
    spread = F.when(F.col("_large").isNull(), F.lit(0)).otherwise(own)
    return joined.select("m.*", "_large", spread.cast("int").alias("_spread"))


def _same(keys: list[str], left: str, right: str) -> Column:
    return reduce(
        lambda a, b: a & b,
        [F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}")) for key in keys],
    )

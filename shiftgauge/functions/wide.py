"""Whole numbers of any size as columns: arrays of limbs, lowest first.

A number is the sum of ``limb[i] * base**i``. *Carried* limbs are in [0, base) but for the
last, which is 0 or -1 and so the sign. Sums and products of carried limbs are taken limb by
limb in 64 bits and carried again: with a base of 28 bits or 8 digits a product has room
for a hundred limbs, and a sum for 2^34 of them.

Floating-point numbers are exact in units of 2^(28 * class - SHIFT): the 53 bits of a number
lie in three neighbouring limbs, the first of which is its class. Sums over pieces are sums of
whole numbers, so they do not depend on the order of rows.

Functions over arrays are interpreted row by row. For numbers of at most ``NARROW`` limbs there
are functions over a list of columns, one a limb, which are compiled.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 28
BINARY = 1 << BITS
DIGITS = 8
DECIMAL = 10**DIGITS

#: Limbs up to which numbers are spelt out, one column a limb.
NARROW = 12

#: The least bit of any floating-point number is at 2^-1074, and its class is found from an
#: exponent that may be two too small.
SHIFT = 1130

_MASK = BINARY - 1


def _long(value: int | Column) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("bigint")


def carried(limbs: Column, base: int, room: int = 3) -> Column:
    """The same number with carried limbs; ``room`` limbs more than before, and the sign."""
    padded = F.concat(limbs, F.array_repeat(_long(0), room))
    start = F.struct(_long(0).alias("carry"), F.array().cast("array<bigint>").alias("out"))

    def step(state, limb):
        total = state["carry"] + limb
        low = F.pmod(total, _long(base))
        carry = F.call_function("div", total - low, _long(base))
        return F.struct(carry.alias("carry"), F.concat(state["out"], F.array(low)).alias("out"))

    return F.aggregate(
        padded, start, step, lambda state: F.concat(state["out"], F.array(state["carry"]))
    )


def plus(a: Column, b: Column, factor: int = 1) -> Column:
    """a + factor * b, not carried."""
    zero = _long(0)
    return F.zip_with(a, b, lambda x, y: F.coalesce(x, zero) + F.coalesce(y, zero) * _long(factor))


def times(a: Column, count: Column) -> Column:
    """Carried limbs times a whole number below 2^34, not carried."""
    return F.transform(a, lambda x: x * count)


def product(a: Column, b: Column) -> Column:
    """Product of carried limbs, not carried."""

    def limb(k):
        first, last = F.greatest(F.lit(0), k - F.size(b) + 1), F.least(k, F.size(a) - 1)
        return F.aggregate(
            F.sequence(first, last), _long(0), lambda s, i: s + F.get(a, i) * F.get(b, k - i)
        )

    return F.transform(F.sequence(F.lit(0), F.size(a) + F.size(b) - 2), limb)


def is_positive(a: Column) -> Column:
    """Sign of carried limbs."""
    return (F.element_at(a, -1) >= 0) & F.exists(a, lambda x: x != 0)


def shifted(a: Column, limbs: int | Column) -> Column:
    """Times base**limbs."""
    limbs = limbs if isinstance(limbs, Column) else F.lit(limbs)
    return F.concat(F.array_repeat(_long(0), limbs.cast("int")), a)


def to_double(a: Column, base: int, exponent: int) -> Column:
    """Carried limbs in units of 2^exponent (10^exponent) as the nearest number or one beside it."""
    negative = F.element_at(a, -1) < 0
    size = F.when(negative, carried(F.transform(a, lambda x: -x), base)).otherwise(a)
    places = F.sequence(F.size(a) - 1, F.lit(0), F.lit(-1))
    if base == BINARY:

        def weigh(s, i):  # a limb of 0 may stand where powers are beyond all numbers
            limb = F.get(size, i).cast("double")
            return s + F.when(limb == 0, F.lit(0.0)).otherwise(limb * _power(BITS * i + exponent))

        value = F.aggregate(places, F.lit(0.0), weigh)
    else:
        value = F.aggregate(
            F.reverse(size), F.lit(0.0), lambda s, x: s * F.lit(float(DECIMAL)) + x.cast("double")
        )
        value = value / F.lit(10.0**-exponent) if exponent < 0 else value * F.lit(10.0**exponent)
    return F.when(negative, -value).otherwise(value)


def _power(exponent: Column) -> Column:
    """2^exponent, exactly: of whole arguments the power is exact where it can be."""
    return F.pow(F.lit(2.0), exponent.cast("double"))


def to_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda x: x.cast("string")), ",")


def from_text(text: Column) -> Column:
    return F.transform(F.split(text, ","), lambda x: x.cast("bigint"))


def bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, with ``value`` computed once and not before it is needed."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


# --- limbs in columns --------------------------------------------------------------


def spelt(a: Column, width: int) -> list[Column]:
    """The ``width`` limbs of an array; 0 where it is shorter or NULL."""
    return [F.coalesce(F.get(a, F.lit(i)), _long(0)) for i in range(width)]


def carried_bits(limbs: list[Column], room: int = 3) -> list[Column]:
    """``carried`` of base ``BINARY``."""
    out, carry = [], None
    for limb in [*limbs, *[_long(0)] * room]:
        total = limb if carry is None else limb + carry
        out.append(total.bitwiseAND(_long(_MASK)))
        carry = F.shiftright(total, BITS)
    return [*out, carry]


def square(limbs: list[Column]) -> list[Column]:
    """Square of carried limbs, not carried."""
    out = []
    for k in range(2 * len(limbs) - 1):
        first, last = max(0, k - len(limbs) + 1), min(k, len(limbs) - 1)
        pairs = [limbs[i] * limbs[k - i] * _long(2) for i in range(first, last + 1) if i < k - i]
        out.append(reduce(add, pairs + ([limbs[k // 2] * limbs[k // 2]] if k % 2 == 0 else [])))
    return out


def halves(limb: Column, base: int) -> tuple[Column, Column]:
    """What a limb keeps, in [0, base), and what it carries to the next one."""
    low = F.pmod(limb, _long(base))
    return low, F.call_function("div", limb - low, _long(base))


def bits_to_double(limbs: list[Column], exponent: int) -> Column:
    """``to_double`` of base ``BINARY``: the same number."""
    negative = limbs[-1] < 0
    value = F.lit(0.0)
    negated = carried_bits([-x for x in limbs], 0)
    for i in reversed(range(len(limbs))):
        limb = F.when(negative, negated[i]).otherwise(limbs[i]).cast("double")
        weight = F.lit(_weight(BITS * i + exponent))
        value = value + F.when(limb == 0, F.lit(0.0)).otherwise(limb * weight)
    return F.when(negative, -value).otherwise(value)


def _weight(exponent: int) -> float:
    return math.ldexp(1.0, exponent) if exponent < 1024 else math.inf


def approximately(limbs: list[Column], base: int) -> Column:
    """Carried limbs as a floating-point number, wrong by less than a 2^-48th of it."""
    up, down = F.lit(0.0), F.lit(1.0)
    for i, limb in enumerate(limbs[:-1]):  # small ones first
        up = up + limb.cast("double") * F.lit(float(base**i))
        down = down + (_long(base - 1) - limb).cast("double") * F.lit(float(base**i))
    return F.when(limbs[-1] < 0, -down).otherwise(up)


# --- from numbers ------------------------------------------------------------------


def binary_pieces(x: Column) -> dict[str, Column]:
    """Class and three signed pieces of a finite floating-point number; NULL stays NULL."""
    size = F.abs(x.cast("double"))
    # At most the exponent, at least two less; in the bounds of the limbs for zero.
    exponent = F.when(size == 0, F.lit(0)).otherwise(F.floor(F.log2(size)) - 1).cast("int")
    up = F.lit(52) - exponent
    half = F.shiftright(up, 1)
    whole = (size * _power(half) * _power(up - half)).cast("bigint")  # below 2^55
    place = exponent - 52 + SHIFT
    of = F.floor(place / BITS).cast("int")
    left = _power(place - of * BITS).cast("bigint")
    low, high = whole.bitwiseAND(_long(_MASK)) * left, F.shiftright(whole, BITS) * left
    sign = F.when(x < 0, F.lit(-1)).otherwise(F.lit(1)).cast("bigint")
    middle = F.shiftright(low, BITS) + high.bitwiseAND(_long(_MASK))
    return {
        "class": F.when(x.isNotNull(), of),
        "p0": sign * low.bitwiseAND(_long(_MASK)),
        "p1": sign * middle,
        "p2": sign * F.shiftright(high, BITS),
    }


def joined_pieces(parts: Column, least: Column, most: Column) -> Column:
    """Limbs from class ``least`` on of an array of (class, p0, p1, p2), not carried."""

    def limb(k):
        def add(s, p):
            off = k - p["class"]
            return s + F.when(off == 0, p["p0"]).when(off == 1, p["p1"]).when(
                off == 2, p["p2"]
            ).otherwise(_long(0))

        return F.aggregate(parts, _long(0), add)

    return F.transform(F.sequence(least, most + 2), limb)


def decimal_limbs(x: Column, digits: int = 38) -> Column:
    """Limbs of a decimal number in units of its last decimal, not carried."""
    limbs = -(-(digits + 1) // DIGITS)
    # The text has all digits; abs() rounds to 34 of them.
    text = F.translate(x.cast("string"), "-.", "")
    text = F.lpad(text, limbs * DIGITS, "0")
    sign = F.when(x < 0, F.lit(-1)).otherwise(F.lit(1)).cast("bigint")
    at = [1 + DIGITS * i for i in reversed(range(limbs))]
    return F.array(*[F.substring(text, i, DIGITS).cast("bigint") * sign for i in at])

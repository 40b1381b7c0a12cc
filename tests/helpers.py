"""Small inputs and a brute-force evaluation with exact fractions."""

from __future__ import annotations

from collections import defaultdict
from decimal import Decimal
from fractions import Fraction

from shiftgauge.schemas import DAY, MINUTES, TEAM, USER


def period_rows(spark, rows, minutes="decimal(18,2)", day="string"):
    """Rows of (day, team, user, minutes)."""
    number = float if minutes in ("double", "float") else Decimal
    if minutes in ("bigint", "int"):
        number = int
    values = [(d, t, u, None if m is None else number(m)) for d, t, u, m in rows]
    schema = f"{DAY} {day}, {TEAM} string, {USER} string, {MINUTES} {minutes}"
    return spark.createDataFrame(values, schema)


def brute_flags(rows):
    """{(day, team, user): flag}, straight from the definitions, in exact arithmetic."""
    minutes = defaultdict(list)
    for day, team, user, value in rows:
        minutes[day, team, user].append(value)
    totals = {
        key: None if None in values else sum(Fraction(str(v)) for v in values)
        for key, values in minutes.items()
    }
    teams = defaultdict(list)
    for (day, team, _), total in totals.items():
        teams[day, team].append(total)
    flags = {}
    for (day, team, user), total in totals.items():
        members = teams[day, team]
        n = len(members)
        if n == 1 or None in members:
            flags[day, team, user] = None
            continue
        mean = sum(members) / n
        variance = sum((m - mean) ** 2 for m in members) / (n - 1)
        flags[day, team, user] = total < mean and (mean - total) ** 2 > variance
    return flags


def brute_counts(rows):
    """{(team, user): count or None}."""
    days = defaultdict(list)
    for (_, team, user), flag in brute_flags(rows).items():
        days[team, user].append(flag)
    return {key: None if None in flags else sum(flags) for key, flags in days.items()}


def flags_of(df):
    return {(str(r[DAY]), r[TEAM], r[USER]): r["GYANUS_NAP"] for r in df.collect()}


def counts_of(df):
    return {(r[TEAM], r[USER]): r["GYANUS_NAPO_DB"] for r in df.collect()}

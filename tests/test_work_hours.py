from __future__ import annotations

import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import shiftgauge as sg
from shiftgauge.functions.strict import strict_avg, strict_stddev, strict_sum
from shiftgauge.operators.members import serve_large
from shiftgauge.schemas import DAY, TEAM, USER

from helpers import brute_counts, brute_flags, counts_of, flags_of, period_rows

# Broadcast limits: default; none fits, so the statistics are shuffled.
BOTH_JOINS = [{}, {"limit_bytes": 0}, {"limit_bytes": 0, "large_share": 3}]


def random_rows(seed, size=600):
    rng = random.Random(seed)
    rows = []
    for _ in range(size):
        # One team-day holds about a third of all rows.
        hot = rng.random() < 0.35
        day = "2018-07-02" if hot else f"2018-07-{rng.randint(1, 9):02d}"
        team = "A" if hot else rng.choice(["A", "B", "", None, "C"])
        user = rng.choice([None, ""]) if rng.random() < 0.02 else f"u{rng.randint(1, 60)}"
        minutes = None if rng.random() < 0.004 else f"{rng.randint(0, 600)}.{rng.randint(0, 99):02d}"
        rows.append((day, team, user, minutes))
    return rows


def test_strict_aggregates(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (2, 1.0), (2, 3.0)], "k int, v double")
    v = F.col("v")
    rows = df.groupBy("k").agg(
        strict_sum(v).alias("s"), strict_avg(v).alias("a"), strict_stddev(v).alias("d")
    )
    got = {r["k"]: (r["s"], r["a"], r["d"]) for r in rows.collect()}
    assert got[1] == (None, None, None)
    assert got[2] == (4.0, 2.0, pytest.approx(2**0.5))


def test_hours_and_stats(spark):
    df = period_rows(
        spark,
        [("d", "t", "u", "30"), ("d", "t", "u", "60.5"), ("d", "t", "v", "90"), ("e", "t", "u", "6")],
    )
    hours = {(r[DAY], r[USER]): r["MUNKAORA"] for r in sg.user_day_hours(df).collect()}
    assert hours == {("d", "u"): 90.5 / 60, ("d", "v"): 1.5, ("e", "u"): 0.1}
    stats = {r[DAY]: r for r in sg.team_day_stats(df).collect()}
    assert stats["d"]["MUNKAORA_ATLAG"] == pytest.approx((90.5 + 90) / 120)
    assert stats["d"]["MUNKAORA_SZORAS"] == pytest.approx(0.5 / 60 / 2**0.5)
    assert stats["e"]["MUNKAORA_ATLAG"] == pytest.approx(0.1)
    assert stats["e"]["MUNKAORA_SZORAS"] is None


# Three equally spaced or equal members: the lowest is exactly at the threshold.
TIES = [
    ("d", f"t{first}", f"u{i}", first + i * step)
    for first, step in ((60, 60), (426, 6), (6, 0), (7, 1))
    for i in range(3)
]


@pytest.mark.parametrize("kind", ["bigint", "int", "decimal(9,0)", "decimal(20,6)"])
def test_ties_in_every_exact_type(spark, kind):
    flags = flags_of(sg.suspicious_flags(period_rows(spark, TIES, kind)))
    assert set(flags.values()) == {False}


@pytest.mark.parametrize("join", BOTH_JOINS)
class TestRules:
    def test_single_member_is_undecided(self, spark, join):
        df = period_rows(spark, [("d", "t", "u", "60")])
        assert sg.team_day_stats(df).first()["MUNKAORA_SZORAS"] is None
        assert flags_of(sg.suspicious_flags(df, **join)) == {("d", "t", "u"): None}
        assert counts_of(sg.suspicious_days(df, **join)) == {("t", "u"): None}

    def test_one_undecided_day_hides_the_count(self, spark, join):
        rows = [("1", "t", "u", "60")]
        rows += [("2", "t", "u", "0")] + [("2", "t", f"v{i}", "480") for i in range(3)]
        df = period_rows(spark, rows)
        assert flags_of(sg.suspicious_flags(df, **join))["2", "t", "u"] is True
        counts = counts_of(sg.suspicious_days(df, **join))
        assert counts["t", "u"] is None
        assert counts["t", "v0"] == 0

    def test_missing_minutes_hide_the_team_day(self, spark, join):
        df = period_rows(
            spark,
            [("d", "t", "u1", "5"), ("d", "t", "u1", None), ("d", "t", "u2", "7"), ("d", "t", "u3", "9")],
        )
        rows = {r[USER]: r for r in sg.suspicious_flags(df, **join).collect()}
        assert rows["u1"]["MUNKAORA"] is None and rows["u2"]["MUNKAORA"] is not None
        assert {r["MUNKAORA_ATLAG"] for r in rows.values()} == {None}
        assert {r["MUNKAORA_SZORAS"] for r in rows.values()} == {None}
        assert set(counts_of(sg.suspicious_days(df, **join)).values()) == {None}

    def test_ties_are_not_suspicious(self, spark, join):
        assert set(flags_of(sg.suspicious_flags(period_rows(spark, TIES), **join)).values()) == {False}

    def test_clear_case(self, spark, join):
        df = period_rows(spark, [("d", "t", f"u{i}", m) for i, m in enumerate([0, 480, 480, 480])])
        flags = flags_of(sg.suspicious_flags(df, **join))
        assert [flags["d", "t", f"u{i}"] for i in range(4)] == [True, False, False, False]
        stats = sg.team_day_stats(df).first()
        assert (stats["MUNKAORA_ATLAG"], stats["MUNKAORA_SZORAS"]) == (6.0, 4.0)

    def test_null_team_is_a_team(self, spark, join):
        rows = [("d", None, "u", "60"), ("d", None, "v", "180")]
        rows += [("d", "t", "u", "1"), ("d", "t", "v", "2"), ("d", "", "u", "3")]
        got = {
            (r[TEAM], r[USER]): r["MUNKAORA_ATLAG"]
            for r in sg.user_day_with_stats(period_rows(spark, rows), **join).collect()
        }
        assert got[None, "u"] == got[None, "v"] == 2.0
        assert got["t", "u"] == pytest.approx(1.5 / 60)
        assert got["", "u"] == pytest.approx(3 / 60)

    @pytest.mark.parametrize("seed", [1, 2])
    def test_against_brute_force(self, spark, join, seed):
        rows = random_rows(seed)
        df = period_rows(spark, rows)
        flags = flags_of(sg.suspicious_flags(df, **join))
        assert flags == brute_flags(rows)
        assert {True, False} <= set(flags.values())
        assert counts_of(sg.suspicious_days(df, **join)) == brute_counts(rows)


def test_large_group_is_spread(spark):
    """Members of a large team-day get keys of their own for the shuffle, the others none."""
    members = spark.range(3000).select(
        F.when(F.col("id") < 1000, F.lit(None)).otherwise(F.col("id") % 400).alias("k"),
        F.concat(F.lit("u"), F.col("id").cast("string")).alias("u"),
    )
    large = spark.range(1).select(
        F.lit(None).cast("bigint").alias("k"), F.struct(F.lit(7).alias("x")).alias("_large")
    )
    served = serve_large(members, large, ["k"], "u", 50)
    by_key = served.groupBy(F.col("k").isNull().alias("hot"), "_spread").count().collect()
    hot = {r["_spread"]: r["count"] for r in by_key if r["hot"]}
    assert set(hot) == set(range(1, 51)) and sum(hot.values()) == 1000 and max(hot.values()) < 60
    assert {r["_spread"]: r["count"] for r in by_key if not r["hot"]} == {0: 2000}


def test_shuffled_statistics(spark, conf):
    """A third of all user-days in one team-day, and no broadcast that is not bounded."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = [("d", "hot", f"u{i}", str(i)) for i in range(400)]
    rows += [(f"{i}", "t", f"u{j}", str(j)) for i in range(200) for j in range(4)]
    flags = sg.suspicious_flags(period_rows(spark, rows), limit_bytes=0, large_share=50)
    assert flags_of(flags) == brute_flags(rows)
    plan = flags._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")]
    assert final.count("SortMergeJoin") == 1 and final.count("BroadcastHashJoin") == 1
    # The spread key takes part in the shuffle of both sides.
    shuffles = re.findall(r"Exchange hashpartitioning\(([^\n]*)", final)
    assert sum("_spread#" in keys for keys in shuffles) == 2


@pytest.mark.parametrize("factor", [1, 7, 1000])
def test_scaling_minutes_changes_no_flag(spark, factor):
    rows = [r for r in random_rows(4) if r[3] is not None]
    scaled = [(d, t, u, str(Decimal(m) * factor)) for d, t, u, m in rows]
    assert flags_of(sg.suspicious_flags(period_rows(spark, scaled))) == brute_flags(rows)


def test_two_members_are_never_suspicious(spark):
    rows = [(f"{i}", "t", u, str(m)) for i in range(50) for u, m in (("a", i), ("b", 9 * i))]
    assert set(flags_of(sg.suspicious_flags(period_rows(spark, rows))).values()) == {False}


def test_window_form_agrees(spark):
    """The statistics joined back equal a window over the team-day."""
    df = period_rows(spark, random_rows(5))
    w = Window.partitionBy(DAY, TEAM)
    h = F.col("MUNKAORA")
    complete = F.count(h).over(w) == F.count(F.lit(1)).over(w)
    windowed = sg.user_day_hours(df).select(
        DAY, TEAM, USER, h,
        F.when(complete, F.avg(h).over(w)).alias("MUNKAORA_ATLAG"),
        F.when(complete, F.stddev_samp(h).over(w)).alias("MUNKAORA_SZORAS"),
    )

    def rounded(frame):
        values = [F.round(c, 9).alias(c) for c in frame.columns[3:]]
        return sorted(map(str, frame.select(DAY, TEAM, USER, *values).collect()))

    joined = sg.user_day_with_stats(df)
    assert rounded(joined) == rounded(windowed)
    assert joined.count() == sg.user_day_hours(df).count()


def test_order_and_partitioning_do_not_matter(spark):
    rows = random_rows(6)
    expected = brute_flags(rows)
    for parts in (1, 7):
        shuffled = period_rows(spark, random.Random(parts).sample(rows, len(rows)))
        assert flags_of(sg.suspicious_flags(shuffled.repartition(parts))) == expected


def test_floating_point_minutes(spark):
    rows = [("d", "t", f"u{i}", m) for i, m in enumerate([0, 480, 480, 480])]
    rows += [("e", "t", "u0", "nan"), ("e", "t", "u1", 4)]
    df = period_rows(spark, rows, "double")
    flags = flags_of(sg.suspicious_flags(df))
    assert flags["d", "t", "u0"] is True and flags["d", "t", "u1"] is False
    assert flags["e", "t", "u0"] is None and flags["e", "t", "u1"] is None
    assert counts_of(sg.suspicious_days(df)) == {
        ("t", "u0"): None, ("t", "u1"): None, ("t", "u2"): 0, ("t", "u3"): 0
    }


def test_large_numbers_stay_exact(spark):
    """Differences of one unit in 10**14 still count."""
    big = 10**12
    rows = [("d", "t", f"u{i}", str(m)) for i, m in enumerate([big, 2 * big, 3 * big, 3 * big + 1])]
    assert flags_of(sg.suspicious_flags(period_rows(spark, rows))) == brute_flags(rows)


def test_user_in_two_teams_gives_two_rows(spark):
    rows = [("d", t, u, m) for t in "ab" for u, m in (("x", "1"), ("y", "2"))]
    assert set(counts_of(sg.suspicious_days(period_rows(spark, rows)))) == {
        ("a", "x"), ("a", "y"), ("b", "x"), ("b", "y")
    }


def test_no_rows(spark):
    df = period_rows(spark, [])
    assert sg.suspicious_days(df).collect() == []
    assert sg.team_day_stats(df).collect() == []


@pytest.mark.parametrize("kind", ["decimal(38,18)", "decimal(30,10)", "decimal(38,2)"])
def test_wide_types_hold_what_occurs(spark, kind):
    rows = random_rows(7) + [("d", "t", f"u{i}", m) for i, m in enumerate("1234")]
    df = period_rows(spark, rows, kind)
    assert flags_of(sg.suspicious_flags(df)) == brute_flags(rows)
    plain = period_rows(spark, rows)

    def stats(frame):
        return sorted(map(str, sg.team_day_stats(frame).collect()))

    assert stats(df) == stats(plain)


def test_long_fractions(spark):
    """Ten decimals occur: the threshold is exact, mean and deviation floating-point."""
    tiny = Decimal("1e-10")
    rows = [("d", "t", f"u{i}", 480 + m * tiny) for i, m in enumerate([1, 2, 3])]
    rows += [("e", "t", f"u{i}", 480 + m * tiny) for i, m in enumerate([1, 3, 3, 3])]
    df = period_rows(spark, rows, "decimal(38,18)")
    flags = flags_of(sg.suspicious_flags(df))
    assert flags == brute_flags(rows)
    assert flags["d", "t", "u0"] is False and flags["e", "t", "u0"] is True
    assert sg.team_day_stats(df).first()["MUNKAORA_ATLAG"] == pytest.approx(8)


@pytest.mark.parametrize("minutes", [[1, 2, 2, 3], [0, 3, 3, 3], [0, 240, 240, 240], [0, 7, 200, 249]])
def test_up_to_the_promised_range(spark, minutes):
    """n*n*t*t from 1.4e34 to just below 10**38."""
    rows = [("d", "t", f"u{i}", m * 10**16) for i, m in enumerate(minutes)]
    rows = rows + [("e", t, u, m + 1) for _, t, u, m in rows]
    df = period_rows(spark, rows, "decimal(20,0)")
    assert flags_of(sg.suspicious_flags(df)) == brute_flags(rows)


def test_statistics_beyond_the_range_of_the_threshold(spark):
    rows = [("d", "t", "u", "1"), ("d", "t", "v", "9" * 28), ("e", "t", "u", "60"), ("e", "t", "v", None)]
    df = period_rows(spark, rows, "decimal(28,0)")
    for frame in (sg.team_day_stats(df), sg.user_day_with_stats(df)):
        got = {r[DAY]: (r["MUNKAORA_ATLAG"], r["MUNKAORA_SZORAS"]) for r in frame.collect()}
        assert got["d"] == (pytest.approx(1e28 / 120), pytest.approx(1e28 / 60 / 2**0.5))
        assert got["e"] == (None, None)


def test_products_beyond_38_digits_are_exact(spark):
    rows = [("d", "t", "u", "1"), ("d", "t", "v", "9" * 28), ("d", "t", "w", "9" * 28)]
    rows += [("e", "t", u, "9" * 28) for u in "uvw"] + [("d", "t", "x", "9" * 28)]
    frame = period_rows(spark, rows, "decimal(28,0)")
    assert counts_of(sg.suspicious_days(frame)) == brute_counts(rows)

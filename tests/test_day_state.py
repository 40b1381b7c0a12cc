"""State kept by day, and daily results as partitions."""

from __future__ import annotations

import datetime
import random
import re
from pathlib import Path

import pytest
from helpers import brute_counts, brute_flags, counts_of, period_rows
from pyspark.sql import functions as F

import shiftgauge as sg
from shiftgauge.plans import day_state, item_store
from shiftgauge.schemas import DAY, MINUTES, TEAM, USER
from shiftgauge.sources.partitions import replace_partitions


def some_rows(seed, days=6):
    rng = random.Random(seed)
    for day in range(1, days + 1):
        for user in range(rng.randint(1, 7)):
            for _ in range(rng.randint(1, 3)):
                minutes = None if rng.random() < 0.02 else f"{rng.randint(0, 900)}.25"
                yield f"2024-01-0{day}", rng.choice(["a", "b", None]), str(user), minutes


def flags_at(spark, root, **period):
    kept = day_state.read_flags(spark, root, **period).collect()
    return {(str(r[DAY]), r[TEAM], r[USER]): r["GYANUS_NAP"] for r in kept}


def test_day_by_day_equals_all_at_once(spark, tmp_path):
    rows, root = list(some_rows(1)), str(tmp_path / "state")
    by_day = {}
    for row in rows:
        by_day.setdefault(row[0], []).append(row)
    for own in by_day.values():
        sg.update_days(dated(spark, own), root)
        assert {k for k in flags_at(spark, root)} >= {(d, t, u) for d, t, u, _ in own}
    assert flags_at(spark, root) == brute_flags(rows)
    assert counts_of(sg.count_days(spark, root)) == brute_counts(rows)
    # A day delivered again, once as it was and once with other rows.
    day = "2024-01-03"
    sg.update_days(dated(spark, by_day[day]), root)
    assert counts_of(sg.count_days(spark, root)) == brute_counts(rows)
    new = [r for r in some_rows(2) if r[0] == day]
    sg.update_days(dated(spark, new), root)
    changed = [r for r in rows if r[0] != day] + new
    assert counts_of(sg.count_days(spark, root)) == brute_counts(changed)
    # A day that turns out to have no rows.
    sg.update_days(dated(spark, []), root, days=[datetime.date(2024, 1, 3)])
    left = [r for r in rows if r[0] != day]
    assert counts_of(sg.count_days(spark, root)) == brute_counts(left)
    part = [r for r in left if "2024-01-02" <= r[0] <= "2024-01-04"]
    period = {"first": "2024-01-02", "last": "2024-01-04"}
    assert counts_of(sg.count_days(spark, root, **period)) == brute_counts(part)


def dated(spark, rows, minutes="decimal(18,2)"):
    return period_rows(spark, rows, minutes).withColumn(DAY, F.col(DAY).cast("date"))


def test_late_rows_are_merged(spark, tmp_path):
    rows, root = list(some_rows(5)), str(tmp_path / "state")
    rng = random.Random(1)
    rng.shuffle(rows)
    for at in range(0, len(rows), 15):
        sg.update_days(dated(spark, rows[at : at + 15]), root, add=True)
    assert flags_at(spark, root) == brute_flags(rows)
    assert counts_of(sg.count_days(spark, root)) == brute_counts(rows)
    with pytest.raises(ValueError, match="floating"):
        sg.update_days(dated(spark, [], "double"), root, add=True)


def test_floating_days_are_replaced(spark, tmp_path):
    root = str(tmp_path / "state")
    rows = [("2024-01-01", "a", u, m) for u, m in (("x", 0.1), ("y", 0.1), ("z", 0.1))]
    sg.update_days(dated(spark, rows, "double"), root)
    assert set(flags_at(spark, root).values()) == {False}


def test_one_day_reads_one_partition(spark, tmp_path):
    root = str(tmp_path / "state")
    sg.update_days(dated(spark, list(some_rows(3))), root)
    before = {p: p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet")}
    schema = dated(spark, []).groupBy(DAY, TEAM, USER).count().schema
    schema = schema.add(MINUTES, "decimal(38,2)").add("rows", "long").add("missing", "long")
    day = datetime.date(2024, 1, 2)
    plan = day_state.read_partials(spark, root, schema, [day])._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^]]*NAP#\d+ = 2024-01-02", plan)
    period = day_state.read_flags(spark, root, day, day)
    assert {r[0].split("NAP=")[1][:10] for r in period.selectExpr("_metadata.file_path").collect()} == {"2024-01-02"}
    sg.update_days(dated(spark, [("2024-01-02", "a", "late", "5")]), root, add=True)
    after = {p: p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet")}
    assert {p: t for p, t in before.items() if "2024-01-02" not in str(p)} == {
        p: t for p, t in after.items() if "2024-01-02" not in str(p)
    }
    assert not {p for p in before if "2024-01-02" in str(p)} & set(after)


def test_a_large_day_gets_several_files(spark, tmp_path, conf):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    # A large day comes from several tasks.
    conf("spark.sql.files.maxPartitionBytes", "64k")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(60_000).selectExpr(
        f"date'2024-01-01' AS {DAY}", f"'t' AS {TEAM}", f"cast(xxhash64(id) AS string) AS {USER}", f"id AS {MINUTES}"
    )
    sg.update_days(rows, str(tmp_path / "state"))
    assert len(list((tmp_path / "state/partials").rglob("*.parquet"))) > 2


def detail(spark, rows):
    schema = "user_azon string, torzsszam string, szlaforg_fej_azon bigint, datum timestamp_ntz"
    return spark.createDataFrame(rows, schema)


def test_daily_items(spark, tmp_path):
    path, at = str(tmp_path / "items"), datetime.datetime(2024, 1, 15, 9)
    one, two, three = [("u", None, 1, at)], [("v", "7", 2, at), ("w", "8", 3, at)], [("x", "9", 4, at)]
    item_store.write_items(detail(spark, one), path, "2024-01-16")
    item_store.write_items(detail(spark, two), path, datetime.date(2024, 1, 17))
    item_store.write_items(detail(spark, three), path, "2024-01-16", offset_days=3)

    def kept(**where):
        return sorted((str(r.as_of), r.offset_days, r.user_azon) for r in item_store.read_items(spark, path, **where).collect())

    all_three = [("2024-01-16", 1, "u"), ("2024-01-16", 3, "x"), ("2024-01-17", 1, "v"), ("2024-01-17", 1, "w")]
    assert kept() == all_three
    item_store.write_items(detail(spark, three), path, "2024-01-17")
    assert kept(as_of="2024-01-17") == [("2024-01-17", 1, "x")]
    assert kept(as_of="2024-01-16") == all_three[:2]
    item_store.write_items(detail(spark, []), path, "2024-01-16")  # a rerun that finds nothing
    assert kept() == [("2024-01-16", 3, "x"), ("2024-01-17", 1, "x")]
    plan = item_store.read_items(spark, path, "2024-01-16", 3)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(as_of" in plan


def test_a_failed_run_leaves_the_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_partitions(spark.sql("SELECT 1 AS x, 'a' AS p"), path, ["p"])
    with pytest.raises(Exception, match="broken"):
        replace_partitions(spark.sql("SELECT cast(raise_error('broken') AS int) AS x, 'a' AS p"), path, ["p"])
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(1, "a")]
    with pytest.raises(ValueError, match="named"):
        replace_partitions(spark.sql("SELECT 1 AS x, 'a' AS p"), path, ["p"], [("../x",)])

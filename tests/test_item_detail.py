from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import shiftgauge as sg
from shiftgauge.functions.days import on_day
from shiftgauge.plans.item_detail import join_items, select_actions
from shiftgauge.schemas import ITEMS, LOG, USERS

AS_OF = dt.date(2018, 3, 1)
NOON = dt.datetime(2018, 2, 28, 12)


def action(user="ann", key=(1, 1, 1), at=NOON, status="67"):
    return (user, *key, at, status)


def item(key=(1, 1, 1), account=10**30 + 1, direction="J"):
    from decimal import Decimal

    return (*key, Decimal(account), direction)


def run(spark, log, items, users=(("ann", "T1"),), allow=("ann", "bob"), **kwargs):
    kwargs.setdefault("as_of", AS_OF)
    df = sg.processed_items(
        spark.createDataFrame(log, LOG),
        spark.createDataFrame(items, ITEMS),
        spark.createDataFrame(list(users), USERS),
        allow,
        **kwargs,
    )
    return df


JOINS = [{}, {"limit_bytes": -1}]


@pytest.mark.parametrize("join", JOINS)
class TestRules:
    def test_row(self, spark, join):
        df = run(spark, [action()], [item()], **join)
        assert df.columns == [
            "user_azon", "torzsszam", "szlaforg_fej_azon", "forgtet_azon", "azon_forgtet_azon",
            "ceg_szlaszam", "datum",
        ]
        assert [tuple(r) for r in df.collect()] == [("ann", "T1", 1, 1, 1, str(10**30 + 1), NOON)]

    def test_day_edges(self, spark, join):
        first = dt.datetime(2018, 2, 28)
        last = dt.datetime(2018, 2, 28, 23, 59, 59, 999999)
        log = [action(at=first), action(at=last), action(at=dt.datetime(2018, 3, 1))]
        log += [action(at=dt.datetime(2018, 2, 27, 23, 59, 59, 999999)), action(at=None)]
        assert {r["datum"] for r in run(spark, log, [item()], **join).collect()} == {first, last}

    def test_three_days_before_is_one_day(self, spark, join):
        days = [dt.datetime(2018, 2, d, 8) for d in (25, 26, 27, 28)]
        got = run(spark, [action(at=d) for d in days], [item()], offset_days=3, **join)
        assert [r["datum"] for r in got.collect()] == [days[1]]

    def test_fan_out_is_kept(self, spark, join):
        log = [action(), action()]
        items = [item(account=1), item(account=2), item(account=2)]
        got = run(spark, log, items, **join)
        assert sorted(r["ceg_szlaszam"] for r in got.collect()) == ["1", "1", "2", "2", "2", "2"]

    def test_users(self, spark, join):
        log = [action("ann"), action("bob"), action("eve"), action(None)]
        users = [("ann", "T1"), ("ann", "T2"), ("eve", "T3"), (None, "T4")]
        got = run(spark, log, [item()], users, **join)
        assert sorted((r["user_azon"], r["torzsszam"] or "") for r in got.collect()) == [
            ("ann", "T1"), ("ann", "T2"), ("bob", "")
        ]

    def test_dropped_rows(self, spark, join):
        log = [
            action(status=None), action(status="66"), action(status="067"),
            action(key=(1, 1, None)), action(key=(1, 2, 1)), action(key=(2, 2, 2)),
            action(key=(3, 3, 3)), action(user="ANN"),
        ]
        items = [item(), item((1, 1, None)), item((2, 2, 2), direction="T"),
                 item((3, 3, 3), direction=None)]
        assert run(spark, log, items, **join).collect() == []

    def test_allow_table(self, spark, join):
        allow = spark.createDataFrame([("ann",), ("ann",), (None,)], "who string")
        got = run(spark, [action("ann"), action("bob"), action(None)], [item()], allow=allow, **join)
        assert [r["user_azon"] for r in got.collect()] == ["ann"]

    def test_codes_are_parameters(self, spark, join):
        got = run(spark, [action(status="1")], [item(direction="T")], status="1", direction="T", **join)
        assert got.count() == 1


def test_default_day_is_yesterday(spark):
    day = spark.range(1).select(F.date_sub(F.current_date(), 1).alias("d")).first()["d"]
    log = [action(at=dt.datetime.combine(day, dt.time(5)))]
    assert run(spark, log, [item()], as_of=None).count() == 1


def test_allow_list_may_be_a_generator(spark):
    assert run(spark, [action()], [item()], allow=(u for u in ["ann"])).first()["torzsszam"] == "T1"


def test_empty_selection(spark):
    assert run(spark, [], [item()]).collect() == []


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_day_and_status_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.createDataFrame([action()], LOG).write.parquet(path)
    plan = final_plan(select_actions(spark.read.parquet(path), ["ann"], AS_OF))
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(azon_forgtet_mod_idopont,2018-02-28T00:00)" in pushed
    assert "LessThan(azon_forgtet_mod_idopont,2018-03-01T00:00)" in pushed
    assert "EqualTo(allapot_azon_feldolg,67)" in pushed
    assert "user_azon" in pushed


def test_truncation_would_not_reach_the_scan(spark, tmp_path):
    """Why the day predicate is written with to_date."""
    path = str(tmp_path / "log")
    spark.createDataFrame([action()], LOG).write.parquet(path)
    df = spark.read.parquet(path)
    at = F.col("azon_forgtet_mod_idopont")
    assert "GreaterThanOrEqual" in final_plan(df.where(on_day(at, AS_OF)))
    day = F.lit(dt.date(2018, 2, 28)).cast("timestamp_ntz")
    truncated = df.where(F.date_trunc("day", at).cast("timestamp_ntz") == day)
    assert truncated.count() == 1 and "GreaterThanOrEqual" not in final_plan(truncated)


@pytest.mark.parametrize("kind", ["string", "int"])
@pytest.mark.parametrize("options", [{}, {"blank_is_null": True}, {"padded": ["allapot_azon_feldolg"]}])
def test_cleaned_columns_reach_the_scan(spark, tmp_path, options, kind):
    path = str(tmp_path / "log")
    pad = "  " if "padded" in options and kind == "string" else ""
    statuses = ["67", "6", "678", None] + ([""] if kind == "string" else [])
    rows = [action(status=s and s + pad) for s in statuses]
    df = spark.createDataFrame(rows, LOG)
    status = F.col("allapot_azon_feldolg").cast(kind)
    df.withColumn("allapot_azon_feldolg", status).write.parquet(path)
    only = {"allapot_azon_feldolg": ["67"], "user_azon": ["ann", "bob"]}
    log = sg.read_relation(spark, path, LOG, only=only, **options)
    picked = select_actions(log, ["ann", "bob"], AS_OF)
    assert picked.count() == 1
    plan = final_plan(picked)
    pushed = plan[plan.index("PushedFilters"):].split("ReadSchema")[0]
    wanted = "StringStartsWith(allapot_azon_feldolg,67)" if pad else "EqualTo(allapot_azon_feldolg,67)"
    assert wanted in pushed and "In(user_azon, [ann,bob])" in pushed
    assert "LessThan(azon_forgtet_mod_idopont" in pushed


def test_selection_is_stored_in_few_files(spark, tmp_path):
    """64 files of the log with a selected row in each."""
    path = str(tmp_path / "log")
    log = spark.createDataFrame([action(key=(i, 1, 1)) for i in range(64)], LOG)
    log.repartition(64).write.parquet(path)
    got = run_frames(spark, spark.read.parquet(path), spark.createDataFrame([item()], ITEMS))
    assert got.count() == 1
    assert len(got.inputFiles()) <= 4


def run_frames(spark, log, items):
    users = spark.createDataFrame([("ann", "T1")], USERS)
    return sg.processed_items(log, items, users, ["ann"], AS_OF)


def test_key_range_reaches_the_items(spark, tmp_path):
    path = str(tmp_path / "items")
    spark.createDataFrame([item((k, 1, 1)) for k in range(20)], ITEMS).write.parquet(path)
    log = spark.createDataFrame([action(key=(k, 1, 1)) for k in (None, 5, 7, 30)], LOG)
    got = run_frames(spark, log, spark.read.parquet(path))
    assert {r["szlaforg_fej_azon"] for r in got.collect()} == {5, 7}
    plan = final_plan(got)
    assert "GreaterThanOrEqual(szlaforg_fej_azon,5)" in plan
    assert "LessThanOrEqual(szlaforg_fej_azon,30)" in plan


def test_keys_of_other_types_are_joined_without_a_range(spark):
    log = spark.createDataFrame([action(key=(k, 1, 1)) for k in (9, 10)], LOG)
    text = log.withColumn("szlaforg_fej_azon", F.col("szlaforg_fej_azon").cast("string"))
    items = spark.createDataFrame([item((k, 1, 1)) for k in (9, 10)], ITEMS)
    assert run_frames(spark, text, items).count() == 2


def test_unmeasured_join_runs_nothing_while_built(spark):
    context = spark.sparkContext
    context.setJobGroup("building", "")
    try:
        joined = join_items(spark.range(9), spark.range(5), ["id"])
        assert list(context.statusTracker().getJobIdsForGroup("building")) == []
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert joined.count() == 5


def test_day_partition_is_pruned(spark, tmp_path):
    path = str(tmp_path / "log")
    log = spark.createDataFrame(
        [action(at=dt.datetime(2018, 2, d, 8)) for d in (26, 27, 28)], LOG
    )
    log.withColumn("nap", F.to_date("azon_forgtet_mod_idopont")).write.partitionBy("nap").parquet(path)
    picked = select_actions(spark.read.parquet(path), ["ann"], AS_OF, day_partition="nap")
    assert picked.count() == 1
    plan = final_plan(picked)
    assert "PartitionFilters: [isnotnull(nap" in plan and "2018-02-28" in plan


def test_small_actions_leave_the_items_unshuffled(spark, tmp_path):
    path = str(tmp_path / "items")
    spark.createDataFrame([item()], ITEMS).write.parquet(path)
    log = spark.createDataFrame([action()], LOG)
    users = spark.createDataFrame([("ann", "T1")], USERS)
    plan = final_plan(sg.processed_items(log, spark.read.parquet(path), users, ["ann"], AS_OF))
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan
    assert "EqualTo(forgtet_irany,J)" in plan


def test_hot_key_is_split_in_the_shuffle_join(spark, conf):
    """Beyond the broadcast limit a key with a third of both sides is split by size."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "8KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8KB")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "16")

    def side(n, name):
        hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") + 100)
        return spark.range(0, n, 1, 8).select(
            hot.alias("k1"), (hot + 1).alias("k2"), F.sha2(F.col("id").cast("string"), 256).alias(name)
        )

    joined = join_items(side(6000, "x"), side(900, "y"), ["k1", "k2"], limit_bytes=-1)
    counted = joined.groupBy("k1").agg(F.count("*").alias("count"), F.max("x"), F.max("y"))
    rows = {r["k1"]: r["count"] for r in counted.collect()}
    assert rows[7] == 2000 * 300
    assert sum(rows.values()) == 2000 * 300 + 600
    assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()

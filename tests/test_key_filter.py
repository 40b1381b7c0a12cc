"""The Bloom filter of join keys: nothing lost, little too much, below the shuffle."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import shiftgauge as sg
from shiftgauge.operators import key_filter
from shiftgauge.schemas import ITEM_KEY


def keyed(spark, n, seed):
    """Random keys all over the range, so that a range of keys prunes nothing."""
    keys = [F.xxhash64("id", F.lit(seed + i)).alias(k) for i, k in enumerate(ITEM_KEY)]
    return spark.range(n).select(*keys, F.col("id").alias("x"))


@pytest.mark.parametrize("count", [0, 1, 3000, 20_000])
def test_filter_loses_nothing(spark, count):
    chosen, others = keyed(spark, count, 0), keyed(spark, 50_000, 100)
    blocks = key_filter.blocks_for(count)
    assert blocks == max(1, -(-count // 2048))
    filters = key_filter.key_blocks(chosen, ITEM_KEY, blocks)
    assert filters.count() <= blocks
    found = key_filter.with_possible_keys(chosen.union(others), ITEM_KEY, filters, blocks)
    assert found.columns == chosen.columns
    assert found.intersect(chosen).count() == count
    assert found.count() - count <= 50_000 * 0.005


def test_nulls_and_types(spark):
    rows = spark.createDataFrame([(1, "a", None), (2, "b", 5)], "k bigint, s string, x int")
    filters = key_filter.key_blocks(rows, ["k", "s"], 1)
    assert key_filter.with_possible_keys(rows, ["k", "s"], filters, 1).count() == 2
    other = rows.withColumn("k", F.col("k").cast("int"))
    assert key_filter.can_filter(rows, rows, ["k", "s"]) and not key_filter.can_filter(rows, other, ["k", "s"])
    doubles = rows.withColumn("k", F.col("k").cast("double"))
    assert not key_filter.can_filter(doubles, doubles, ["k"])
    assert key_filter.blocks_for(10**9) is None and key_filter.blocks_for(10**6) == 489


def test_items_are_filtered_before_the_shuffle(spark, conf, tmp_path):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    items = keyed(spark, 30_000, 0).select(
        *ITEM_KEY, F.col("x").cast("decimal(38,0)").alias("ceg_szlaszam"), F.lit("J").alias("forgtet_irany")
    )
    items.write.parquet(str(tmp_path / "items"))
    items = spark.read.parquet(str(tmp_path / "items"))
    log = keyed(spark, 30_000, 0).where("x % 30 = 0").select(
        F.concat(F.lit("u"), F.col("x") % 3).alias("user_azon"),
        *ITEM_KEY,
        F.lit("2024-01-15 10:00:00").cast("timestamp_ntz").alias("azon_forgtet_mod_idopont"),
        F.lit("67").alias("allapot_azon_feldolg"),
    )
    users = spark.createDataFrame([("u1", "7")], "user_azon string, torzsszam string")
    options = {"as_of": "2024-01-16", "limit_bytes": 0}
    made = {}
    for name, filter_bytes in (("filtered", key_filter.FILTER_BYTES), ("plain", 0)):
        detail = sg.processed_items(log, items, users, ["u0", "u1", "u2"], filter_bytes=filter_bytes, **options)
        made[name] = sorted(map(str, detail.collect()))
        plan = detail._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert ("_words" in plan and "BroadcastHashJoin" in plan) == (name == "filtered")
        rows = exchanged(detail)
        # The exchanges hold items, actions, users and joined rows.
        assert max(rows) <= 1000 + 30_000 * 0.005 if name == "filtered" else max(rows) > 29_000
    assert made["filtered"] == made["plain"] and len(made["plain"]) == 1000


def exchanged(df):
    """Rows written by each shuffle of an executed plan."""
    rows, stack = [], [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            stack.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            stack.append(node.plan())
        elif kind == "ShuffleExchangeExec":
            rows.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return rows

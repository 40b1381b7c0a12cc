from __future__ import annotations

from pathlib import Path
from types import SimpleNamespace

import pytest
from helpers import period_rows
from pyspark.sql import functions as F

import shiftgauge as sg
from shiftgauge.checkpoints import checkpoint_folder, cut, scratch, scratch_path, store
from shiftgauge.operators.sizing import payload, payload_bytes


class Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(master, **options):
    conf = SimpleNamespace(get=lambda name, default: options.get(name.replace(".", "_"), default))
    return SimpleNamespace(sparkContext=Context(master), conf=conf)


def test_named_folder_wins():
    spark = session("local[2]", spark_checkpoint_dir="hdfs:///shared")
    assert checkpoint_folder(spark) == "hdfs:///shared"


def test_cluster_needs_a_named_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_folder(session("spark://host:7077"))
    assert checkpoint_folder(session("local[2]"))


@pytest.mark.parametrize("keep", [cut, store])
@pytest.mark.parametrize("size", [0, 1000])
def test_measures_are_taken_on_the_way(spark, keep, size):
    df = spark.range(size).select("id", F.col("id").cast("string").alias("text"))
    kept, measured = keep(df, bytes=payload(df), rows=F.count(F.lit(1)))
    assert measured == {"bytes": payload_bytes(df), "rows": size}
    assert sorted(kept.collect()) == sorted(df.collect())


def stored(spark):
    return set(Path(checkpoint_folder(spark).removeprefix("file:")).iterdir())


def test_nothing_is_left_after_the_scope(spark):
    df = period_rows(spark, [("d", "t", u, m) for u, m in (("a", 1), ("b", 2), ("c", 9))], "bigint")
    outside = scratch_path(spark)
    spark.range(3).write.parquet(outside)
    before = stored(spark)
    with scratch(spark):
        days = sg.suspicious_days(df)
        assert days.count() == 3
        with scratch(spark):
            inner, _ = store(spark.range(2))
        assert stored(spark) > before
    assert stored(spark) == before
    with pytest.raises(ZeroDivisionError), scratch(spark):
        store(spark.range(2))
        raise ZeroDivisionError
    assert stored(spark) == before
    assert spark.read.parquet(outside).count() == 3

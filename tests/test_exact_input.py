"""Inputs that would be rounded or garbled raise; central European files are read."""

from __future__ import annotations

from decimal import Decimal

import pytest
from helpers import period_rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

import shiftgauge as sg
from shiftgauge.schemas import DAY, MINUTES, TEAM, USER

HEADER = f"{DAY},{TEAM},{USER},{MINUTES}\n"


def test_period_table_refuses_rounding(spark, tmp_path):
    for name, minutes in (("good", "1.5000"), ("bad", "1.0050")):
        rows = [("2024-01-01", "a", "u", Decimal(minutes), "p")]
        schema = f"{DAY} string, {TEAM} string, {USER} string, {MINUTES} decimal(18,4), period string"
        df = spark.createDataFrame(rows, schema).withColumn(DAY, F.to_date(DAY))
        df.write.partitionBy("period").parquet(str(tmp_path / name))
    good = sg.read_period_table(spark, str(tmp_path / "good"), "p").first()
    assert good[MINUTES] == Decimal("1.50")
    with pytest.raises(Exception, match="does not fit"):
        sg.read_period_table(spark, str(tmp_path / "bad"), "p").collect()


def test_relation_refuses_rounded_ids(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType())])
    for value, fits in ((1.0, True), (1.7, False)):
        path = str(tmp_path / str(value))
        spark.createDataFrame([(value,)], "id double").write.parquet(path)
        df = sg.read_relation(spark, path, schema)
        if fits:
            assert df.first().id == 1
        else:
            with pytest.raises(Exception, match="does not fit"):
                df.collect()


LETTERS = "\u00e1\u00e9\u00ed\u00f3\u00f6\u0151\u00fa\u00fc\u0171\u00c1\u00c9\u00cd\u00d3\u00d6\u0150\u00da\u00dc\u0170"


def test_central_european_files(spark, tmp_path):
    lines = HEADER + "".join(f"2024-01-01,team {c},u,1\n" for c in LETTERS)
    (tmp_path / "t_analitika_x.csv").write_bytes(lines.encode("cp1250"))
    rows = sg.read_period(spark, str(tmp_path), "x", encoding="windows-1250").collect()
    assert {r[TEAM] for r in rows} == {f"team {c}" for c in LETTERS}
    with pytest.raises(Exception, match="not UTF-8"):
        sg.read_period(spark, str(tmp_path), "x").collect()


def test_threshold_refuses_sessions_that_hide_overflow(spark, conf):
    conf("spark.sql.ansi.enabled", "false")
    rows = period_rows(spark, [("d", "t", "u", 1), ("d", "t", "v", 2)], "bigint")
    with pytest.raises(RuntimeError, match="ansi"):
        sg.suspicious_days(rows)

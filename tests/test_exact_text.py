"""Text that must not change on its way in, the writer of period rows, and the order of names."""

from __future__ import annotations

import random
from decimal import Decimal
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import shiftgauge as sg
from shiftgauge.functions.casts import exact_cast
from shiftgauge.plans.report import report_rows
from shiftgauge.schemas import DAY, ITEMS, MINUTES, PERIOD_ROWS, TEAM, USER
from shiftgauge.sources.periods import one_byte_table

GOOD = [
    ("decimal(18,2)", ["1.50", " 2 ", "-3.100", "+4", ".5", "", None], ["1.50", "2.00", "-3.10", "4.00", "0.50", None, None]),
    ("decimal(38,0)", ["9" * 38, "12.0", "-1"], [int("9" * 38), 12, -1]),
    ("decimal(38,18)", ["0.000000000000000001", "99999999999999999999.5"], ["0.000000000000000001", "99999999999999999999.5"]),
    ("bigint", ["9223372036854775807", "12", ""], [9223372036854775807, 12, None]),
]
BAD = [
    ("decimal(18,2)", ["1.0050", "x", "1e17", "NA", "1.005000000000000000001"]),
    ("decimal(38,0)", ["12.5", "1" * 39, "0.0000000000000000000001"]),
    ("bigint", ["12.5", "9223372036854775808"]),
    ("date", ["2024-01-15 10:30:00", "yesterday"]),
]


@pytest.mark.parametrize(("kind", "texts", "values"), GOOD)
def test_text_that_says_the_same(spark, kind, texts, values):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    field = T.StructField("x", T.StructType.fromDDL(f"x {kind}")[0].dataType)
    got = [r.x for r in df.select(exact_cast(df, field)).collect()]
    assert got == [None if v is None else Decimal(v) if kind.startswith("dec") else v for v in values]


@pytest.mark.parametrize(("kind", "text"), [(k, t) for k, texts in BAD for t in texts])
def test_text_that_would_change(spark, kind, text):
    df = spark.createDataFrame([(text,)], "x string")
    field = T.StructField("x", T.StructType.fromDDL(f"x {kind}")[0].dataType)
    with pytest.raises(Exception, match="x does not fit"):
        df.select(exact_cast(df, field)).collect()


def test_readers_refuse_changed_values(spark, tmp_path):
    rows = "'a' AS F_KISCSOPORT, 'u' AS F_NEV, '2018H1' AS period"
    for i, (day, minutes) in enumerate([("date'2018-01-02'", "'1.0050'"), ("timestamp_ntz'2018-01-02 08:00:00'", "1")]):
        path = str(tmp_path / str(i))
        spark.sql(f"SELECT {day} AS NAP, {minutes} AS CKLIDO, {rows}").write.partitionBy("period").parquet(path)
        with pytest.raises(Exception, match="does not fit"):
            sg.read_period_table(spark, path, "2018H1").collect()
    (tmp_path / "items.csv").write_text(",".join(ITEMS.names) + "\n1,2,3,12.5,J\n")
    with pytest.raises(Exception, match="ceg_szlaszam does not fit"):
        sg.read_relation(spark, str(tmp_path / "items.csv"), ITEMS, fmt="csv", header="true").collect()
    midnight = spark.sql(f"SELECT timestamp_ntz'2018-01-02 00:00:00' AS NAP, '7.5' AS CKLIDO, {rows}")
    midnight.write.partitionBy("period").parquet(str(tmp_path / "good"))
    got = sg.read_period_table(spark, str(tmp_path / "good"), "2018H1")
    assert got.schema == PERIOD_ROWS and got.first()[MINUTES] == Decimal("7.50")


@pytest.mark.parametrize("encoding", ["ISO-8859-2", "windows-1252", "windows-1250", "cp852", "koi8-r", "ISO-8859-1"])
def test_one_byte_charsets(spark, tmp_path, encoding):
    table = one_byte_table(encoding)
    letters = [c for c in table.values() if c is not None and c.isalpha()]
    lines = [f"2018-07-02,{c}x,{c},1" for c in letters]
    text = "\n".join(["NAP,F_KISCSOPORT,F_NEV,CKLIDO", *lines, ""])
    (tmp_path / "t_analitika_x.csv").write_bytes(text.encode(encoding))
    rows = sg.read_period(spark, str(tmp_path), "x", encoding=encoding).collect()
    assert sorted((r[TEAM], r[USER]) for r in rows) == sorted((f"{c}x", c) for c in letters)


@pytest.mark.parametrize(("encoding", "byte"), [("US-ASCII", 0xE9), ("windows-1252", 0x81), ("windows-1250", 0x83), ("cp1253", 0xFF)])
def test_bytes_that_stand_for_nothing(spark, tmp_path, encoding, byte):
    head = b"NAP,F_KISCSOPORT,F_NEV,CKLIDO\n2018-07-02,a"
    (tmp_path / "t_analitika_x.csv").write_bytes(head + b",u,1\n")
    assert sg.read_period(spark, str(tmp_path), "x", encoding=encoding).count() == 1
    (tmp_path / "t_analitika_x.csv").write_bytes(head + bytes([byte]) + b",u,1\n")
    with pytest.raises(Exception, match=f"is not {encoding}"):
        sg.read_period(spark, str(tmp_path), "x", encoding=encoding).collect()


def test_charsets_of_several_bytes_have_no_table():
    assert all(one_byte_table(e) is None for e in ("utf-8", "utf-16", "shift_jis", "gbk", "big5", "euc_kr", "cp037"))


def test_period_table_files(spark, tmp_path):
    """Three periods, one of them nine tenths of the rows and one team half of it."""
    rng = random.Random(2)
    kinds = [(p, t) for p, n in (("2018H1", 18), ("2018H2", 1), ("2019H1", 1)) for t in range(n)]
    rows = spark.createDataFrame(
        [(f"t{0 if rng.random() < 0.5 else t}", p, f"u{i % 50}", i) for i in range(40_000) for p, t in [rng.choice(kinds)]],
        f"{TEAM} string, period string, {USER} string, id bigint",
    ).select(
        F.expr("date_add(date'2018-01-01', cast(id % 90 AS int))").alias(DAY), TEAM, USER,
        F.col("id").cast("decimal(18,2)").alias(MINUTES), "period",
    )
    path = str(tmp_path / "rows")
    sg.write_period_table(rows.repartition(7), path, rows_per_file=3000, row_group_bytes=1024)
    files = {f: pq.ParquetFile(f) for f in Path(path).rglob("*.parquet")}
    sizes = {}
    for f, parquet in files.items():
        sizes.setdefault(f.parent.name, []).append(parquet.metadata.num_rows)
    assert all(n <= 3000 for own in sizes.values() for n in own)
    assert len(sizes["period=2018H1"]) >= 12 and len(sizes["period=2018H2"]) <= 3
    groups = [
        parquet.metadata.row_group(i).column(parquet.schema_arrow.get_field_index(TEAM)).statistics
        for f, parquet in files.items() if f.parent.name == "period=2018H1" for i in range(parquet.num_row_groups)
    ]
    needed = sum(s.min <= "t7" <= s.max for s in groups)
    assert needed <= max(3, len(groups) // 5)
    for period in ("2018H1", "2018H2"):
        expected = rows.where(F.col("period") == period).drop("period")
        assert sorted(sg.read_period_table(spark, path, period).collect()) == sorted(expected.collect())
    plan = sg.read_period_table(spark, path, "2018H1").where(F.col(TEAM) == "t7")
    assert f"EqualTo({TEAM},t7)" in plan._jdf.queryExecution().toString()
    few = rows.where("period = '2018H2'").limit(5)
    sg.write_period_table(few, path)
    assert sg.read_period_table(spark, path, "2018H2").count() == 5
    assert sg.read_period_table(spark, path, "2018H1").count() == sum(sizes["period=2018H1"])


def test_names_in_hungarian_order(spark):
    """Digraphs and long vowels have places of their own, unlike in binary order."""
    names = ["adam", "Ádám", "Adél", "Cecil", "Cz", "Csaba", "Dénes", "Dzsoni", "Éva", "Evelin", "Gábor", "Gyula",
             "Ónodi", "Őri", "Zoltán", "Zsolt", None]
    for partitions, collation, expected in [(1, "hu", names), (5, "hu", names), (3, None, sorted(names[:-1]) + [None])]:
        days = spark.createDataFrame([("t", n, 1) for n in reversed(names)], f"{TEAM} string, {USER} string, n int")
        rows = report_rows(days.repartition(partitions), collation).collect()
        assert [r[USER] for r in sorted(rows, key=lambda r: r.row_no)] == expected
        assert sorted(r.row_no for r in rows) == list(range(1, len(names) + 1))
        assert report_rows(days, collation).schema[USER].dataType == T.StringType()

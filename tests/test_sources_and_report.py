from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import shiftgauge as sg
from shiftgauge.functions.text import number_to_text
from shiftgauge.operators.numbering import number_rows
from shiftgauge.schemas import DAY, ITEMS, LOG, MINUTES, TEAM, USER, USERS, USERS_TABLE
from shiftgauge.sources.periods import period_path

from helpers import period_rows


def write_period(tmp_path, text, period="2018H2", encoding="utf-8"):
    (tmp_path / f"t_analitika_{period}.csv").write_bytes(text.encode(encoding))
    return str(tmp_path)


def test_missing_and_blank_values(spark, tmp_path):
    root = write_period(
        tmp_path,
        'extra,F_NEV,CKLIDO,"NAP",F_KISCSOPORT\n'
        "1,a,NA,2018-07-02,T\n"
        "2,b,,2018-07-02,\n"
        '3,c, 12.50 ,2018-07-02,""\n'
        "4,NA,7,NA,NA\n"
        '5,"say ""hi"", ok",1e2,2018-07-03,"T"\n'
        "6,,0,2018-07-03, T \n",
    )
    rows = [tuple(r) for r in sg.read_period(spark, root, "2018H2").collect()]
    d2, d3 = dt.date(2018, 7, 2), dt.date(2018, 7, 3)
    assert rows == [
        (d2, "T", "a", None),
        (d2, "", "b", None),
        (d2, "", "c", Decimal("12.50")),
        (None, None, None, Decimal("7.00")),
        (d3, "T", 'say "hi", ok', Decimal("100.00")),
        (d3, " T ", "", Decimal("0.00")),
    ]
    assert sg.read_period(spark, root, "2018H2").columns == [DAY, TEAM, USER, MINUTES]


def test_period_selects_the_file(spark, tmp_path):
    head = "NAP,F_KISCSOPORT,F_NEV,CKLIDO\n"
    write_period(tmp_path, head + "2018-01-02,T,a,1\n", "2018H1")
    root = write_period(tmp_path, head + "2018-07-02,T,a,2\n")
    assert sg.read_period(spark, root, "2018H1").first()[MINUTES] == 1
    assert sg.read_period(spark, root + "/", "2018H2").first()[MINUTES] == 2


@pytest.mark.parametrize(
    "line", ["2018-07-02,T,a,x", "2018-07-02,T,a,1;5", "2018-07-02,T,a,1.234", "2.7.2018,T,a,1",
             "2018,T,a,1", ",T,a,1"]
)
def test_bad_values_raise(spark, tmp_path, line):
    root = write_period(tmp_path, f"NAP,F_KISCSOPORT,F_NEV,CKLIDO\n{line}\n")
    with pytest.raises(Exception, match="is not a (decimal|date)"):
        sg.read_period(spark, root, "2018H2").collect()


@pytest.mark.parametrize("extra", ["", "extra,"])
@pytest.mark.parametrize("multiline", [False, True])
def test_short_and_long_rows(spark, tmp_path, extra, multiline):
    """Whether or not there are columns to leave out."""
    x = "1," if extra else ""
    head = f"{extra}NAP,F_KISCSOPORT,F_NEV,CKLIDO\n{x}2018-07-02,T,a,1\n"
    for period, line in (("short", f"{x}2018-07-02,T,b"), ("long", f"{x}2018-07-02,T,b,2,3")):
        root = write_period(tmp_path, f"{head}{line}\n", period)
        with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED"):
            sg.read_period(spark, root, period, multiline=multiline).collect()
        loose = sg.read_period(spark, root, period, multiline=multiline, strict=False)
        expected = {"short": None, "long": Decimal("2.00")}[period]
        assert [r[MINUTES] for r in loose.collect()] == [Decimal("1.00"), expected]


def test_line_breaks_in_quoted_text(spark, tmp_path):
    text = 'NAP,F_KISCSOPORT,F_NEV,CKLIDO\n2018-07-02,"T\nX",a,1\n'
    root = write_period(tmp_path, text)
    assert sg.read_period(spark, root, "2018H2", multiline=True).first()[TEAM] == "T\nX"
    with pytest.raises(Exception):
        sg.read_period(spark, root, "2018H2").collect()


def test_finer_minutes_and_other_days_on_request(spark, tmp_path):
    root = write_period(tmp_path, "NAP,F_KISCSOPORT,F_NEV,CKLIDO\n2.7.2018,T,a,1.234\n,T,a,1\n")
    df = sg.read_period(spark, root, "2018H2", day_type="string", minutes_type="decimal(18,4)")
    assert [tuple(r)[::3] for r in df.collect()] == [("2.7.2018", Decimal("1.2340")), ("", 1)]


def test_folder_of_files_with_one_header(spark, tmp_path):
    root = str(tmp_path)
    rows = period_rows(spark, [("2018-07-02", "T", f"u{i}", i) for i in range(50)])
    rows.repartition(5).write.csv(period_path(root, "2018H2"), header=True)
    got = sg.read_period(spark, root, "2018H2")
    assert sorted(int(r[MINUTES]) for r in got.collect()) == list(range(50))


def test_files_with_other_headers_are_refused(spark, tmp_path):
    folder = tmp_path / "t_analitika_2018H2.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("NAP,F_KISCSOPORT,F_NEV,CKLIDO\n2018-07-02,T,a,1\n")
    (folder / "b.csv").write_text("NAP,F_NEV,F_KISCSOPORT,CKLIDO\n2018-07-02,a,T,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        sg.read_period(spark, str(tmp_path), "2018H2").collect()


def test_encoding(spark, tmp_path):
    root = write_period(
        tmp_path, "NAP,F_KISCSOPORT,F_NEV,CKLIDO\n2018-07-02,Ügyfél,a,1\n", encoding="latin-1"
    )
    assert sg.read_period(spark, root, "2018H2", encoding="ISO-8859-1").first()[TEAM] == "Ügyfél"


def test_period_table_is_pruned(spark, tmp_path):
    path = str(tmp_path / "rows")
    rows = period_rows(spark, [("2018-07-02", "T", "a", "1"), ("2018-01-02", "T", "a", "2")])
    rows = rows.withColumn(DAY, F.to_date(DAY))
    rows.withColumn("period", F.when(F.month(DAY) < 7, "2018H1").otherwise("2018H2")).write.partitionBy(
        "period"
    ).parquet(path)
    df = sg.read_period_table(spark, path, "2018H2")
    assert [r[MINUTES] for r in df.collect()] == [Decimal("1.00")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan


def test_relations(spark, tmp_path):
    path = str(tmp_path / "log")
    raw = spark.createDataFrame(
        [("ann  ", 1, 2, 3, dt.datetime(2018, 2, 28, 1), "67  ", "x"), ("", 1, 2, 3, None, "", "x")],
        "user_azon string, szlaforg_fej_azon int, forgtet_azon bigint, azon_forgtet_azon bigint,"
        " azon_forgtet_mod_idopont timestamp_ntz, allapot_azon_feldolg string, more string",
    )
    raw.write.parquet(path)
    plain = sg.read_relation(spark, path, LOG)
    assert plain.schema.simpleString() == LOG.simpleString()
    assert {r["user_azon"] for r in plain.collect()} == {"ann  ", ""}
    clean = sg.read_relation(
        spark, path, LOG, blank_is_null=True, padded=["user_azon", "allapot_azon_feldolg"]
    )
    assert {(r["user_azon"], r["allapot_azon_feldolg"]) for r in clean.collect()} == {
        ("ann", "67"), (None, None)
    }


def test_table_name_with_dollar(spark):
    users = spark.createDataFrame([("ann", "T1")], USERS)
    users.createOrReplaceTempView(f"`{USERS_TABLE}`")
    got = sg.read_relation(spark, USERS_TABLE, USERS, fmt="table")
    assert [tuple(r) for r in got.collect()] == [("ann", "T1")]


def test_number_to_text(spark):
    values = ["0.00", "0.50", "-0.50", "1.50", "100.00", "-10.00", "0.05", "120.00"]
    df = spark.createDataFrame([(Decimal(v),) for v in values], "v decimal(18,2)")
    texts = df.select(number_to_text(F.col("v"), df.schema["v"].dataType).alias("t"))
    assert [r["t"] for r in texts.collect()] == ["0", ".5", "-.5", "1.5", "100", "-10", ".05", "120"]
    wide = spark.createDataFrame([(Decimal(10**37),), (None,)], "v decimal(38,0)")
    texts = wide.select(number_to_text(F.col("v"), ITEMS["ceg_szlaszam"].dataType).alias("t"))
    assert [r["t"] for r in texts.collect()] == [str(10**37), None]
    with pytest.raises(TypeError):
        number_to_text(F.lit(1.0), spark.range(1).select(F.lit(1.0).alias("v")).schema["v"].dataType)


@pytest.mark.parametrize("size", [0, 1, 1000])
def test_row_numbers(spark, conf, size):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(0, size, 1, 7).select((F.col("id") * 7919 % 1009).alias("v"))
    rows = number_rows(df, [F.desc("v")]).collect()
    rows.sort(key=lambda r: r["row_no"])
    assert [r["row_no"] for r in rows] == list(range(1, size + 1))
    assert [r["v"] for r in rows] == sorted((i * 7919 % 1009 for i in range(size)), reverse=True)


def counts(spark):
    rows = [("b", "x", 1), ("a", "é", 2), ("a", "z", None), (None, "x", 0), ("", "x", 5), ("a", None, 3)]
    return spark.createDataFrame(rows, f"{TEAM} string, {USER} string, GYANUS_NAPO_DB bigint")


def test_report_rows(spark):
    rows = sorted(sg.report_rows(counts(spark)).collect(), key=lambda r: r["row_no"])
    assert [tuple(r)[:3] for r in rows] == [
        (1, "", "x"), (2, "a", "z"), (3, "a", "é"), (4, "a", None), (5, "b", "x"), (6, None, "x")
    ]


def test_report_file(spark, tmp_path):
    old = sg.write_report(counts(spark).limit(1), str(tmp_path), "2018H2")
    path = sg.write_report(counts(spark), str(tmp_path), "2018H2")
    assert path == old == f"{tmp_path}/Workhour_analysis_2018H2"
    lines = []
    for part in sorted((tmp_path / "Workhour_analysis_2018H2").glob("part-*.csv")):
        head, *body = part.read_text().splitlines()
        assert head == "row_no,F_KISCSOPORT,F_NEV,GYANUS_NAPO_DB"
        lines += body
    assert lines == [
        '1,"",x,5', "2,a,z,#N/A", "3,a,é,2", "4,a,#N/A,3", "5,b,x,1", "6,#N/A,x,0"
    ]


def test_report_as_parquet(spark, tmp_path):
    path = sg.write_report(counts(spark), str(tmp_path), "2018H1", fmt="parquet")
    got = spark.read.parquet(path)
    assert got.count() == 6 and got.schema["GYANUS_NAPO_DB"].dataType.simpleString() == "bigint"

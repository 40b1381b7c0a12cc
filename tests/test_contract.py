"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as contract

SF_DIR = Path("/root/testdata/sf0.01")
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


OWN = [name for name in contract.queries() if name not in contract._llm_queries()]


def test_every_query_has_sql():
    assert set(OWN) == set(contract.oracle_sql()) - set(contract._llm_sql())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, duck, name):
    df = contract.queries()[name](spark, str(SF_DIR))
    result = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    expected = Counter(tuple(map(str, row)) for row in result.fetchall())
    assert Counter(tuple(map(str, row)) for row in df.select(*columns).collect()) == expected


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["F_KISCSOPORT", "F_NEV", "GYANUS_NAPO_DB"]
    assert df.count() > 0

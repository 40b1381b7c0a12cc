"""The registered queries: SQL where there is some, and the pipeline stage by stage."""

from __future__ import annotations

from pathlib import Path

import pytest

import corpus_pipeline
from shiftgauge.llm import jaccard, packing, queries

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="test tables not present")


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_matches_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = queries.queries()[name](spark, str(SF_DIR))
    expected = connection.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    assert sorted(columns) == sorted(df.columns)
    got = sorted(tuple(r) for r in df.select(*columns).collect())
    assert got == sorted(expected.fetchall())


@pytest.mark.parametrize("number", range(1, 14))
def test_one_query_per_operator(number):
    assert len([q for q in queries.queries() if q.startswith(f"op{number}_")]) == 1


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").cache()
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(SF_DIR)).cache()
        assert out.columns == columns
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert {r.doc_id for r in out.select("doc_id").collect()} <= ids
        if name == "near_duplicates":
            left = jaccard.near_duplicates(out)
            assert left.where("n_links > 0").count() == 0 and out.count() < docs.count()
        docs = out
    packed = packing.pack(docs)
    assert packed.select("doc_id").distinct().count() == docs.count()

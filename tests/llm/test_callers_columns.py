"""Filtering stages give back the caller's columns, whatever their names."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shiftgauge.llm import decontaminate, jaccard, personal_data, toxicity

# Names that the operators use or used for columns of their own.
NAMES = (
    "score _score n_words spans items longest _row row _changed changed _hash hash _id kept_id kept_hash id number"
    " _number _most most own text_hash set_id n_grams bands sketch class_id class_row n_links block side held_out"
    " predicted found doc label n tokens _own _other"
).split()

CLEAN = "the weather in the valley was mild and nobody had expected the rain to stop before noon"


@pytest.fixture
def odd(spark):
    texts = [(1, CLEAN), (2, None), (3, ""), (None, "no id here at all, is there"), (5, "mail bob@example.com now")]
    texts += [(6, "alpha beta gamma delta epsilon zeta eta theta iota kappa and a tail that is nobody's"), (7, "unlike all others")]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    # Text, numbers and lists by turns, told apart by the row.
    kinds = [lambda x, n: F.concat(F.lit(n), x.cast("string")), lambda x, n: x * 2.5, lambda x, n: F.array(x, x + 1)]
    mark = F.coalesce("doc_id", F.lit(0))
    own = [kinds[i % 3](mark, name).alias(name) for i, name in enumerate(NAMES)]
    return frame.select("doc_id", *own, F.length("text").alias("n_chars"), "text")


def own_values(df, keep):
    return {r["doc_id"]: tuple(r[c] for c in keep) for r in df.collect()}


def stages(spark):
    item = [("i", "alpha beta gamma delta epsilon zeta eta theta iota kappa")]
    benchmark = spark.createDataFrame(item, "item_id string, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in (1, 5, 6, 7)], "doc_id bigint, toxic int")
    return {
        "toxicity": lambda d: toxicity.drop_toxic(d, labels, threshold=1.1),
        "near_duplicates": jaccard.keep_one,
        "decontamination": lambda d: decontaminate.remove_contamination(d, benchmark, max_coverage=0.9),
        "decontamination, in shards": lambda d: decontaminate.remove_contamination(
            d, benchmark.union(spark.sql("SELECT 'j', 'one two three four five six seven eight nine ten'")), max_coverage=0.9
        ),
        "personal_data": personal_data.redact_personal_data,
    }


@pytest.mark.parametrize("repeated", [False, True])
@pytest.mark.parametrize("name", ["toxicity", "near_duplicates", "decontamination", "decontamination, in shards", "personal_data"])
def test_columns_come_back(spark, odd, name, repeated, monkeypatch):
    if "shards" in name:
        made = decontaminate.find_contamination
        monkeypatch.setattr(decontaminate, "find_contamination", lambda *a, **k: made(*a, **k, max_words=8))
    docs = odd.union(odd) if repeated else odd.where("doc_id IS NOT NULL")
    out = stages(spark)[name](docs)
    assert out.columns == docs.columns
    assert out.dtypes == docs.dtypes
    assert own_values(out, NAMES) == own_values(docs, NAMES)
    kept = {r.doc_id: r.n_chars for r in out.collect()}
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out.collect())
    assert len(kept) == len({r.doc_id for r in docs.collect()})

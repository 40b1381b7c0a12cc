"""Documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and reread as the next one's ``docs``. All but the last return the columns of documents:

1. ``toxicity``: documents that the model, learnt from all labels, rejects go;
2. ``near_duplicates``: of each class of near copies one document stays;
3. ``decontamination``: passages of benchmark items are cut out, and documents that are
   mostly such passages go;
4. ``personal_data``: personal data is replaced by its kind;
5. ``packing``: one row per piece, with its sequence and its place there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shiftgauge.checkpoints import store
from shiftgauge.llm import decontaminate, jaccard, packing, personal_data, toxicity


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def _decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.remove_contamination(docs, items)


def _personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return personal_data.redact_personal_data(docs)


def _packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs).drop("row")


STAGES = [
    ("toxicity", _toxicity),
    ("near_duplicates", _near_duplicates),
    ("decontamination", _decontamination),
    ("personal_data", _personal_data),
    ("packing", _packing),
]

# Classifiers, hashes and tokenizers are beyond SQL; tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs, _ = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

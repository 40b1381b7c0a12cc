"""Token ids as Parquet files: list columns with delta or dictionary encoding.

``write_tokens`` deals documents out by ranges of ``doc_id`` (one file a range, equal
rows), sorts and encodes each range in its task and writes one row per document.
``read_tokens`` reads chosen columns and ranges back: row groups and pages carry the
least and greatest ``doc_id``, so a range read skips the others, and a read of the
metadata never touches the ids.

Rows in which ``doc_id`` is NULL come first; repeated ids are ordered by their text.
A NULL or empty text is a document of its end id alone. An empty table gives no rows.
Other columns of the input, whatever their names, are neither read nor written.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftgauge.llm.rows import give_back, text_chunks
from shiftgauge.llm.tokens import text_encoder, vocabulary_path

SCHEMA = "doc_id bigint, tokens array<int>, n_tokens bigint, shard int, shard_start bigint"


def write_tokens(
    docs: DataFrame,
    path: str,
    *,
    vocabulary: str | None = None,
    end_id: int = 0,
    encoding: str = "dictionary",
    shard_bytes: int = 32 << 20,
    row_group_bytes: int = 16 << 20,
    page_rows: int = 2_000,
) -> None:
    """Encode ``text`` of ``docs`` (doc_id, text) into Parquet files below ``path``.

    ``encoding`` of the ids: ``dictionary`` (16 bits an id for vocabularies up to 65,536)
    or ``delta``. ``shard_bytes`` is the text of a file, on average.
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown encoding: {encoding}")
    vocabulary = vocabulary or vocabulary_path()
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    size = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, math.ceil(size / shard_bytes))
    dealt = rows.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches):
        encode, before, shard = text_encoder(vocabulary), 0, TaskContext.get().partitionId()
        for batch in batches:
            for part in text_chunks(batch, "text"):
                ids, offsets = with_end(*encode(part.column("text")), end_id)
                lengths, starts = np.diff(offsets), before + offsets[:-1]
                before += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.ListArray.from_arrays(offsets.astype(np.int32), ids.view(np.int32)),
                        pa.array(lengths, pa.int64()),
                        pa.array(np.full(len(lengths), shard, np.int32)),
                        pa.array(starts, pa.int64()),
                    ],
                    names=["doc_id", "tokens", "n_tokens", "shard", "shard_start"],
                )
        give_back()

    (
        dealt.mapInArrow(run, SCHEMA)
        .write.option("compression", "zstd")
        .option("parquet.writer.version", "v2")
        .option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
        .option("parquet.dictionary.page.size", 4 << 20)
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.row.count.limit", page_rows)
        .parquet(path)
    )


def read_tokens(
    spark: SparkSession, path: str, where: Column | None = None, *columns: str
) -> DataFrame:
    """Chosen ``columns`` (all of ``SCHEMA`` by default) of the rows that ``where`` names."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    rows = rows if where is None else rows.where(where)
    return rows.select(*columns) if columns else rows


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and crc32 of the ids, from files."""
    shards = read_tokens(spark, path, None, "shard", "n_tokens").groupBy("shard")
    totals = shards.agg(F.sum("n_tokens").alias("total"))
    # One row a file; the running total of a column with one value a file is small.
    before = totals.selectExpr(
        "shard AS of_shard",
        "sum(total) OVER (ORDER BY shard) - total AS shard_offset",
    )
    rows = read_tokens(spark, path).mapInArrow(
        _checksums, "doc_id bigint, n_tokens bigint, shard int, shard_start bigint, ids_crc32 bigint"
    )
    return rows.join(before, F.col("shard") == F.col("of_shard")).select(
        "doc_id",
        (F.col("shard_offset") + F.col("shard_start")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end_id`` to each document."""
    ends = offsets[1:]
    return np.insert(ids, ends, end_id), offsets + np.arange(len(offsets))


def _checksums(batches):
    names = ["doc_id", "n_tokens", "shard", "shard_start"]
    for batch in batches:
        lists = batch.column("tokens")
        ids = lists.values.to_numpy().astype("<u4", copy=False)
        offsets = lists.offsets.to_numpy()
        crcs = [zlib.crc32(ids[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in names], pa.array(crcs, pa.int64())],
            names=[*names, "ids_crc32"],
        )

"""Shared pieces: reading the text column, words, and running a function over texts."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Every byte below 0x80 that is no digit or letter separates words; A-Z become a-z.
_FOLD = bytes(
    c + 32
    if 65 <= c <= 90
    else c
    if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122
    else 32
    for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def word_counts(
    texts: pa.Array,
) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of ``words_of`` for many texts at once, counted per text.

    Returns the different words, then row, number of the word and count for every word of
    every row (by row, then number), then the number of words of each row. NULL is empty.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    folded = data.slice(ends[0], ends[-1] - ends[0]).to_pybytes().translate(_FOLD) if data else b""
    plain = pa.LargeStringArray.from_buffers(
        len(texts), pa.py_buffer(ends - ends[0]), pa.py_buffer(folded)
    )
    split = pc.ascii_split_whitespace(plain)
    coded = split.flatten().dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    rows = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    word = pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False) > 0
    real = word[codes]
    rows, codes = rows[real], codes[real]
    lengths = np.bincount(rows, minlength=len(texts))
    size = max(1, len(coded.dictionary))
    keys, counts = np.unique(rows * size + codes, return_counts=True)
    return coded.dictionary, keys // size, keys % size, counts, lengths


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """True for the documents kept out of learning; a document without id is learnt from."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(crc % parts == part, F.lit(False))


def set_apart(docs: DataFrame) -> DataFrame:
    """``text``, and all other columns of the caller in one struct ``own``: no name can clash."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select(F.struct(*others).alias("own"), F.col("text").cast("string").alias("text"))


def put_back(df: DataFrame, columns: list[str], **made: Column) -> DataFrame:
    """The caller's ``columns`` in their order: those ``made``, ``text``, and what was set apart."""
    own = {c: F.col("own").getField(c) for c in columns if c != "text"}
    own |= {"text": F.col("text")} | made
    return df.select(*[own[c].alias(c) for c in columns])


def text_chunks(
    batch: pa.RecordBatch, column: str = "text", size: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with about ``size`` bytes of text, one row at least."""
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths.astype(np.int64)) // size
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def give_back() -> None:
    """Return freed memory to the system, so that reused workers do not add it up."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def map_texts(
    df: DataFrame, start: Callable[[], Callable], schema: str, text: str = "text"
) -> DataFrame:
    """Replace the text column by the columns of ``schema``; other columns stay.

    ``start()`` runs once per task and returns a function from one text (or None) to
    one tuple. Texts travel in Arrow batches; a task holds one batch at a time and
    works on a slice of it.
    """
    kept = [f for f in df.schema.fields if f.name != text]
    names = [f.name for f in kept]
    added = T.StructType.fromDDL(schema)
    whole = T.StructType([*kept, *added.fields])
    arrow = to_arrow_schema(whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = start()
        for batch in batches:
            for part in text_chunks(batch, text):
                rows = [one(t) for t in part.column(text).to_pylist()]
                columns = [part.column(n) for n in names]
                made = zip(*rows, strict=True)
                for values, kind in zip(made, arrow.types[len(names) :], strict=True):
                    columns.append(pa.array(values, kind))
                columns = [c.cast(t) for c, t in zip(columns, arrow.types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        give_back()

    return df.mapInArrow(run, whole)

"""Packing of documents into sequences of a fixed number of tokens.

Bound-certified repacking. Pieces are dealt at random over partitions, each packed by
best-fit decreasing. Dual feasible functions give lower bounds: what a function assigns to pieces
adds up to at most one a sequence. The function that gives the best bound for the pieces of all
partitions tells each partition's share of it. A partition that uses its share rounded up, and
not more than a ``parts``-th of a sequence beyond the share itself, is certified and closed: all
that are closed in a round use at most one sequence more than any packing could save on them.
The others close their full sequences; those with gaps are taken apart, their pieces exchanged
between fewer partitions and packed again, as long as the bound leaves room. An exchange that
saves nothing is undone and another one tried. With one partition there is nothing to exchange
with: pieces out of full sequences never changed where the others went.

A document is its ids and an end id; only one longer than a sequence is cut, its first
piece being the shorter one. NULL and empty texts are documents of the end id alone.
Repeated rows are packed each on their own, an empty table gives no rows, and other
columns of the input are not read. Pieces of equal length are taken in the order of the input.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftgauge.checkpoints import store
from shiftgauge.llm.rows import give_back, text_chunks
from shiftgauge.llm.token_files import with_end
from shiftgauge.llm.tokens import text_encoder, vocabulary_path

_PIECES = (
    "row bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
)
_PLACES = "sequence_id bigint, offset bigint, bins bigint, bound bigint, gap bigint"
_PLACES += ", closed boolean"
_PARTS, _BINS = 31, 26  # bits of a sequence id for the partition and the sequence in it


def token_pieces(
    docs: DataFrame, capacity: int = 1024, *, vocabulary: str | None = None, end_id: int = 2
) -> DataFrame:
    """One row per piece of each document (doc_id, text); ``row`` numbers the input rows."""
    vocabulary = vocabulary or vocabulary_path()
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("bigint"),
        F.col("text").cast("string"),
    )

    def run(batches):
        encode = text_encoder(vocabulary)
        for batch in batches:
            for part in text_chunks(batch, "text"):
                ids, offsets = with_end(*encode(part.column("text")), end_id)
                of, starts, ends, pieces = [], [], [], []
                for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                    cut = a + ((b - a) % capacity or capacity)
                    edges = [a, *range(cut, b + 1, capacity)]
                    of += [i] * (len(edges) - 1)
                    starts += edges[:-1]
                    ends += edges[1:]
                    pieces += range(len(edges) - 1)
                base = offsets[np.array(of, np.int64)]
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row").take(pa.array(of)),
                        part.column("doc_id").take(pa.array(of)),
                        pa.array(pieces, pa.int32()),
                        pa.array(np.array(starts) - base, pa.int64()),
                        pa.array(np.array(ends) - np.array(starts), pa.int64()),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["row", "doc_id", "piece", "start", "length", "ids_crc32"],
                )
        give_back()

    return rows.mapInArrow(run, _PIECES)


def pack(
    docs: DataFrame,
    capacity: int = 1024,
    *,
    vocabulary: str | None = None,
    end_id: int = 2,
    pieces_per_partition: int = 50_000,
    max_rounds: int = 12,
) -> DataFrame:
    """Place every piece: row, doc_id, piece, start, length, ids_crc32, sequence_id, offset, bins, bound.

    ``bins`` is how many sequences the partition used that packed the piece last, ``bound`` how
    many its pieces need at least by the function that is best for all; a piece as long as a sequence is a partition of its own.
    ``pieces_per_partition`` bounds what one task packs, ``max_rounds`` how often pieces are exchanged.
    """
    if pieces_per_partition > 1 << (_BINS - 2) or max_rounds > 31:
        raise ValueError("at most 2^24 pieces a partition and 31 rounds")
    pieces, seen = store(
        token_pieces(docs, capacity, vocabulary=vocabulary, end_id=end_id),
        part=F.count(F.when(F.col("length") < capacity, 1)),
    )
    full = pieces.where(F.col("length") >= capacity).select(
        "*",
        (F.lit(1 << 62) + F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
        F.lit(1).cast("bigint").alias("bins"),
        F.lit(1).cast("bigint").alias("bound"),
    )
    done = [full]
    pool, n_pool, used = pieces.where(F.col("length") < capacity), seen["part"], None
    for round_ in range(max_rounds):
        if not n_pool:
            break
        parts = max(1, math.ceil(n_pool / pieces_per_partition))
        dual = best_dual(_histogram(pool, capacity), capacity)
        if used is not None and used <= dual[0]:
            break
        left = (F.col("gap") > 0) & ~F.col("closed")
        packed, new = store(
            _packed(pool, capacity, parts, round_, dual),
            bins=F.count(F.when(F.col("offset") == 0, 1)),
            open_bins=F.count(F.when(left & (F.col("offset") == 0), 1)),
            open_pieces=F.count(F.when(left, 1)),
        )
        if used is None or new["bins"] < used:
            done.append(packed.where(~left))
            kept = packed.where(left)
            n_pool, used = new["open_pieces"], new["open_bins"]
            pool = kept.select("row", "doc_id", "piece", "start", "length", "ids_crc32")
        # Else nothing is saved: the earlier places stay, and another exchange is tried.
        if parts == 1:
            break
    if n_pool:
        done.append(kept)
    columns = [*pieces.columns, "sequence_id", "offset", "bins", "bound"]
    out = done[0].select(columns)
    for df in done[1:]:
        out = out.unionByName(df.select(columns))
    return out


def _packed(
    pool: DataFrame, capacity: int, parts: int, round_: int, dual: tuple[int, int, np.ndarray]
) -> DataFrame:
    _, scale, value = dual
    key = F.pmod(F.xxhash64("row", "piece", F.lit(round_)), F.lit(parts)).cast("int")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["row", "piece"], kind="stable")
        lengths = pdf["length"].to_numpy()
        bins, offsets, fill = best_fit(lengths, capacity)
        base = ((round_ << _PARTS) + (int(pdf["part"].iloc[0]) if len(pdf) else 0)) << _BINS
        share = int(value[lengths].sum())
        return pdf.drop(columns="part").assign(
            sequence_id=base + bins,
            offset=offsets,
            bins=len(fill),
            bound=-(-share // scale),
            gap=capacity - fill[bins],
            closed=(len(fill) * scale - share) * parts <= scale,
        )

    return (
        pool.withColumn("part", key).groupBy("part").applyInPandas(run, f"{_PIECES}, {_PLACES}")
    )


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of each piece, and how full each bin is."""
    bins = np.zeros(len(lengths), np.int64)
    offsets = np.zeros(len(lengths), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by what is free in them
    has_room = 0  # bit r: some bin has r free
    fill: list[int] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = has_room >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            b = room[free].pop()
            if not room[free]:
                has_room &= ~(1 << free)
        else:
            free, b = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += size
        left = free - size
        room[left].append(b)
        has_room |= 1 << left
    return bins, offsets, np.array(fill, np.int64)


def best_dual(counts: np.ndarray, capacity: int) -> tuple[int, int, np.ndarray]:
    """The best of two families of dual feasible functions for ``counts[n]`` pieces of length ``n``.

    Returns its bound, and the function in whole numbers: pieces of one sequence add up to at most
    the second result. The families are cutting off at a threshold (long pieces count as whole,
    short ones as nothing) and rounding to k-ths. Nothing is lost to rounding.
    """
    n = np.arange(capacity + 1)
    counts = np.asarray(counts[: capacity + 1], np.int64)
    duals = [(capacity, n)]
    for low in np.flatnonzero(counts[: capacity // 2 + 1]).tolist():
        duals.append((capacity, np.where(n > capacity - low, capacity, np.where(n < low, 0, n))))
    for k in range(1, 21):
        whole = (k + 1) * n % capacity == 0
        value = np.where(whole, n * k, (k + 1) * n // capacity * capacity)
        duals.append((capacity * k, value))
    best = (-1, 1, n)
    for scale, value in duals:
        bound = -(-int((counts * value).sum()) // scale)
        if bound > best[0]:
            best = bound, scale, value
    return best


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that pieces need at least; ``counts[n]`` pieces have length ``n``."""
    return best_dual(counts, capacity)[0]


def _histogram(pieces: DataFrame, capacity: int) -> np.ndarray:
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():  # ``capacity`` rows at most
        counts[length] = n
    return counts

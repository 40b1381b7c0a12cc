"""Centroid clustering in whole numbers, assigned by a tournament of bisectors.

Components become integers floor(scale * x), so every step is exact and independent of row
order. The boundary between two centroids a < b is the plane ``normal . v = threshold`` with
``normal = 2 (c_b - c_a)`` and ``threshold = |c_b|^2 - |c_a|^2``: v is nearer to b exactly if
``normal . v > threshold``, and zero goes to the smaller number. These are precomputed for all
pairs. A vector's nearest centroid is the winner of a knock-out tournament: k - 1 sign tests,
each of which drops one centroid. The squared distance is then computed for the winner only.

A round reads the kept vectors (stored once), assigns them in numpy and returns one row per
task, cluster and component, which Spark sums. Only k x dimensions sums reach the driver; what
is broadcast are the centroids, of fixed size. There is no shuffle by vector, so repeated
vectors make no hot task.

Vectors of another length, NULL ones and ones with a NULL, NaN or infinite component are left
out. Rows with the same id are vectors of their own. A vector without id takes part, and is a
first centroid only if those with an id do not suffice. Fewer vectors than ``k`` give that many
centroids; an empty table gives no rows. Where a squared distance or an inertia does not fit a
long it is NULL; scaled components of 2^53 and more raise, since they have no exact fractions.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftgauge.checkpoints import store
from shiftgauge.llm.rows import give_back

MOST = 1 << 53
_LONG = (1 << 63) - 1
_AT_ONCE = 4096


def exact_type(most: int, dimensions: int):
    """The fastest number type in which no test, distance or threshold can be rounded."""
    largest = 4 * dimensions * (most + 1) ** 2  # |normal . v|, thresholds and distances
    if largest < 1 << 53:
        return np.float64  # products of matrices; every value is a whole number
    return np.int64 if largest < 1 << 62 else object


class Bisectors:
    """Normals and thresholds of all pairs of centroids, and the tournament over them."""

    def __init__(self, centroids: list[list[int]], kind):
        c = np.array(centroids, dtype=kind)
        self.centroids, self.kind = c, kind
        squares = (c * c).sum(axis=1)
        # Row a * k + b belongs to the pair a < b.
        k = len(c)
        self.normals = (2 * (c[None, :, :] - c[:, None, :])).reshape(k * k, -1)
        self.thresholds = (squares[None, :] - squares[:, None]).reshape(k * k)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid and squared distance to it, for every vector."""
        n, k = len(vectors), len(self.centroids)
        # The first matches are the same for all vectors: one product of matrices.
        first = np.arange(0, k - 1, 2)
        pairs = first * k + first + 1
        upper = vectors @ self.normals[pairs].T > self.thresholds[pairs]
        alive = first + upper.astype(np.int64)
        if k % 2:
            alive = np.hstack([alive, np.full((n, 1), k - 1)])
        while alive.shape[1] > 1:
            rest = alive[:, alive.shape[1] // 2 * 2 :]
            winners = np.empty((n, alive.shape[1] // 2), np.int64)
            for i in range(winners.shape[1]):
                a, b = alive[:, 2 * i], alive[:, 2 * i + 1]  # a < b: matches keep the order
                pair = a * k + b
                side = (self.normals[pair] * vectors).sum(axis=1) > self.thresholds[pair]
                winners[:, i] = np.where(side, b, a)
            alive = np.hstack([winners, rest])
        own = alive[:, 0]
        off = vectors - self.centroids[own]
        return own, (off * off).sum(axis=1)


def _integers(part: pa.Array, dimensions: int, scale: int) -> np.ndarray:
    """floor(scale * x) of a list column without NULLs, as whole float64 numbers."""
    flat = part.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * scale).reshape(-1, dimensions)


def _slices(batches: Iterator[pa.RecordBatch], dimensions: int, scale: int):
    for batch in batches:
        for at in range(0, batch.num_rows, _AT_ONCE):
            part = batch.slice(at, _AT_ONCE)
            yield part.column(0), _integers(part.column(1), dimensions, scale)


def _exact(values: np.ndarray, kind) -> np.ndarray:
    if kind is object:
        return np.array([[int(x) for x in row] for row in values.tolist()], object)
    return values.astype(kind)


def _round_sums(kept: DataFrame, model, dimensions: int, scale: int) -> DataFrame:
    """cluster, component, total and number of vectors, from each task once per cluster."""

    def run(batches):
        centroids, kind = model.value
        bisectors = Bisectors(centroids, kind)
        k = len(centroids)
        totals = np.zeros((k, dimensions), object)
        counts = np.zeros(k, np.int64)
        for _, values in _slices(batches, dimensions, scale):
            vectors = _exact(values, kind)
            own, _ = bisectors.nearest(vectors)
            order = np.argsort(own, kind="stable")
            found, begins = np.unique(own[order], return_index=True)
            # A slice's sums are exact in the type of the vectors, the task's are Python integers.
            sums = np.add.reduceat(vectors[order], begins, axis=0) if len(own) else []
            for c, total in zip(found.tolist(), sums, strict=True):
                totals[c] += np.array([int(x) for x in total], object)
            counts += np.bincount(own, minlength=k)
        full = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(full, dimensions), pa.int32()),
                pa.array(np.tile(np.arange(dimensions), len(full)), pa.int32()),
                pa.array([str(x) for c in full for x in totals[c]], pa.string()),
                pa.array(np.repeat(counts[full], dimensions), pa.int64()),
            ],
            names=["cluster", "component", "total", "n"],
        )
        give_back()

    parts = kept.select("vec_id", "vector").mapInArrow(
        run, "cluster int, component int, total string, n bigint"
    )
    return parts.groupBy("cluster", "component").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")
    )


def _assigned(kept: DataFrame, model, dimensions: int, scale: int) -> DataFrame:
    kinds = pa.schema([("cluster", pa.int32()), ("distance", pa.int64())])

    def run(batches):
        centroids, kind = model.value
        bisectors = Bisectors(centroids, kind)
        for ids, values in _slices(batches, dimensions, scale):
            own, far = bisectors.nearest(_exact(values, kind))
            distance = [int(x) if x <= _LONG else None for x in far.tolist()]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(own, kinds.types[0]), pa.array(distance, kinds.types[1])],
                names=["vec_id", *kinds.names],
            )
        give_back()

    kind = kept.schema["vec_id"].dataType.simpleString()
    return kept.select("vec_id", "vector").mapInArrow(
        run, f"vec_id {kind}, cluster int, distance bigint"
    )


def cluster(
    vectors: DataFrame,
    *,
    k: int = 40,
    rounds: int = 5,
    dimensions: int = 64,
    scale: int = 256,
    seed: str = "2:",
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance of every kept vector), and the final centroids.

    Centroids start as the ``k`` kept vectors whose SHA-256 of ``seed`` and id is smallest, ties
    by components. ``k`` bounds the model: k * k normals of ``dimensions`` numbers.
    """
    if scale & (scale - 1) or scale < 1:
        raise ValueError("scale must be a power of two, so that scaling is exact")
    wide = F.transform(F.col(f"`{vector_column}`"), lambda x: x.cast("double"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf)
    kept = vectors.select(F.col(f"`{id_column}`").alias("vec_id"), wide.alias("vector"))
    kept = kept.where(F.size("vector") == dimensions).where(~F.exists("vector", bad))
    # The lists travel as what they are: their length is known, NULLs are gone.
    most = F.max(F.array_max(F.transform("vector", lambda x: F.abs(x))))
    kept, seen = store(kept, most=most, n=F.count(F.lit(1)))
    if not seen["n"]:
        return kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")), []
    if seen["most"] * scale >= MOST:
        raise ArithmeticError(f"components of {MOST // scale} and more have no exact fractions")
    kind = exact_type(math.ceil(seen["most"] * scale), dimensions)
    ordinal = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    starts = kept.orderBy(ordinal.asc_nulls_last(), "vector").limit(k)
    centroids = [
        [math.floor(x * scale) for x in row.vector] for row in starts.select("vector").collect()
    ]
    context = kept.sparkSession.sparkContext
    for _ in range(rounds):
        model = context.broadcast((centroids, kind))
        centroids = [list(c) for c in centroids]
        for row in _round_sums(kept, model, dimensions, scale).collect():
            centroids[row.cluster][row.component] = int(row.total) // row.n
        model.unpersist()
    model = context.broadcast((centroids, kind))
    return _assigned(kept, model, dimensions, scale), centroids


def centroid_digest(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 per vector."""
    spark = vectors.sparkSession
    found, centroids = cluster(vectors, **options)
    found, _ = store(found)
    whole = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = found.groupBy("cluster").agg(
        F.when(F.count("distance") == F.count(F.lit(1)), whole).alias("part")
    )
    parts = {r.cluster: r.part if r.part is None else int(r.part) for r in sums.collect()}  # k rows
    inertia = None if None in parts.values() else sum(parts.values())
    known = [
        (c, _long(part), _long(inertia), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
        for c, part in parts.items()
    ]
    schema = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    known = spark.createDataFrame(known, schema)
    return found.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _long(value: int | None) -> int | None:
    return value if value is not None and value <= _LONG else None

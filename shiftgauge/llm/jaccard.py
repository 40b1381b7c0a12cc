"""Near-duplicate join: pairs of texts whose word 5-grams have a Jaccard similarity of 0.8 or more.

1. Every text becomes the set of its hashed n-grams. Texts with the same set are one
   *representative* with a number of copies; from here on only representatives count.
2. MinHash banding. Band and row counts are chosen for the target recall; representatives
   meet in a shuffle on the hashes of their bands. Within a bucket a small sketch sorts out
   pairs far below the threshold (``SKETCH`` values; five standard deviations are allowed
   for). Buckets of more than ``BUCKET`` members are dealt out by a salt and their parts tied
   together, which can only add candidates.
3. What hangs together becomes a candidate cluster (``connected``).
4. Each cluster is verified on the full sets. Clusters that are large, by members or by
   n-grams, are dealt into blocks and every pair of blocks is a group of its own, so no task
   holds more than two blocks; a task returns one row a member, with its number of links and a
   root, never the pairs.
5. Verified links give the classes.

Every pair of a cluster is verified, so a link is lost only if the banding never brought the
two together over any path. Result: one row per document with ``class_id`` (the least doc_id of
its class) and ``n_links`` (other documents at or above the threshold, copies included).

Texts of fewer than five words are one n-gram, of all their words. NULL and empty texts are
not linked to anything. Repeated rows are copies of each other. A document without id takes
part; its class has a NULL id if no member has one. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftgauge.checkpoints import store
from shiftgauge.llm.components import connected
from shiftgauge.llm.rows import _FOLD, give_back, text_chunks

SKETCH = 64
BUCKET = 1000
BLOCK_MEMBERS = 512
BLOCK_GRAMS = 1 << 20

_AT_ONCE = 1 << 19  # bytes of text; hashing takes some fifty times as much

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def choose_bands(threshold: float, recall: float, most_hashes: int = 256) -> tuple[int, int]:
    """Bands and rows: the longest bands that reach the recall at the threshold."""
    best = None
    for rows in range(1, most_hashes + 1):
        miss = math.log1p(-(threshold**rows)) if threshold < 1 else -math.inf
        if miss > math.log(1 - recall) / most_hashes:
            break  # bands this long would need too many of them
        bands = math.ceil(math.log(1 - recall) / miss) or 1
        if bands * rows <= most_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("more hashes are needed for this recall")
    return best


# --- n-gram sets -------------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_sets(texts: list[bytes | None], n: int = 5) -> list[np.ndarray]:
    """The sorted set of hashed word n-grams of each text, all texts at once."""
    joined = b" ".join([t or b"" for t in texts]) + b" "
    chars = np.frombuffer(joined.translate(_FOLD), np.uint8)
    ends_of_texts = np.cumsum([len(t or b"") + 1 for t in texts])
    inside = chars != 32
    edges = np.diff(np.concatenate([[False], inside]).astype(np.int8))
    starts = np.flatnonzero(edges == 1)
    ends = np.flatnonzero(edges == -1)
    # A word's hash: its bytes as a polynomial, from running sums over all bytes.
    power = np.cumprod(np.full(len(chars), _P, np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(chars.astype(np.uint64) * power)])
    back = np.cumprod(np.full(len(chars), _P_INVERSE, np.uint64))
    words = _mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    of = np.searchsorted(starts, np.concatenate([[0], ends_of_texts]))
    grams = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for k in range(n):
        weight = (2 * k + 1) * int(_P) % (1 << 64)
        grams += _mix(words[k : k + len(grams)] + np.uint64(weight))
    grams = _mix(grams)
    out = []
    for a, b in zip(of[:-1].tolist(), of[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        elif b > a:
            short = np.array([b - a], np.uint64)
            for word in words[a:b]:
                short = _mix(short * _P + word)
            out.append(short)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_binary()).to_pylist()


class Signer:
    """Band hashes and sketch of a set."""

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows = bands, rows
        rng = np.random.default_rng(20_240_229)
        count = max(bands * rows, SKETCH)
        self.flip = rng.integers(0, 1 << 32, count, np.uint32)[:, None]
        self.factor = (rng.integers(0, 1 << 31, count, np.uint32) * 2 + 1)[:, None]
        self.weights = rng.integers(0, 1 << 63, (rows,), np.uint64) * np.uint64(2) + np.uint64(1)

    def sign(self, grams: np.ndarray) -> tuple[np.ndarray, bytes]:
        short = (grams >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self.flip), 0xFFFFFFFF, np.uint32)
        for at in range(0, len(short), 2048):
            part = short[None, at : at + 2048] ^ self.flip
            part *= self.factor
            np.minimum(least, part.min(axis=1), out=least)
        used = least[: self.bands * self.rows].reshape(self.bands, self.rows).astype(np.uint64)
        keys = _mix((used * self.weights).sum(axis=1) + np.arange(self.bands, dtype=np.uint64) * _P)
        return keys.view(np.int64), least[:SKETCH].astype(np.uint8).tobytes()


def _signed(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """row, doc_id, text_hash, set fingerprint, number of n-grams, band hashes, sketch."""
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        F.col("text").cast("string").alias("text"),
    )

    def run(batches):
        signer = Signer(bands, rows)
        none = np.zeros(0, np.int64)
        for batch in batches:
            for part in text_chunks(batch, size=_AT_ONCE):
                sets = gram_sets(_bytes(part.column("text")), n)
                signs = [signer.sign(s) if len(s) else (none, b"") for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        part.column("doc_id"),
                        part.column("text_hash"),
                        pa.array([_fingerprint(s) for s in sets], pa.binary()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([keys for keys, _ in signs], pa.list_(pa.int64())),
                        pa.array([sketch for _, sketch in signs], pa.binary()),
                    ],
                    names=["row", "doc_id", "text_hash", "set_id", "n_grams", "bands", "sketch"],
                )
        give_back()

    return texts.mapInArrow(
        run,
        "row bigint, doc_id bigint, text_hash bigint, set_id binary, n_grams bigint,"
        " bands array<bigint>, sketch binary",
    )


def _fingerprint(grams: np.ndarray) -> bytes | None:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None


# --- candidates --------------------------------------------------------------------


def _whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Sorted batches, cut so that no value of ``key`` is in two tables."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        other = np.flatnonzero(keys != keys[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        if not cut and held and held[-1].column(key)[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least node each of ``n`` nodes hangs together with, over pairs a, b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _candidate_edges(signed: DataFrame, reps: DataFrame, least_alike: int) -> DataFrame:
    """a, b: representatives that share a bucket and whose sketches agree enough."""
    # Both sides of these joins grow with the corpus, so neither is ever broadcast.
    own = signed.join(reps.select("row").hint("merge"), "row").select("row", "bands", "sketch")
    members = own.select("row", F.explode("bands").alias("key"))
    buckets = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("hub"))
    met = members.join(buckets.where("n > 1").hint("merge"), "key")
    # Sketches travel with the few members of shared buckets only.
    met = met.join(own.select("row", "sketch").hint("merge"), "row")
    parts = F.ceil(F.col("n") / BUCKET)
    part = F.when(F.col("n") > BUCKET, F.pmod(F.xxhash64("row"), parts)).otherwise(F.lit(0))
    large = F.col("n") > BUCKET
    dealt = met.select(
        "row", "sketch", F.xxhash64("key", part).alias("key"), large.alias("large"), "hub"
    )

    def run(batches):
        for table in _whole_groups(batches, "key"):
            keys = table.column("key").to_numpy()
            rows = table.column("row").to_numpy()
            sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8)
            sketch = sketch.reshape(len(rows), SKETCH)
            begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            last = np.repeat(np.append(begins[1:], len(keys)), np.diff(np.append(begins, len(keys))))
            root = np.arange(len(rows))
            lag, at = 1, np.arange(len(rows))
            while True:  # each member with the one ``lag`` places on, in all groups at once
                at = at[at + lag < last[at]]
                if not len(at):
                    break
                near = at[root[at] != root[at + lag]]
                for s in range(0, len(near), 1 << 16):
                    i = near[s : s + (1 << 16)]
                    alike = (sketch[i] == sketch[i + lag]).sum(axis=1) >= least_alike
                    if alike.any():
                        i = i[alike]
                        joined = _roots(root[i], root[i + lag], len(rows))
                        root = joined[root]
                lag += 1
            large = table.column("large").to_numpy(zero_copy_only=False)
            hub = table.column("hub").to_numpy()
            to = np.where(large & (root == np.arange(len(rows))), hub, rows[root])
            own = to != rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[own]), pa.array(to[own])], names=["a", "b"]
            )

    grouped = dealt.repartition("key").sortWithinPartitions("key")
    return grouped.mapInArrow(run, "a bigint, b bigint")


# --- verification ------------------------------------------------------------------


def _shared_counts(sets: list[np.ndarray], left: int) -> np.ndarray:
    """How many n-grams each of the first ``left`` sets shares with each other set.

    ``left`` is the number of sets of the first block; with one block it is all of them.
    """
    m = len(sets)
    of = np.repeat(np.arange(m), [len(s) for s in sets])
    grams = np.concatenate(sets)
    order = np.argsort(grams, kind="stable")
    grams, of = grams[order], of[order]
    new = np.concatenate([[True], grams[1:] != grams[:-1]])
    begins = np.flatnonzero(new)
    sizes = np.diff(np.append(begins, len(grams)))
    shared = np.zeros((m, m), np.int64)
    # Rare n-grams: every pair that shares one; members stand in order within an n-gram.
    size_of = np.repeat(sizes, sizes)
    last = np.repeat(begins + sizes, sizes)
    at = np.flatnonzero((size_of > 1) & (size_of <= 32))
    lag = 1
    while len(at := at[at + lag < last[at]]):
        for s in range(0, len(at), 1 << 20):
            i = at[s : s + (1 << 20)]
            shared += np.bincount(of[i] * m + of[i + lag], minlength=m * m).reshape(m, m)
        lag += 1
    shared += shared.T
    # Frequent n-grams: products of 0/1 matrices, some columns at a time.
    often = np.flatnonzero(sizes > 32)
    column = np.full(len(sizes), -1)
    column[often] = np.arange(len(often))
    column = np.repeat(column, sizes)
    right = slice(left if left < m else 0, m)
    for s in range(0, len(often), 4096):
        i = np.flatnonzero((column >= s) & (column < s + 4096))
        holds = np.zeros((m, min(4096, len(often) - s)), np.float32)
        holds[of[i], column[i] - s] = 1
        shared[:left, right] += (holds[:left] @ holds[right].T).astype(np.int64)
    return shared[:left, right]


def _verified(blocks: DataFrame, threshold: float) -> DataFrame:
    """row, root, n_links per member and pair of blocks."""
    ratio = Fraction(threshold).limit_denominator(10_000)
    p, q = ratio.numerator, ratio.denominator

    def run(batches):
        for table in _whole_groups(batches, "block"):
            block = table.column("block").to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])).tolist()
            rows, roots, links = [], [], []
            for a, b in zip(cuts, [*cuts[1:], len(block)], strict=True):
                made = _verify(table.slice(a, b - a), p, q)
                for out, values in zip((rows, roots, links), made, strict=True):
                    out.append(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x)) for x in (rows, roots, links)],
                names=["row", "root", "n_links"],
            )
        give_back()

    return blocks.repartition("block").sortWithinPartitions("block", "side", "row").mapInArrow(
        run, "row bigint, root bigint, n_links bigint"
    )


def _verify(table: pa.Table, p: int, q: int):
    """Rows, roots and links of one pair of blocks; the second side is empty for one block."""
    rows = table.column("row").to_numpy()
    side = table.column("side").to_numpy()
    copies = table.column("copies").to_numpy()
    once = np.concatenate([[True], (rows[1:] != rows[:-1]) | (side[1:] != side[:-1])])
    keep = np.flatnonzero(once)  # repeated input rows bring a set more than once
    rows, side, copies = rows[keep], side[keep], copies[keep]
    packed = table.column("grams").to_pylist()
    sets = [np.frombuffer(packed[i], np.uint64) for i in keep.tolist()]
    sizes = np.array([len(s) for s in sets])
    m = len(rows)
    left = int((side == 0).sum())
    one_block = table.column("alone")[0].as_py()
    if not one_block and (left == 0 or left == m):
        return rows, rows, np.zeros(m, np.int64)
    shared = _shared_counts(sets, m if one_block else left)
    first = np.arange(m if one_block else left)
    second = first if one_block else np.arange(left, m)
    # shared / (a + b - shared) >= p / q, in whole numbers
    linked = shared * (p + q) >= p * (sizes[first][:, None] + sizes[second][None, :])
    links = np.zeros(m, np.int64)
    if one_block:
        np.fill_diagonal(linked, False)
        links = linked @ copies
    else:
        links[first] = linked @ copies[second]
        links[second] = copies[first] @ linked
    i, j = np.nonzero(linked)
    root = _roots(first[i], second[j], m)
    return rows, rows[root], links


def near_duplicates(
    docs: DataFrame, *, threshold: float = 0.8, n: int = 5, recall: float = 0.9999
) -> DataFrame:
    """row, doc_id, text_hash, class_id, class_row and n_links of every row of ``docs``."""
    bands, rows = choose_bands(threshold, recall)
    signed, _ = store(_signed(docs, n, bands, rows))
    reps, _ = store(
        signed.where("set_id IS NOT NULL")
        .groupBy("set_id")
        .agg(
            F.min("row").alias("row"),
            F.count(F.lit(1)).alias("copies"),
            F.min(F.struct("doc_id", "text_hash", "n_grams")).alias("of"),
        )
    )
    # Sketch values agree by chance in one of 256 cases.
    alike = threshold + (1 - threshold) / 256
    least_alike = math.floor(SKETCH * alike - 5 * math.sqrt(SKETCH * alike * (1 - alike)))
    clusters = connected(_candidate_edges(signed, reps, least_alike))
    # The full sets are made again from the texts of the representatives in clusters.
    placed = reps.join(clusters, F.col("row") == F.col("node")).select(
        "row", "copies", "of.*", F.col("root").alias("cluster"), "set_id"
    )
    sizes = placed.groupBy("cluster").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / BLOCK_MEMBERS), F.ceil(F.sum("n_grams") / BLOCK_GRAMS)
        ).alias("blocks")
    )
    placed, _ = store(placed.join(sizes, "cluster"))
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        F.col("text").cast("string").alias("text"),
    )
    same = (F.coalesce(texts["doc_id"], F.lit(-(1 << 63))) == F.coalesce(
        placed["doc_id"], F.lit(-(1 << 63)))) & (texts["text_hash"] == placed["text_hash"])
    found = texts.join(placed.hint("merge"), same).select("row", "copies", "cluster", "blocks", "set_id", "text")
    verified, _ = store(_verified(_in_blocks(found, n), threshold))
    links = verified.groupBy("row").agg(F.sum("n_links").alias("n_links"))
    roots = connected(verified.select(F.col("row").alias("a"), F.col("root").alias("b")))
    known = (
        reps.join(links, "row", "left")
        .join(roots.withColumnRenamed("node", "row"), "row", "left")
        .select(
            "set_id",
            (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "row").alias("class_row"),
            F.col("of.doc_id").alias("least_id"),
        )
    )
    classes = known.groupBy("class_row").agg(F.min("least_id").alias("class_id"))
    known = known.join(classes, "class_row").drop("least_id")
    out = signed.select("row", "doc_id", "text_hash", "set_id").join(known, "set_id", "left")
    return out.select(
        "row",
        "doc_id",
        "text_hash",
        F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_row", "row").alias("class_row"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
    )


def _in_blocks(found: DataFrame, n: int) -> DataFrame:
    """One row per member and pair of blocks it is in, with its full set."""
    schema = "row bigint, copies bigint, cluster bigint, blocks bigint, grams binary"

    def run(batches):
        for batch in batches:
            for part in text_chunks(batch, size=_AT_ONCE):
                sets = gram_sets(_bytes(part.column("text")), n)
                ids = part.column("set_id").to_pylist()
                # Another text with the same id and hash is no member.
                own = [i for i, s in enumerate(sets) if _fingerprint(s) == ids[i]]
                take = pa.array(own, pa.int64())
                columns = [part.column(c).take(take) for c in ("row", "copies", "cluster", "blocks")]
                columns.append(pa.array([sets[i].tobytes() for i in own], pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    columns, names=["row", "copies", "cluster", "blocks", "grams"]
                )
        give_back()

    sets = found.mapInArrow(run, schema)
    own = F.pmod(F.xxhash64("row"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    paired = sets.withColumn("_own", own).select("*", other.alias("_other"))
    return paired.select(
        "row",
        "copies",
        "grams",
        F.xxhash64(
            "cluster", F.least("_own", "_other"), F.greatest("_own", "_other")
        ).alias("block"),
        (F.col("_own") > F.col("_other")).cast("int").alias("side"),
        (F.col("_own") == F.col("_other")).alias("alone"),
    )


def duplicate_digest(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, n_links of every document."""
    return near_duplicates(docs).select("doc_id", "class_id", "n_links")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each class: the one with the least doc_id."""
    found, _ = store(near_duplicates(docs, **options))
    chosen = found.groupBy("class_row").agg(
        F.min_by("row", F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("row")
    )
    repeated = found.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL")
    if not repeated.limit(1).count():
        gone = found.join(chosen, "row", "left_anti").select("doc_id")
        return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    # Ids do not tell rows apart: those of a kept id and text are numbered, and the first stays.
    stay = found.join(chosen, "row", "left_semi").select(
        F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash")
    )
    stay = stay.groupBy("kept_id", "kept_hash").agg(F.count(F.lit(1)).alias("most"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"),
        F.col("doc_id").cast("bigint").alias("id"),
        F.xxhash64(F.col("text").cast("string")).alias("hash"),
    )
    same = Window.partitionBy("id", "hash").orderBy("id")
    rows = rows.withColumn("number", F.row_number().over(same))
    on = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("hash") == F.col("kept_hash"))
    return rows.join(stay, on).where("number <= most").select("own.*")

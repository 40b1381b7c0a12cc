"""Near-duplicates by one-permutation hashing: word 3-grams with a Jaccard similarity of 0.85 or more.

1. A text becomes the set of its hashed shingles. One hash a shingle serves twice: its upper
   bits name one of ``bins`` bins, and the least hash of a bin is its value. Empty bins are
   densified optimally: each takes the value of a full bin picked by a random walk of its own,
   the same for all texts, so that bins agree with the probability of the similarity.
   Texts with the same set are one representative from here on.
2. Bands of bins are hashed; representatives meet in a shuffle on them. The least member of a
   bucket is its hub and every other member has one edge, to the hub: a star, so a bucket
   of n members gives n - 1 pairs. Counts and hubs are pre-aggregated, and the join back is
   one whose hot buckets adaptive execution splits.
3. Star edges are confirmed on the full sets: first the one edge of each member whose hub it
   shares most bands with, then the others between parts that did not hang together yet.
4. A star proves nothing about two members that both miss the hub. Where the members of a
   candidate cluster (stars that touch) are still in several parts, all pairs between
   different parts are verified in blocks of bounded size; the largest part is not compared
   with itself.

So a link is lost only if no chain of buckets joins its two ends. Band and row counts are
chosen for that: a miss at the threshold has a probability of ``1 - recall``.

Texts of fewer than ``n`` words are one shingle, of all their words. NULL texts and texts
without words have no shingle and are linked with nothing. Repeated rows are copies of each
other. A row without id takes part; its component has the least id there is, or NULL. An
empty table gives no rows. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftgauge.checkpoints import store
from shiftgauge.llm.components import connected
from shiftgauge.llm.jaccard import BLOCK_GRAMS, BLOCK_MEMBERS, _verified, choose_bands
from shiftgauge.llm.rows import give_back, text_chunks
from shiftgauge.llm.word_runs import byte_kinds, words_in
from shiftgauge.operators.sizing import broadcast_if_small

_KINDS = byte_kinds(b" \t\n\x0b\x0c\r")
_AT_ONCE = 2 << 20  # bytes of text
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted, distinct shingle hashes of all texts, and the offsets of each text's own."""
    words = words_in(texts, _KINDS)
    different = words.dictionary.cast(pa.large_binary()).to_pylist()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, different), np.uint64, len(different))
    hashes = hashes[words.codes]
    counts = np.bincount(words.rows, minlength=len(texts))
    firsts = np.cumsum(counts) - counts

    def joined(starts: np.ndarray, size: int) -> np.ndarray:
        made = np.full(len(starts), size, np.uint64)
        for k in range(size):
            made = _mix(made * _ODD + hashes[starts + k])
        return made

    at = np.arange(max(0, len(hashes) - n + 1))
    at = at[words.rows[at] == words.rows[at + n - 1]]
    values, rows = [joined(at, n)], [words.rows[at]]
    for size in range(1, n):
        short = np.flatnonzero(counts == size)
        values.append(joined(firsts[short], size))
        rows.append(short)
    values, rows = np.concatenate(values), np.concatenate(rows)
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    if len(values):
        new = np.concatenate([[True], (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])])
        values, rows = values[new], rows[new]
    return values, np.searchsorted(rows, np.arange(len(texts) + 1))


class OnePermutation:
    """Densified bins and band hashes of sets."""

    def __init__(self, bins: int, bands: int, rows: int):
        if bins & (bins - 1) or bins < 2:
            raise ValueError("bins must be a power of two")
        rng = np.random.default_rng(850_317)
        self.bins, self.bands, self.rows = bins, bands, rows
        self.shift = np.uint64(64 - (bins.bit_length() - 1))
        # Walk of a bin: start + t * step. An odd step visits all bins within ``bins`` steps.
        self.start = rng.integers(0, bins, bins)
        self.step = rng.integers(0, bins // 2, bins) * 2 + 1
        # The bins of a band are dealt at random.
        self.dealt = rng.permutation(bins)[: bands * rows]
        self.weights = rng.integers(0, 1 << 63, rows, np.uint64) * np.uint64(2) + np.uint64(1)

    def densified(self, values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """texts x bins: the least hash of each bin, empty ones filled; rows of empty sets stay 0."""
        n = len(offsets) - 1
        out = np.zeros((n, self.bins), np.uint64)
        full = np.zeros((n, self.bins), bool)
        rows = np.repeat(np.arange(n), np.diff(offsets))
        place = rows * self.bins + (values >> self.shift).astype(np.int64)
        # Sets are sorted, so the first hash of a bin is its least.
        first = np.flatnonzero(np.diff(place, prepend=-1))
        out.ravel()[place[first]] = values[first]
        full.ravel()[place[first]] = True
        row, empty = np.nonzero(~full & (np.diff(offsets) > 0)[:, None])
        for t in range(self.bins):
            if not len(row):
                break
            source = (self.start[empty] + t * self.step[empty]) % self.bins
            hit = full[row, source]
            out[row[hit], empty[hit]] = out[row[hit], source[hit]]
            row, empty = row[~hit], empty[~hit]
        return out

    def band_hashes(self, values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """texts x bands."""
        used = self.densified(values, offsets)[:, self.dealt]
        used = _mix(used).reshape(len(used), self.bands, self.rows)
        own = np.arange(self.bands, dtype=np.uint64) * _ODD
        return _mix((used * self.weights).sum(axis=2, dtype=np.uint64) + own).view(np.int64)


def _fingerprint(own: np.ndarray) -> bytes | None:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None


def _signed(docs: DataFrame, n: int, bins: int, bands: int, rows: int) -> DataFrame:
    """row, doc_id, text_hash, set_id, n_shingles and band hashes of every document."""
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        F.col("text").cast("string").alias("text"),
    )

    def run(batches):
        hasher = OnePermutation(bins, bands, rows)
        for batch in batches:
            for part in text_chunks(batch, size=_AT_ONCE):
                values, offsets = shingle_sets(part.column("text"), n)
                sizes = np.diff(offsets)
                keys = hasher.band_hashes(values, offsets)[sizes > 0]
                cuts = np.concatenate([[0], np.cumsum((sizes > 0) * bands)]).astype(np.int32)
                own = [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        part.column("doc_id"),
                        part.column("text_hash"),
                        pa.array([_fingerprint(s) for s in own], pa.binary()),
                        pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(cuts), pa.array(keys.ravel())),
                    ],
                    names=["row", "doc_id", "text_hash", "set_id", "n_shingles", "bands"],
                )
        give_back()

    return texts.mapInArrow(
        run,
        "row bigint, doc_id bigint, text_hash bigint, set_id binary, n_shingles bigint,"
        " bands array<bigint>",
    )


def _stars(signed: DataFrame, reps: DataFrame) -> DataFrame:
    """a, hub, shared: members of buckets, the hub of the bucket and the bands they share."""
    # Both sides of these joins grow with the corpus, so neither is ever broadcast.
    own = signed.select("row", "bands").join(reps.select("row").hint("merge"), "row")
    members = own.select("row", F.explode("bands").alias("key"))
    buckets = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("hub"))
    met = members.join(buckets.where("n > 1").hint("merge"), "key").where("row <> hub")
    return met.groupBy(F.col("row").alias("a"), "hub").agg(F.count(F.lit(1)).alias("shared"))


def _sets_of(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """row and shingles of the representatives ``wanted`` (row, set_id, text_hash).

    The texts are read again, as most documents are in no bucket: if the wanted hashes fit a
    broadcast, no other text is shuffled. A task makes a repeated text into a set only once.
    """
    hashes = wanted.select("text_hash").distinct()
    texts = docs.select(
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        F.col("text").cast("string").alias("text"),
    )
    found = texts.join(broadcast_if_small(hashes), "text_hash", "left_semi")

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for part in text_chunks(batch, size=_AT_ONCE):
                new = []
                for i, text_hash in enumerate(part.column("text_hash").to_pylist()):
                    if text_hash not in seen:
                        seen.add(text_hash)
                        new.append(i)
                if not new:
                    continue
                values, offsets = shingle_sets(part.column("text").take(pa.array(new)), n)
                own = [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([_fingerprint(s) for s in own], pa.binary()),
                        pa.ListArray.from_arrays(
                            pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64))
                        ),
                    ],
                    names=["set_id", "shingles"],
                )
        give_back()

    sets = found.mapInArrow(run, "set_id binary, shingles array<bigint>")
    # Another text with a wanted hash is no representative: the sets' own fingerprints decide.
    own = sets.join(wanted.select("row", "set_id").hint("merge"), "set_id")
    return own.select("row", "shingles").dropDuplicates(["row"])


def _confirmed(edges: DataFrame, sets: DataFrame, p: int, q: int) -> DataFrame:
    """The edges (a, hub) whose sets reach p / q."""
    one = sets.select(F.col("row").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("row").alias("hub"), F.col("shingles").alias("y"))
    both = edges.select("a", "hub").join(one.hint("merge"), "a").join(two.hint("merge"), "hub")
    shared = F.size(F.array_intersect("x", "y")).cast("bigint")
    union = F.size("x") + F.size("y") - shared
    return both.where(shared * q >= union * p).select("a", F.col("hub").alias("b"))


def _between_parts(placed: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links between the parts of clusters that have more than one; placed: row, cluster, part, n.

    The members of a cluster's largest part are dealt into blocks 0 to M - 1, the others into M
    to M + S - 1. Every pair of blocks but those within the largest part is a group.
    """
    blocks = lambda n, grams: F.ceil(
        F.greatest(F.col(n) / BLOCK_MEMBERS, F.col(grams) / BLOCK_GRAMS)
    )
    parts = placed.groupBy("cluster", "part").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("grams")
    )
    clusters = parts.groupBy("cluster").agg(
        F.max_by("part", F.struct("n", F.negate("part"))).alias("main"),
        F.max_by("grams", F.struct("n", F.negate("part"))).alias("main_grams"),
        F.max("n").alias("main_n"),
        F.sum("n").alias("n"),
        F.sum("grams").alias("grams"),
        F.count(F.lit(1)).alias("parts"),
    )
    open_clusters = clusters.where("parts > 1").select(
        "cluster",
        "main",
        blocks("main_n", "main_grams").alias("m"),
        F.ceil(
            F.greatest(
                (F.col("n") - F.col("main_n")) / BLOCK_MEMBERS,
                (F.col("grams") - F.col("main_grams")) / BLOCK_GRAMS,
            )
        ).alias("s"),
    )
    members = placed.join(open_clusters, "cluster").join(sets.hint("merge"), "row")
    in_main = F.col("part") == F.col("main")
    own = F.when(in_main, F.pmod(F.xxhash64("row"), F.col("m"))).otherwise(
        F.col("m") + F.pmod(F.xxhash64("row"), F.col("s"))
    )
    others = F.sequence(F.when(in_main, F.col("m")).otherwise(0), F.col("m") + F.col("s") - 1)
    dealt = members.select("row", "cluster", "shingles", own.alias("_own"), F.explode(others).alias("_other"))

    def packed(batches):
        for batch in batches:
            grams = [np.array(x, np.int64).tobytes() for x in batch.column("shingles").to_numpy(zero_copy_only=False)]
            kept = [batch.column(c) for c in ("row", "cluster", "_own", "_other")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(grams, pa.binary())], names=["row", "cluster", "_own", "_other", "grams"]
            )

    dealt = dealt.mapInArrow(packed, "row bigint, cluster bigint, _own bigint, _other bigint, grams binary")
    groups = dealt.select(
        "row",
        F.lit(1).cast("bigint").alias("copies"),
        "grams",
        F.xxhash64("cluster", F.least("_own", "_other"), F.greatest("_own", "_other")).alias("block"),
        (F.col("_own") > F.col("_other")).cast("int").alias("side"),
        (F.col("_own") == F.col("_other")).alias("alone"),
    )
    found = _verified(groups, threshold)
    return found.where("row <> root").select(F.col("row").alias("a"), F.col("root").alias("b")).distinct()


def components(
    docs: DataFrame,
    *,
    threshold: float = 0.85,
    n: int = 3,
    bins: int = 256,
    recall: float = 0.9999999,
) -> DataFrame:
    """row, doc_id, n_shingles, component_id and component_row of every row of ``docs``."""
    ratio = Fraction(threshold).limit_denominator(10_000)
    p, q = ratio.numerator, ratio.denominator
    bands, rows = choose_bands(threshold, recall, bins)
    signed, _ = store(_signed(docs, n, bins, bands, rows))
    reps, _ = store(
        signed.where("set_id IS NOT NULL")
        .groupBy("set_id")
        .agg(F.min("row").alias("row"), F.min("doc_id").alias("least_id"))
    )
    stars, seen = store(_stars(signed, reps), n=F.count(F.lit(1)))
    roots = _linked(docs, signed, stars, threshold, n, p, q) if seen["n"] else None
    known = reps
    if roots is not None:
        known = known.join(roots, "row", "left")
    else:
        known = known.withColumn("root", F.col("row"))
    known = known.select("set_id", F.coalesce("root", "row").alias("component_row"), "least_id")
    least = known.groupBy("component_row").agg(F.min("least_id").alias("component_id"))
    known = known.drop("least_id").join(least, "component_row")
    own = signed.select("row", "doc_id", "n_shingles", "set_id")
    columns = ["row", "doc_id", "n_shingles", "component_id", "component_row"]
    alone = own.where("set_id IS NULL").withColumns(
        {"component_id": F.col("doc_id"), "component_row": F.col("row")}
    )
    return own.join(known, "set_id").select(columns).union(alone.select(columns))


def _linked(docs, signed, stars, threshold, n, p, q) -> DataFrame:
    """row, root for the representatives that are linked with others."""
    clusters = connected(stars.select("a", F.col("hub").alias("b")))
    clusters = clusters.select(F.col("node").alias("row"), F.col("root").alias("cluster"))
    wanted, _ = store(
        signed.select("row", "set_id", "text_hash", "n_shingles").join(clusters.hint("merge"), "row")
    )
    sets, _ = store(_sets_of(docs, wanted, n))
    best = stars.groupBy("a").agg(F.max_by("hub", F.struct("shared", F.negate("hub"))).alias("hub"))
    links, _ = store(_confirmed(best, sets, p, q))
    parts = _part_of(wanted, connected(links))
    ends = lambda name: parts.select(F.col("row").alias(name), F.col("part").alias(f"{name}_part"))
    rest = stars.join(ends("a"), "a").join(ends("hub"), "hub").where("a_part <> hub_part")
    more, _ = store(_confirmed(rest, sets, p, q))
    links = links.union(more)
    parts = _part_of(wanted, connected(links))
    last, _ = store(_between_parts(parts, sets, threshold))
    return connected(links.union(last)).select(F.col("node").alias("row"), "root")


def _part_of(wanted: DataFrame, roots: DataFrame) -> DataFrame:
    """row, cluster, n_shingles, part: what it hangs together with by confirmed links."""
    roots = roots.select(F.col("node").alias("row"), "root")
    found = wanted.join(roots, "row", "left")
    return found.select("row", "cluster", "n_shingles", F.coalesce("root", "row").alias("part"))


def component_digest(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document.

    Of a component all of whose rows have no id, all rows are kept: nothing tells them apart.
    """
    found = components(docs, **options)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))

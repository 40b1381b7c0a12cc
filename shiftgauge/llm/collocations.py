"""Phrase collocations per language, counted by multikey quicksort of suffix pointers.

1. *Heads.* Every word of a piece starts a suffix; its head is the first ``max_words`` words,
   fewer at the end of a piece. A task counts equal heads of a slice of texts before anything
   is shuffled, so a repeated line is one head a slice.
2. *Routing.* Heads go to tasks by their leading word; those of one slice for one task travel in
   one row. Hot leading words are routed by two words, hot pairs by three: a hot word is spread,
   and still every longer phrase is whole in one task. A first pass finds them: a prefix is hot
   if the slices in which it has more than 1/``SHARE`` of the words hold more than 1/``SHARE`` of
   all words in it. So fewer than ``SHARE`` prefixes of a length are hot, and others have less
   than 2/``SHARE`` of all words. The counts of hot prefixes are summed from their parts.
3. *Sorting.* A task sorts pointers to its heads by three-way partitions: less than, equal to
   and greater than a pivot word. The size of an equal partition is the count of the phrase so
   far; it goes on one word deeper, the others at the same depth. A partition with fewer than
   ``least`` occurrences is abandoned at once: no phrase in it can reach ``least``. All open
   partitions of a task are split together, in numpy.
4. What is left, the phrases of ``least`` occurrences, is scored by joins on first part and rest.

Words are what stands between spaces and tabs, pieces end at ``.,;:!?`` and line ends. NULL
text is empty, NULL language is ``und`` (and one with a language of that name). Repeated rows
count repeatedly. Equal scores are ranked by count, then phrase. An empty table, or one
without frequent phrases, gives no rows. Only ``text`` and ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftgauge.checkpoints import store
from shiftgauge.llm.rows import give_back, text_chunks
from shiftgauge.llm.word_runs import byte_kinds, words_in
from shiftgauge.operators.numbering import number_rows
from shiftgauge.operators.sizing import broadcast_if_small

_KINDS = byte_kinds(b" \t", b".,;:!?\n\x0b\x0c\r")
_AT_ONCE = 8 << 20  # bytes of text counted together
_ROW_HEADS = 1 << 16
_SPACE, _LINE = pa.scalar(" ", pa.large_string()), pa.scalar("\n", pa.large_string())
SHARE = 1000
HEADS_PER_TASK = 2_000_000


# --- heads -------------------------------------------------------------------------


class Slice:
    """The heads of some texts, as numbers into their words and languages."""

    def __init__(self, part: pa.RecordBatch, max_words: int):
        langs = part.column("lang").dictionary_encode()
        words = words_in(part.column("text"), _KINDS)
        self.langs, self.words = langs.dictionary, words.dictionary
        m = len(words.codes)
        # Language, then the words of the head from 1, 0 where it ends.
        self.heads = np.zeros((m, 1 + max_words), np.int64)
        self.heads[:, 0] = langs.indices.to_numpy()[words.rows]
        for k in range(max_words):
            here = max(0, m - k)
            same = words.pieces[:here] == words.pieces[k:]
            self.heads[:here, 1 + k] = np.where(same, words.codes[k:] + 1, 0)
        self.sizes = [len(self.langs), *[len(self.words) + 1] * max_words]

    def distinct(self, rows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The different prefixes of ``length`` words of ``rows``, in order, and their counts."""
        key, size = np.zeros(len(rows), np.int64), 1
        for column, most in zip(rows.T[: 1 + length], self.sizes, strict=False):
            if size * most >= 1 << 62:
                done, key = np.unique(key, return_inverse=True)
                size = len(done) + 1
            key = key * most + column
            size *= most
        _, first, counts = np.unique(key, return_index=True, return_counts=True)
        return rows[first], counts

    def numbers(self, hot: list[tuple]) -> np.ndarray:
        """Prefixes (lang, w1, ...) as rows of heads; those with words of other slices are left out."""
        columns = [
            pc.index_in(pa.array(c, pa.large_string()), kinds).to_numpy(zero_copy_only=False)
            for c, kinds in zip(
                zip(*hot, strict=True), [self.langs, *[self.words] * len(self.sizes)], strict=False
            )
        ]
        found = np.column_stack(columns) if columns else np.zeros((0, 1))
        found = found[~np.isnan(found).any(axis=1)].astype(np.int64)
        found[:, 1:] += 1
        return found

    def among(self, rows: np.ndarray, prefixes: np.ndarray) -> np.ndarray:
        """Which rows start with one of the prefixes."""
        if not len(prefixes):
            return np.zeros(len(rows), bool)
        length = prefixes.shape[1]
        both = np.vstack([rows[:, :length], prefixes])
        key, size = both[:, 0], self.sizes[0]
        for column, most in zip(both.T[1:], self.sizes[1:], strict=False):
            if size * most >= 1 << 62:
                done, key = np.unique(key, return_inverse=True)
                size = len(done) + 1
            key = key * most + column
            size *= most
        return np.isin(key[: len(rows)], key[len(rows) :])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.col("text").cast("string").alias("text"),
    )


def _slices(batches: Iterator[pa.RecordBatch], max_words: int) -> Iterator[Slice]:
    """Slices of about ``_AT_ONCE`` bytes of text, over the borders of the batches."""

    def joined(held: list[pa.RecordBatch]) -> Slice:
        table = pa.Table.from_batches(held)
        columns = [pa.concat_arrays(c.cast(pa.large_string()).chunks) for c in table.columns]
        return Slice(pa.RecordBatch.from_arrays(columns, names=table.column_names), max_words)

    held, size = [], 0
    for batch in batches:
        for part in text_chunks(batch, size=_AT_ONCE):
            held.append(part)
            size += part.nbytes
            if size >= _AT_ONCE:
                yield joined(held)
                held, size = [], 0
    if held:
        yield joined(held)


def _names(max_words: int) -> list[str]:
    return [f"w{k}" for k in range(1, max_words + 1)]


def _spelled(own: Slice, rows: np.ndarray, length: int) -> list[pa.Array]:
    """The columns of ``rows`` as strings: language, then ``length`` words, NULL past the end."""
    columns = [own.langs.take(pa.array(rows[:, 0]))]
    for k in range(1, length + 1):
        columns.append(own.words.take(pa.array(rows[:, k] - 1, mask=rows[:, k] == 0)))
    return columns


def _heavy(docs: DataFrame, max_words: int) -> DataFrame:
    """lang, w1, w2, ... and n: prefixes with a large share of a slice; w1 NULL: all its words."""
    names = _names(max_words - 1)

    def run(batches):
        for own in _slices(batches, max_words):
            rows = own.heads
            for length in range(max_words):
                found, counts = own.distinct(rows, length)
                if length:
                    large = counts * SHARE > len(own.heads)
                    found, counts = found[large & (found[:, length] > 0)], counts[large & (found[:, length] > 0)]
                    rows = rows[own.among(rows, found[:, : 1 + length])]
                columns = _spelled(own, found, length)
                columns += [pa.nulls(len(found), pa.large_string())] * (max_words - 1 - length)
                columns = [c.cast(pa.string()) for c in columns]
                columns.append(pa.array(counts, pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, names=["lang", *names, "n"])
        give_back()

    kinds = ", ".join(f"{w} string" for w in names)
    found = _texts(docs).mapInArrow(run, f"lang string, {kinds}, n bigint")
    return found.groupBy("lang", *names).agg(F.sum("n").alias("n"))


def _routed(docs: DataFrame, max_words: int, tasks: int, hot) -> DataFrame:
    """task, lang, level, heads and n: the heads of a slice for a task, one a line, and their counts.

    ``level`` is the length of the hot prefix the heads have; they are routed by one word more.
    """

    def run(batches):
        for own in _slices(batches, max_words):
            heads, counts = own.distinct(own.heads, max_words)
            if not len(heads):
                continue
            level = np.zeros(len(heads), np.int64)
            for length, prefixes in enumerate(hot.value, 1):
                level[own.among(heads, own.numbers(prefixes))] = length
            hashes = lambda kinds: np.fromiter(
                map(xxhash.xxh3_64_intdigest, kinds.cast(pa.large_binary()).to_pylist()), np.uint64, len(kinds)
            )
            route = hashes(own.langs)[heads[:, 0]]
            words = np.append(np.zeros(1, np.uint64), hashes(own.words))
            for k in range(1, max_words + 1):
                step = (route ^ (route >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + words[heads[:, k]]
                route = np.where(level >= k - 1, step, route)
            route = (route ^ (route >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
            task = ((route >> np.uint64(16)) % np.uint64(tasks)).astype(np.int64)
            group = (task * len(own.langs) + heads[:, 0]) * max_words + level
            order = np.argsort(group, kind="stable")
            group, heads, counts = group[order], heads[order], counts[order]
            lines = pc.binary_join_element_wise(*_spelled(own, heads, max_words)[1:], _SPACE, null_handling="skip")
            new = np.flatnonzero(np.diff(group, prepend=-1))
            new = np.union1d(new, np.arange(0, len(heads), _ROW_HEADS))
            ends = np.append(new, len(heads))
            joined = pc.binary_join(pa.LargeListArray.from_arrays(ends, lines), _LINE)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(group[new] // (len(own.langs) * max_words), pa.int32()),
                    own.langs.take(pa.array(heads[new, 0])).cast(pa.string()),
                    pa.array(group[new] % max_words, pa.int32()),
                    joined.cast(pa.string()),
                    pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(counts, pa.int64())),
                ],
                names=["task", "lang", "level", "heads", "n"],
            )
        give_back()

    rows = _texts(docs).mapInArrow(run, "task int, lang string, level int, heads string, n array<bigint>")
    return rows.repartitionById(tasks, F.col("task"))


# --- sorting -----------------------------------------------------------------------


def frequent_prefixes(
    keys: np.ndarray, weights: np.ndarray, least: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefixes of the rows of ``keys`` whose weights sum to ``least`` or more.

    Three-way partitions from the first column to the last, -1 ending a row. Returns a row with
    the prefix, its length and its weight.
    """
    last = keys.shape[1]
    pointers = np.arange(len(keys))
    lengths, depths = np.array([len(keys)])[: len(keys)], np.zeros(min(1, len(keys)), np.int64)
    found = []
    while len(lengths):
        starts = np.cumsum(lengths) - lengths
        pivots = pointers[starts + lengths // 2]
        pivot = keys[pivots, depths]
        part = np.repeat(np.arange(len(lengths)), lengths)
        side = np.sign(keys[pointers, depths[part]] - pivot[part]) + 1
        split = 3 * part + side
        counts = np.bincount(split, minlength=3 * len(lengths)).reshape(-1, 3)
        # Sums of whole numbers below 2^53, so exact.
        sizes = np.bincount(split, weights[pointers], 3 * len(lengths)).astype(np.int64)
        sizes = sizes.reshape(-1, 3)
        kept = (sizes >= least) & (counts > 0)
        kept[:, 1] &= pivot >= 0
        equal = np.flatnonzero(kept[:, 1])
        found.append((pivots[equal], depths[equal] + 1, sizes[equal, 1]))
        kept[:, 1] &= depths + 1 < last
        counts = np.where(kept, counts, 0)
        ends = np.cumsum(counts.ravel()).reshape(-1, 3)
        moved = np.empty(ends[-1, -1], np.int64)
        for s in range(3):
            own = np.flatnonzero((side == s) & kept[part, s])
            of = part[own]
            rank = np.arange(len(own)) - (np.cumsum(counts[:, s]) - counts[:, s])[of]
            moved[(ends[:, s] - counts[:, s])[of] + rank] = pointers[own]
        pointers = moved
        deeper = depths[:, None] + np.array([0, 1, 0])
        lengths, depths = counts[kept], deeper[kept]
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _sorted_counts(routed: DataFrame, max_words: int, least: int) -> DataFrame:
    """lang, w1, w2, ..., a, whole: frequent phrases of each task, and its parts of hot prefixes."""
    names = _names(max_words)

    def run(batches):
        held = [batch for batch in batches if batch.num_rows]
        if held:
            yield from _count_table(pa.Table.from_batches(held), names, least)
        give_back()

    kinds = ", ".join(f"{w} string" for w in names)
    return routed.mapInArrow(run, f"lang string, {kinds}, a bigint, whole boolean")


def _count_table(table: pa.Table, names: list[str], least: int) -> Iterator[pa.RecordBatch]:
    langs = table.column("lang").combine_chunks().dictionary_encode()
    lines = pc.split_pattern(pa.concat_arrays(table.column("heads").cast(pa.large_string()).chunks), "\n")
    in_row = np.diff(lines.offsets.to_numpy())
    split = pc.split_pattern(lines.flatten(), " ")
    words = split.flatten().dictionary_encode()
    starts = split.offsets.to_numpy()
    codes = np.append(words.indices.to_numpy(), np.full(len(names), -1))
    keys = np.full((len(starts) - 1, 1 + len(names)), -1, np.int32)
    keys[:, 0] = np.repeat(langs.indices.to_numpy(), in_row)
    for k in range(len(names)):
        at = starts[:-1] + k
        keys[:, 1 + k] = np.where(at < starts[1:], codes[at], -1)
    weights = np.concatenate([c.flatten().to_numpy() for c in table.column("n").chunks])
    level = np.repeat(table.column("level").to_numpy(), in_row)

    def spelled(rows: np.ndarray, lengths: np.ndarray, sizes: np.ndarray, whole: bool):
        for at in range(0, len(rows), _ROW_HEADS):
            own, length = rows[at : at + _ROW_HEADS], lengths[at : at + _ROW_HEADS]
            columns = [langs.dictionary.take(pa.array(keys[own, 0]))]
            for k in range(1, len(names) + 1):
                code = pa.array(keys[own, k], mask=length < k)
                columns.append(words.dictionary.take(code).cast(pa.string()))
            columns.append(pa.array(sizes[at : at + _ROW_HEADS], pa.int64()))
            columns.append(pa.array(np.full(len(own), whole)))
            yield pa.RecordBatch.from_arrays(columns, names=["lang", *names, "a", "whole"])

    rows, lengths, sizes = frequent_prefixes(keys, weights, least)
    # The first key is the language. Hot prefixes are not whole here: their parts follow.
    own = np.flatnonzero((lengths > 1) & (lengths - 1 > level[rows]))
    yield from spelled(rows[own], lengths[own] - 1, sizes[own], True)
    for length in range(1, len(names)):
        hot = np.flatnonzero(level >= length)
        if not len(hot):
            break
        _, first, of = np.unique(keys[hot, : 1 + length], axis=0, return_index=True, return_inverse=True)
        parts = np.bincount(of.ravel(), weights[hot]).astype(np.int64)
        yield from spelled(hot[first], np.full(len(first), length), parts, False)


def frequent_phrases(docs: DataFrame, max_words: int, least: int) -> tuple[DataFrame, DataFrame]:
    """(lang, w1, ..., a) of phrases with ``least`` occurrences, and (lang, n) of all words."""
    spark = docs.sparkSession
    names = _names(max_words)
    heavy, _ = store(_heavy(docs, max_words))
    totals = heavy.where(F.col(names[0]).isNull()).select("lang", "n")
    total = totals.agg(F.sum("n")).first()[0] or 0
    hot: list[list[tuple]] = [[] for _ in names[1:]]
    # Fewer than SHARE rows of each length, by their very condition.
    for row in heavy.where((F.col("n") * SHARE > total) & F.col(names[0]).isNotNull()).collect():
        prefix = tuple(x for x in row[:-1] if x is not None)
        hot[len(prefix) - 2].append(prefix)
    # A hot prefix has hot beginnings, since they occur at least as often.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // HEADS_PER_TASK))
    shared = spark.sparkContext.broadcast(hot)
    found, _ = store(_sorted_counts(_routed(docs, max_words, tasks, shared), max_words, least))
    parts = found.where(~F.col("whole")).groupBy("lang", *names).agg(F.sum("a").alias("a"))
    counted = found.where("whole").select("lang", *names, "a").union(
        parts.where(F.col("a") >= least)
    )
    return counted, totals


# --- scores ------------------------------------------------------------------------


def collocations(
    docs: DataFrame,
    *,
    min_words: int = 2,
    max_words: int = 3,
    least: int = 10,
    top: int | None = 2000,
    covered: int = 50,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its lowest-scoring cut, ``n`` all words
    of the language; the score is floor(1000000 a a / (l r)). Phrases inside a longer one that
    has ``covered`` percent of their occurrences are left out. ``top`` None ranks all.
    """
    if not 2 <= min_words <= max_words:
        raise ValueError("phrases have two words at least")
    counted, totals = frequent_phrases(docs, max_words, least)
    words = F.array_compact(F.array(*[f"w{k}" for k in range(1, max_words + 1)]))
    phrases = counted.select("lang", words.alias("words"), "a")
    spaced = lambda column: F.array_join(column, " ")
    known = phrases.select("lang", spaced("words").alias("phrase"), "a")
    candidates = phrases.where(F.size("words") >= min_words)
    cuts = candidates.select(
        "lang", "words", "a", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    ).select(
        "lang",
        spaced("words").alias("phrase"),
        "a",
        "k",
        spaced(F.slice("words", 1, F.col("k"))).alias("first"),
        spaced(F.slice("words", F.col("k") + 1, F.size("words"))).alias("rest"),
    )
    lefts = known.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    rights = known.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    cuts = cuts.join(lefts, ["lang", "first"]).join(rights, ["lang", "rest"])
    # Counts below 10^14: 1000000 a a has 35 digits at most, and the quotient is at most 1000000.
    whole = lambda c: F.col(c).cast("decimal(14,0)")
    cuts = cuts.withColumn("over", F.lit(1_000_000).cast("decimal(7,0)") * whole("a") * whole("a"))
    cuts = cuts.withColumn("under", whole("l") * whole("r"))
    cuts = cuts.withColumn("score", F.expr("`over` div `under`").cast("bigint"))
    scored = cuts.groupBy("lang", "phrase").agg(
        F.max("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    # Contiguous parts of the longer candidates.
    longer = candidates.where(F.size("words") > min_words)
    sizes = F.explode(F.sequence(F.lit(min_words), F.size("words") - 1))
    starts = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1))
    inside = longer.select("lang", "words", "a", sizes.alias("size")).select("*", starts.alias("at"))
    inside = inside.groupBy("lang", spaced(F.slice("words", F.col("at"), F.col("size"))).alias("phrase"))
    inside = inside.agg(F.max("a").alias("longer"))
    own = F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * covered)
    left = scored.join(inside, ["lang", "phrase"], "left").where(own)
    left, _ = store(
        left.select(
            "lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score")
        )
    )
    order = [F.col("lang"), F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    numbered, _ = store(number_rows(left, order))
    firsts = numbered.groupBy("lang").agg(F.min("row_no").alias("first"))
    ranked = numbered.join(broadcast_if_small(firsts.join(totals, "lang")), "lang")
    ranked = ranked.withColumn("rank", F.col("row_no") - F.col("first") + 1)
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

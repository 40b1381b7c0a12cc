"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton accepts every run of words of every item. Training texts stream through it
word by word; it tracks the length of the longest run that ends at each word. A window is
``window`` consecutive words of an item, or a whole item of fewer words; every word inside
an occurrence of a window is hit. Runs of words are found in vectorised form first: where
two neighbouring words never stand together in an item, no run of two words crosses.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased. Texts that are NULL
or empty have no words, items likewise; an empty item table hits nothing. Repeated items count as
the item ids they carry (NULL ids are not counted), repeated documents each give a row.
Of other columns nothing is read.

The items of a shard are broadcast. ``max_words`` bounds a shard; a larger table of items
is dealt over several, each matched in a pass of its own, and the hits are merged.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftgauge.checkpoints import store
from shiftgauge.llm.rows import map_texts, put_back, set_apart, words_of

_FOUND = (
    "n_words bigint, spans array<struct<start:int,end:int>>, items array<string>, longest int"
)


class Matcher:
    """The automaton of some items: [(item id as text or None, words)]."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = 10):
        self.window = window
        self.code: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        self.items: list[set] = [set()]
        short: dict[int, list[tuple[int, str | None]]] = defaultdict(list)
        self.shortest = window
        pairs = set()
        for item, words in items:
            if not words:
                continue
            codes = [self.code.setdefault(w, len(self.code) + 1) for w in words]
            pairs.update(zip(codes, codes[1:], strict=False))
            last, ends = 0, []
            for c in codes:
                last = self._extend(last, c)
                ends.append(last)
            for state in ends[window - 1 :]:
                self.items[state].add(item)
            if len(codes) < window:
                self.shortest = min(self.shortest, len(codes))
                short[last].append((len(codes), item))
        self._spread(short)
        span = len(self.code) + 1
        self._span = span
        self._pairs = np.sort(np.array([a * span + b for a, b in pairs], np.int64))

    def _extend(self, last: int, c: int) -> int:
        """Add a word to the run that ends in ``last`` and return the state of the longer run."""
        known = self.next[last].get(c)
        if known is not None:
            return known if self.size[known] == self.size[last] + 1 else self._split(last, c, known)
        new = self._state({}, -1, self.size[last] + 1)
        p = last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p == -1:
            self.link[new] = 0
        else:
            q = self.next[p][c]
            self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, c, q)
        return new

    def _split(self, p: int, c: int, q: int) -> int:
        twin = self._state(dict(self.next[q]), self.link[q], self.size[p] + 1)
        self.link[q] = twin
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = twin
            p = self.link[p]
        return twin

    def _state(self, edges: dict, link: int, size: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.size.append(size)
        self.items.append(set())
        return len(self.size) - 1

    def _spread(self, short: dict) -> None:
        """A state's runs end wherever those of the states that link to it end."""
        by_size = sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True)
        for state in by_size:
            if self.size[self.link[state]] >= self.window:
                self.items[self.link[state]] |= self.items[state]
        # Whole short items that a state's longest run ends with, by length.
        self.whole: list[list] = [[] for _ in self.size]
        for state in reversed(by_size):
            self.whole[state] = self.whole[self.link[state]] + short.get(state, [])

    def match(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set, int]:
        """Hit spans (start, end exclusive; merged), items with occurring windows, longest run."""
        get, code = self.code.get, self.code
        if not code or len(words) < self.shortest:
            return [], set(), 0
        codes = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        spans: list[list[int]] = []
        items: set = set()
        longest = 0
        for a, b in self._runs(codes):
            state = length = 0
            for i, c in enumerate(codes[a:b].tolist(), a):
                while state and c not in self.next[state]:
                    state = self.link[state]
                    length = self.size[state]
                if c in self.next[state]:
                    state, length = self.next[state][c], length + 1
                hit = 0
                if length >= self.window:
                    hit, s = length, state
                    while self.size[self.link[s]] >= self.window:
                        s = self.link[s]
                    items |= self.items[s]
                for size, item in self.whole[state]:
                    if size <= length:
                        hit = max(hit, size)
                        items.add(item)
                if hit:
                    longest = max(longest, hit)
                    start = i + 1 - hit
                    while spans and start <= spans[-1][0]:
                        spans.pop()
                    if spans and start <= spans[-1][1]:
                        spans[-1][1] = i + 1
                    else:
                        spans.append([start, i + 1])
        return [tuple(s) for s in spans], items - {None}, longest

    def _runs(self, codes: np.ndarray) -> list[tuple[int, int]]:
        """Stretches, long enough for a window, whose neighbours all stand together in an item."""
        if self.shortest == 1:
            joined = (codes[:-1] > 0) & (codes[1:] > 0)
        else:
            pair = codes[:-1] * self._span + codes[1:]
            at = np.searchsorted(self._pairs, pair)
            at[at == len(self._pairs)] = 0
            joined = (self._pairs[at] == pair) if len(self._pairs) else np.zeros(len(pair), bool)
            joined &= (codes[:-1] > 0) & (codes[1:] > 0)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], joined, [False]]).astype(np.int8)))
        runs = [(a, b + 1) for a, b in edges.reshape(-1, 2).tolist()]
        if self.shortest == 1:
            alone = np.flatnonzero(codes > 0).tolist()
            inside = np.zeros(len(codes), bool)
            for a, b in runs:
                inside[a:b] = True
            runs += [(i, i + 1) for i in alone if not inside[i]]
            runs.sort()
        return [(a, b) for a, b in runs if b - a >= self.shortest]


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    *,
    max_words: int = 200_000,
    cut: bool = False,
) -> DataFrame:
    """doc_id, text, n_words, hit spans (words), items and the longest run, per row of ``docs``.

    Other columns of ``docs`` stay; the four columns added replace any of the same name.
    With ``cut`` the texts come without the words of the spans.
    """
    added = ["n_words", "spans", "items", "longest"]
    docs = docs.drop(*added).withColumn("text", F.col("text").cast("string"))
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text")
    )
    words = F.size(F.split(F.coalesce("text", F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    total = items.select(F.sum(words)).first()[0] or 0
    shards = max(1, math.ceil(total / max_words))
    if shards == 1:
        return _matched(docs, [tuple(r) for r in items.collect()], window, cut)
    keyed, _ = store(docs.withColumn("_row", F.monotonically_increasing_id()))
    shard = F.pmod(F.xxhash64("item", "text"), F.lit(shards))
    found = None
    for i in range(shards):
        part = [tuple(r) for r in items.where(shard == i).collect()]  # about ``max_words`` words
        one = _matched(keyed.select("_row", "text"), part, window).drop("text")
        found = one if found is None else found.unionByName(one)
    merged = found.groupBy("_row").agg(
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.max("longest").alias("longest"),
    )
    found = keyed.join(merged.withColumn("spans", _united("spans")), "_row").drop("_row")
    if cut:
        hit = F.size("spans") > 0
        without = F.udf(cut_words, "string")
        made = without(F.when(hit, F.col("text")), F.when(hit, F.col("spans")))
        found = found.withColumn("text", F.coalesce(made, "text"))
    return found


def _matched(docs: DataFrame, items: list[tuple], window: int, cut: bool = False) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def start():
        matcher = Matcher([(i, words_of(t)) for i, t in shared.value], window)

        def one(text):
            words = words_of(text)
            spans, items, longest = matcher.match(words)
            spans = [{"start": a, "end": b} for a, b in spans]
            return (
                cut_words(text, spans) if cut else text,
                len(words),
                spans,
                sorted(items),
                longest,
            )

        return one

    return map_texts(docs, start, f"text string, {_FOUND}")


def _united(spans: str):
    """Sorted spans with overlapping and touching ones joined."""
    kind = "array<struct<start:int,end:int>>"
    return F.aggregate(
        F.array_sort(spans),
        F.array().cast(kind),
        lambda done, s: F.when(
            (F.size(done) > 0) & (s["start"] <= F.element_at(done, -1)["end"]),
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["start"].alias("start"),
                        F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )


def n_hit(spans="spans"):
    return F.aggregate(
        spans, F.lit(0).cast("bigint"), lambda n, s: n + (s["end"] - s["start"]).cast("bigint")
    )


def contamination_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: counts, and a digest of the items found."""
    found = find_contamination(docs.select("doc_id", "text"), benchmark)
    ids = F.concat_ws(",", "items")
    return found.select(
        "doc_id",
        "n_words",
        n_hit().alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def remove_contamination(
    docs: DataFrame, benchmark: DataFrame, *, window: int = 10, max_coverage: float = 0.5
) -> DataFrame:
    """``docs`` with hit words cut out of their texts; documents mostly hit go.

    A document of which more than ``max_coverage`` of the words are hit is dropped. From
    others the hit spans are cut, from the first byte of the first word to the last of the
    last one; ``n_chars`` follows if there is such a column. Clean documents stay as they are.
    """
    found = find_contamination(set_apart(docs), benchmark, window, cut=True)
    out, made = found.where(n_hit() <= F.col("n_words") * max_coverage), {}
    if "n_chars" in docs.columns:
        changed = F.when(F.size("spans") > 0, F.char_length("text"))
        kind = docs.schema["n_chars"].dataType
        made["n_chars"] = F.coalesce(changed.cast(kind), F.col("own.n_chars"))
    return put_back(out, docs.columns, **made)


def cut_words(text, spans):
    """The text without the words of the spans."""
    if text is None or spans is None or not len(spans):
        return text
    places = [
        m.span()
        for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)
    ]
    out, at = [], 0
    for span in spans:
        a, b = int(span["start"]), int(span["end"])
        out.append(text[at : places[a][0]])
        at = places[b - 1][1]
    return "".join(out) + text[at:]

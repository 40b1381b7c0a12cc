"""Exact top-k search: BM25 over an inverted index, shard by shard.

Statistics (documents per word, number and mean length of documents) come from one pass over
all documents. A query is a text; its terms are all its words that some document has, unless a
caller asks for the ``max_terms`` with the largest tf * idf. A shard is some documents of one task, cut at
``shard_postings`` or ``shard_docs``: posting lists by term, the terms of every document, and
for the terms in many documents of a kind their impacts as a matrix. Documents and queries with
many words in common are of a kind. Terms that many queries of a kind ask for are one product of
matrices in short numbers, the other terms are added up list by list, and what may reach the k-th best score, with room for rounding, is scored once more, whole, from
the terms of the document. Impacts use the statistics of all documents, so the top k of the
shards merge exactly.

Before the run over all documents come runs over one document in ``SEEDS[i]``, each of which
gives every query a score that k documents reach. No document below it can be among the best,
so the next run starts there, and a run gives a few times k rows a query, however many shards.
The documents of the last seeds are told by their content and not searched again.

Queries are broadcast in blocks of about ``terms_per_block`` terms and ``queries_per_block``
queries. A shard is indexed once and answers one block after another, so a run is one pass.

Score: sum over terms of idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean)) with
idf = ln(1 + (N - df + 0.5) / (df + 0.5)). Ties go to the least doc_id, NULL last. NULL and
empty texts are documents without words and queries without terms, which find nothing; rows
with the same query id form one query. Repeated documents are each found.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftgauge.checkpoints import store
from shiftgauge.llm.rows import give_back, text_chunks, word_counts

FREQUENT = 20  # a term in more than a 20th of a kind of a shard's documents is in the matrix
MATRIX = 16 << 20  # its cells, at most
TOGETHER = 2 << 20  # scores of a product, at most
# Of a score: more than twice what rounding makes sums of short numbers differ by, of n terms.
SLACK, ROUNDING = 2e-4, 1.2e-7
KINDS = 16  # of queries, and of a shard's documents
POSTINGS = 1 << 17  # read from lists at a time
PRODUCTS = 150  # cells of a product that take the time of one posting of a list
SEEDS = 64, 8
ROOM = 1.15  # so many times the partitions that full shards of them would take
MOST_DOCS = 1 << 18  # of a shard: their numbers take some of the bits of impacts
K1, B = 1.2, 0.75
_TOPS = "query_id bigint, doc_id bigint, score double"


def word_statistics(docs: DataFrame) -> DataFrame:
    """word, df; the row of the NULL word has the number of documents and of all their words."""

    def summed(parts: list[pa.Table]) -> pa.Table:
        made = pa.concat_tables(parts).group_by("word").aggregate([("df", "sum"), ("total", "sum")])
        return made.rename_columns(["word", "df", "total"])

    def run(batches):
        parts: list[pa.Table] = []
        for batch in batches:
            for part in text_chunks(batch):
                words, _, codes, _, lengths = word_counts(part.column("text"))
                df = np.bincount(codes, minlength=len(words))
                parts.append(_statistics_rows(words, df, len(lengths), int(lengths.sum())))
                if sum(map(len, parts)) > 1_000_000:
                    parts = [summed(parts)]
                    if len(parts[0]) > 400_000:
                        yield from parts[0].to_batches()
                        parts = []
        if parts:
            yield from summed(parts).to_batches()
        give_back()

    texts = docs.select(F.col("text").cast("string").alias("text"))
    made = texts.mapInArrow(run, "word string, df bigint, total bigint")
    return made.groupBy("word").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


def _statistics_rows(words: pa.Array, df: np.ndarray, n: int, total: int) -> pa.Table:
    own = df > 0
    words = words.filter(pa.array(own)).cast(pa.string())
    totals = np.zeros(len(words) + 1, np.int64)
    totals[0] = total
    return pa.table(
        {
            "word": pa.concat_arrays([pa.nulls(1, pa.string()), words]),
            "df": np.concatenate([[n], df[own]]).astype(np.int64),
            "total": totals,
        }
    )


def query_terms(
    queries: DataFrame, statistics: DataFrame, n_docs: int, max_terms: int | None
) -> DataFrame:
    """query_id, word, idf, place: the terms of each query by tf * idf, then word."""

    def run(batches):
        for batch in batches:
            for part in text_chunks(batch):
                words, rows, codes, tf, _ = word_counts(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("query_id").take(pa.array(rows)),
                        words.take(pa.array(codes)).cast(pa.string()),
                        pa.array(tf),
                    ],
                    names=["query_id", "word", "tf"],
                )
        give_back()

    counted = queries.mapInArrow(run, "query_id bigint, word string, tf bigint")
    counted = counted.groupBy("query_id", "word").agg(F.max("tf").alias("tf"))
    df = F.col("df")
    idf = F.log(1 + (F.lit(n_docs) - df + 0.5) / (df + 0.5))
    known = counted.join(statistics.where("word IS NOT NULL"), "word").withColumn("idf", idf)
    best = Window.partitionBy("query_id").orderBy(F.desc(F.col("tf") * F.col("idf")), "word")
    top = known.withColumn("place", F.row_number().over(best))
    if max_terms is not None:
        top = top.where(F.col("place") <= max_terms)
    return top.select("query_id", "word", "idf", "place")


class Queries:
    """The queries of a block: the terms of query ``i`` are ``terms[first[i]:first[i + 1]]``.

    Terms are numbered by their words, so those of a query and of a document are in one order;
    ``idf`` has one number a term. Queries with many words in common stand together.
    """

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by([("query_id", "ascending"), ("word", "ascending")]).combine_chunks()
        coded = rows["word"].combine_chunks().dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        order = pc.sort_indices(coded.dictionary)
        self.words = coded.dictionary.take(order).cast(pa.large_string())
        number = np.empty(len(order), np.int32)
        number[order.to_numpy()] = np.arange(len(order), dtype=np.int32)
        terms = number[coded.indices.to_numpy()]
        self.idf = np.zeros(len(order))
        self.idf[terms] = rows["idf"].to_numpy()
        ids, first = np.unique(rows["query_id"].to_numpy(), return_index=True)
        sizes = np.diff(np.append(first, len(terms)))
        kinds = _kinds(terms, np.repeat(np.arange(len(ids)), sizes), len(ids))
        order = np.lexsort((sizes, kinds))
        self.ids, sizes = ids[order], sizes[order]
        self.terms = terms[_ranges(first[order], sizes)]
        self.first = np.append(0, np.cumsum(sizes))
        self.floors = np.zeros(len(ids))


def _kinds(terms: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """A number from 0 to KINDS - 1 for each of ``n`` texts, alike for texts alike in words.

    ``of`` has the text of every term, in order. Rounds of k-means by cosine over the most
    frequent terms; they decide how the work is cut, not what is found.
    """
    if n <= KINDS or not len(terms):
        return np.zeros(n, np.int64)
    often = np.bincount(terms)
    column = np.full(len(often), -1)
    chosen = np.argsort(-often, kind="stable")[:512]
    column[chosen] = np.arange(len(chosen))
    columns = column[terms]
    of, columns = of[columns >= 0], columns[columns >= 0]
    step = 4096
    edges = np.searchsorted(of, np.arange(0, n + step, step))

    def parts():
        for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            rows = np.zeros((min(step, n - i * step), len(chosen)), np.float32)
            rows[of[a:b] - i * step, columns[a:b]] = 1.0
            yield rows / np.sqrt(np.maximum(rows.sum(axis=1, keepdims=True), 1))

    centres = np.zeros((KINDS, len(chosen)), np.float32)
    for i, one in enumerate(np.linspace(0, n - 1, KINDS).astype(np.int64)):
        centres[i, columns[slice(*np.searchsorted(of, [one, one + 1]))]] = 1.0
    for _ in range(4):
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
        kinds, sums = [], np.zeros_like(centres)
        for rows in parts():
            kind = np.argmax(rows @ centres.T, axis=1)
            kinds.append(kind)
            own = np.zeros((KINDS, len(rows)), np.float32)
            own[kind, np.arange(len(rows))] = 1.0
            sums += own @ rows
        centres = sums
    return np.concatenate(kinds)


class Shard:
    """Collects documents, then holds their posting lists by word and document.

    Documents are numbered by doc_id, which is the order of ties, words in their order. The
    index has all words, so it answers one block of queries after another.
    """

    def __init__(self, queries: Queries, mean: float):
        self.queries, self.mean = queries, mean or 1.0
        self.ids: list[pa.Array] = []
        self.parts: list[tuple] = []
        self.n_docs = self.n_postings = 0

    def add(self, ids: pa.Array, texts: pa.Array) -> None:
        words, rows, codes, tf, lengths = word_counts(texts)
        impacts = tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[rows] / self.mean))
        self.parts.append(
            (words, (rows + self.n_docs).astype(np.int32), codes.astype(np.int32), impacts)
        )
        self.ids.append(ids)
        self.n_docs += len(ids)
        self.n_postings += len(codes)

    def index(self) -> None:
        ids = pa.concat_arrays(self.ids)
        missing = ids.is_null().to_numpy(zero_copy_only=False)
        values = ids.fill_null(0).to_numpy(zero_copy_only=False)
        order = np.lexsort((values, missing))
        self.ids = ids.take(pa.array(order))
        number = np.empty(self.n_docs, np.int64)
        number[order] = np.arange(self.n_docs)
        words, rows, terms, impacts = zip(*self.parts, strict=True)
        self.parts = []
        terms = self._numbered(words, terms)
        docs, impacts = number[np.concatenate(rows)], np.concatenate(impacts)
        del words, rows
        # By document, then term: what a document holds.
        n_terms = len(self.words)
        order = _order(docs * n_terms + terms)
        docs, self.held, self.held_impact = docs[order], terms[order], impacts[order]
        del terms, impacts, order
        self.document = np.searchsorted(docs, np.arange(self.n_docs + 1))
        # The columns: documents by kind, then number.
        kinds = _kinds(self.held, docs, self.n_docs)
        self.number = np.argsort(kinds, kind="stable")
        self.edges = np.searchsorted(kinds[self.number], np.arange(KINDS + 1))
        column = np.empty(self.n_docs, np.int64)
        column[self.number] = np.arange(self.n_docs)
        kind, docs = kinds.astype(np.int8)[docs], column.astype(np.int32)[docs]
        self._split(docs, kind, n_terms)
        self.weighed = np.zeros(n_terms, bool)
        self.ask(self.queries)

    def _split(self, docs: np.ndarray, kind: np.ndarray, n_terms: int) -> None:
        """A matrix of the terms that are frequent in a kind, and lists of the rest."""
        widths = np.diff(self.edges)
        sizes = np.bincount(self.held, minlength=n_terms)
        tried = np.flatnonzero(sizes * (FREQUENT * KINDS) > self.n_docs)
        self.row = np.full(n_terms, -1, np.int32)
        self.row[tried] = np.arange(len(tried), dtype=np.int32)
        rows = self.row[self.held]
        own = np.flatnonzero(rows >= 0)
        counts = np.bincount(rows[own] * KINDS + kind[own], minlength=len(tried) * KINDS)
        counts = counts.reshape(len(tried), KINDS)
        often = counts * FREQUENT > widths
        work = (often * counts.astype(np.float64) ** 2 / np.maximum(widths, 1)).sum(axis=1)
        kept = np.flatnonzero(work)
        room = max(1, MATRIX // self.n_docs)
        if len(kept) > room:
            kept = np.sort(kept[np.argsort(-work[kept], kind="stable")[:room]])
        frequent, often = tried[kept], often[kept]
        self.often = often
        self.row[:] = -1
        self.row[frequent] = np.arange(len(frequent), dtype=np.int32)
        # The lists: by term what is not in the matrix, then by row and kind what is.
        rows = self.row[self.held]
        dense = rows >= 0
        dense[dense] = self.often[rows[dense], kind[dense]]
        rest, own = np.flatnonzero(~dense), np.flatnonzero(dense)
        rest = rest[_order(self.held[rest])]
        cells = rows[own] * np.int64(KINDS) + kind[own]
        order = _order(cells)
        own, cells = own[order], cells[order]
        self.matrix = np.zeros((len(frequent), self.n_docs), np.float32)
        self.matrix[rows[own], docs[own]] = self.held_impact[own]
        self.sizes = np.bincount(self.held[rest], minlength=n_terms)
        self.list = np.append(0, np.cumsum(self.sizes))
        self.cell_sizes = np.bincount(cells, minlength=len(frequent) * KINDS).reshape(-1, KINDS)
        self.cell = len(rest) + np.cumsum(self.cell_sizes.ravel()).reshape(-1, KINDS)
        self.cell -= self.cell_sizes
        # An impact in short, its last bits replaced by the document.
        places = np.concatenate([rest, own])
        del rows, dense, rest, own, cells, order
        self.last = np.uint32((1 << (self.n_docs - 1).bit_length()) - 1)
        self.lists = self.held_impact[places].astype(np.float32).view(np.uint32) & ~self.last
        self.lists |= docs[places].astype(np.uint32)
        self.listed = self.held[places]
        # Of a score: twice what sums differ by, besides rounding.
        self.slack = SLACK + 4 * float(self.last) / (1 << 23)

    def _numbered(self, words: tuple, codes: tuple) -> np.ndarray:
        """The words of all parts in order, as ``self.words``, and their numbers for ``codes``."""
        coded = pa.concat_arrays([w.cast(pa.large_string()) for w in words]).dictionary_encode()
        order = pc.sort_indices(coded.dictionary)
        number = np.empty(len(order), np.int32)
        number[order.to_numpy()] = np.arange(len(order), dtype=np.int32)
        number = number[coded.indices.to_numpy()]
        self.words = coded.dictionary.take(order)
        starts = np.cumsum([0, *map(len, words)])
        return np.concatenate([number[a + c] for a, c in zip(starts, codes, strict=False)])

    def ask(self, queries: Queries) -> None:
        """Answer these queries from now on. A word has one idf in all of them."""
        self.queries = queries
        place = pc.index_in(queries.words, value_set=self.words).fill_null(-1).to_numpy()
        known = place >= 0
        own = known[queries.terms]
        self.terms = place[queries.terms[own]].astype(np.int32)
        self.first = np.append(0, np.cumsum(own))[queries.first]
        self.idf = np.zeros(len(self.words))
        self.idf[place[known]] = queries.idf[known]
        # Lists and rows are weighed by the idf of a word when it is asked for first.
        fresh = np.zeros(len(self.words), bool)
        fresh[place[known]] = ~self.weighed[place[known]]
        self.weighed |= fresh
        weights = np.where(fresh, self.idf, 1.0).astype(np.float32)
        lists = (self.lists & ~self.last).view(np.float32)
        lists *= weights[self.listed]
        self.lists = (lists.view(np.uint32) & ~self.last) | (self.lists & self.last)
        for term in np.flatnonzero(fresh & (self.row >= 0)):
            self.matrix[self.row[term]] *= weights[term]

    def tops(self, k: int):
        """(documents, scores) of the best ``k`` that reach the floor, query by query."""
        n = len(self.queries.floors)
        many = max(1, min(256, TOGETHER // self.n_docs))
        for a in range(0, n, many):
            first = self.first[a : min(a + many, n) + 1]
            slack = self.slack + ROUNDING * np.diff(first)
            floors = self.queries.floors[a : a + many]
            about = self._about(self.terms[first[0] : first[-1]], first - first[0])
            least = np.maximum(floors * (1 - slack / 2), np.finfo(np.float32).tiny)
            found = np.flatnonzero(about >= least[:, None].astype(np.float32))
            edges = np.searchsorted(found, np.arange(len(floors) + 1) * self.n_docs)
            nothing = found[:0], np.zeros(0)
            for i, (c, d) in enumerate(zip(edges.tolist(), edges[1:].tolist(), strict=False)):
                terms = self.terms[first[i] : first[i + 1]]
                own = found[c:d] % self.n_docs if c < d else None
                yield nothing if own is None else self._top(
                    terms, about[i], own, floors[i], slack[i], k
                )

    def _about(self, terms: np.ndarray, first: np.ndarray) -> np.ndarray:
        """About the scores of all documents for some queries, of terms ``first[i]`` on."""
        about = np.zeros((len(first) - 1, self.n_docs), np.float32)
        of = np.repeat(np.arange(len(about), dtype=np.int16), np.diff(first))
        rows = self.row[terms]
        framed = np.flatnonzero(rows >= 0)
        used, row = np.unique(rows[framed], return_inverse=True)
        asked = np.zeros((len(about), len(used)), np.float32)
        asked[of[framed], row] = 1.0
        # A product pays where enough queries ask for a term: else its list is read.
        work = np.bincount(row, minlength=len(used))[:, None] * self.cell_sizes[used]
        dense = work * PRODUCTS >= len(about) * np.diff(self.edges)
        dense &= self.often[used]
        for kind, (a, b) in enumerate(zip(self.edges, self.edges[1:], strict=False)):
            own = np.flatnonzero(dense[:, kind])
            if b > a and len(own):
                about[:, a:b] = asked[:, own] @ self.matrix[used[own], a:b]
        pair, kind = np.nonzero((self.often[used] & ~dense)[row])
        cells = used[row[pair]], kind
        starts = np.concatenate([self.list[terms], self.cell[cells]])
        sizes = np.concatenate([self.sizes[terms], self.cell_sizes[cells]])
        of = np.concatenate([of, of[framed[pair]]])
        order = np.argsort(of, kind="stable")
        order = order[sizes[order] > 0]
        of, starts, sizes = of[order], starts[order], sizes[order]
        first = np.searchsorted(of, np.arange(len(about) + 1))
        ends = np.append(0, np.cumsum(sizes))[first]
        a = 0
        while a < len(about):  # some queries at a time
            b = max(a + 1, int(np.searchsorted(ends, ends[a] + POSTINGS, "right")) - 1)
            own = slice(first[a], first[b])
            both = self.lists.take(_ranges(starts[own], sizes[own]), mode="clip")
            docs, impacts = (both & self.last).astype(np.int64), both.view(np.float32)
            for i in range(a, b):
                part = slice(ends[i] - ends[a], ends[i + 1] - ends[a])
                np.add.at(about[i], docs[part], impacts[part])
            a = b
        return about

    def _top(self, terms, about: np.ndarray, found: np.ndarray, floor: float, slack: float, k: int):
        if len(found) > 4 * k:
            kth = np.partition(about[found], len(found) - k)[len(found) - k]
            found = found[about[found] >= kth * (1 - slack)]
        docs = self.number[found]
        whole = self._whole(terms, docs)
        enough = whole >= floor
        return self._best(docs[enough], whole[enough], k)

    def _whole(self, terms: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """The scores of some documents, from their terms in order."""
        scores = np.zeros(len(docs))
        for i, doc in enumerate(docs.tolist()):
            a, b = self.document[doc], self.document[doc + 1]
            held = self.held[a:b]
            if len(held) < len(terms):
                place, places = _places(held, terms)
            else:
                places, place = _places(terms, held)
            if len(places):  # added up one by one: the same sum wherever the document is
                impacts = self.held_impact[a:b][place]
                scores[i] = np.cumsum(self.idf[terms[places]] * impacts)[-1]
        return scores

    @staticmethod
    def _best(docs: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        if len(docs) > k:
            enough = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            docs, scores = docs[enough], scores[enough]
        order = np.lexsort((docs, -scores))[:k]
        return docs[order], scores[order]


def _places(few: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where numbers that both hold are in ``few`` and in ``many``, both in order."""
    place = np.minimum(many.searchsorted(few), len(many) - 1)
    own = np.flatnonzero(many[place] == few)
    return own, place[own]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The whole numbers of every range ``starts[i]`` to ``starts[i] + sizes[i]``, in order."""
    ends = np.cumsum(sizes)
    made = np.repeat(starts - (ends - sizes), sizes)
    made += np.arange(len(made))
    return made


def _order(keys: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 in order, those alike in theirs: a sort of numbers beats argsort."""
    bits = len(keys).bit_length()
    if not len(keys) or int(keys.max()) >> (62 - bits):
        return np.argsort(keys, kind="stable")
    keys = keys.astype(np.int64) << bits
    keys |= np.arange(len(keys))
    keys.sort()
    keys &= (1 << bits) - 1
    return keys


def _shard_tops(
    docs: DataFrame,
    blocks: list[Broadcast],
    floors: list[np.ndarray],
    mean: float,
    k: int,
    shard_docs: int,
    shard_postings: int,
) -> DataFrame:
    """The best of every shard for the queries of all ``blocks``, in one pass over ``docs``.

    ``floors`` has the least score that counts, for every query of every block.
    """
    least = docs.sparkSession.sparkContext.broadcast(floors)

    def asked(i: int) -> Queries:
        queries = blocks[i].value
        vars(blocks[i]).pop("_value", None)  # a worker holds one block at a time
        queries.floors = least.value[i]
        return queries

    def run(batches):
        shard = None

        def answers():
            for i in range(len(blocks)):
                if i == 0:
                    shard.queries = asked(0)
                    shard.index()
                else:
                    shard.ask(asked(i))
                yield from rows()

        def rows():
            ids, of, found = shard.queries.ids, [], []
            for i, best in enumerate(shard.tops(k), 1):
                found.append(best)
                of.append(i - 1)
                if len(of) == 10_000 or i == len(ids):
                    docs, scores = (np.concatenate(c) for c in zip(*found, strict=True))
                    of = np.repeat(of, [len(d) for d, _ in found])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[of]), shard.ids.take(pa.array(docs)), pa.array(scores)],
                        names=["query_id", "doc_id", "score"],
                    )
                    of, found = [], []

        for batch in batches:
            for chunk in text_chunks(batch):
                for a in range(0, chunk.num_rows, shard_docs):
                    part = chunk.slice(a, shard_docs)
                    shard = shard or Shard(None, mean)
                    shard.add(part.column("doc_id"), part.column("text"))
                    if shard.n_docs >= shard_docs or shard.n_postings >= shard_postings:
                        yield from answers()
                        shard = None
        if shard and shard.n_postings:
            yield from answers()
        shard = None
        give_back()

    return docs.mapInArrow(run, _TOPS)


def _one_in(docs: DataFrame, many: int) -> Column:
    """True for one document in ``many``, told by its content: a second reading tells the same."""
    return F.pmod(F.xxhash64(*docs.columns), F.lit(many)) == 0


def _seed(docs: DataFrame, one_in: int, shards: int) -> DataFrame:
    """One document in ``one_in``, in ``shards`` partitions, or 4.

    A shard of few documents would give them all to every query, so there are few shards,
    however many partitions a shuffle has.
    """
    some = docs.where(_one_in(docs, one_in)).withColumn("row", F.monotonically_increasing_id())
    return some.repartition("row").coalesce(max(4, shards)).drop("row")


def _best(tops: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return tops.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 10,
    *,
    max_terms: int | None = None,
    queries_per_block: int = 100_000,
    terms_per_block: int = 2_000_000,
    shard_docs: int = 65_536,
    shard_postings: int = 4_000_000,
) -> DataFrame:
    """query_id, rank (from 1), doc_id, score: the best ``k`` of ``docs`` per row of ``queries``.

    ``docs`` has doc_id and text, ``queries`` query_id and text. ``max_terms`` shortens the
    queries; without it every word counts.
    """
    spark = docs.sparkSession
    docs = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    queries = queries.select(
        F.col("query_id").cast("bigint").alias("query_id"),
        F.col("text").cast("string").alias("text"),
    ).where("query_id IS NOT NULL")
    statistics, _ = store(word_statistics(docs))
    sums = statistics.where("word IS NULL").first()
    n_docs, n_words = (sums["df"], sums["total"]) if sums else (0, 0)
    terms, seen = store(
        query_terms(queries, statistics, n_docs, max_terms),
        n=F.count(F.when(F.col("place") == 1, 1)),
        terms=F.count(F.lit(1)),
    )
    n_postings = statistics.where("word IS NOT NULL").agg(F.sum("df")).first()[0] or 0

    def shards(one_in: int) -> int:
        return int(n_postings * ROOM / (one_in * shard_postings)) + 1

    # Many small files make as many small shards, each with its own best k; merge their reading.
    rest = docs.where(~_one_in(docs, SEEDS[-1]))
    rest = rest.coalesce(max(spark.sparkContext.defaultParallelism, shards(1)))
    seeds = [_seed(docs, one_in, shards(one_in)) for one_in in SEEDS]
    sizes = n_words / max(1, n_docs), k, min(shard_docs, MOST_DOCS), shard_postings
    blocks = max(
        1, math.ceil(seen["n"] / queries_per_block), math.ceil(seen["terms"] / terms_per_block)
    )
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    asked, ids = [], []
    for i in range(blocks):
        own = Queries(terms.where(block == i).select("query_id", "word", "idf").toArrow())
        asked.append(spark.sparkContext.broadcast(own))  # about terms_per_block short rows
        ids.append(own.ids)
    floors = [np.zeros(len(own)) for own in ids]
    for some in seeds:
        tops, _ = store(_best(_shard_tops(some, asked, floors, *sizes), k))
        kth = tops.where(F.col("rank") == k)
        kth = kth.select("query_id", "score").toArrow()  # a row per query at most
        floors = [_floors(own, kth) for own in ids]
    # The last seeds have been searched: the rest of the documents is left.
    tops = tops.select("query_id", "doc_id", "score")
    tops = tops.unionByName(_shard_tops(rest, asked, floors, *sizes))
    return _best(tops, k).select("query_id", "rank", "doc_id", "score")


def _floors(ids: np.ndarray, kth: pa.Table) -> np.ndarray:
    """The score of every query in ``kth``; 0 for the others."""
    place = pc.index_in(pa.array(ids), value_set=kth["query_id"].combine_chunks())
    scores = np.append(kth["score"].to_numpy(), 0.0)
    return scores[place.fill_null(len(scores) - 1).to_numpy()]


def every_50th(docs: DataFrame, k: int = 10) -> DataFrame:
    """The rows whose id is divisible by 50, against all rows."""
    queries = docs.where(F.col("doc_id") % 50 == 0)
    return search(docs, queries.select(F.col("doc_id").alias("query_id"), "text"), k)

"""Collocations, centroid clustering and one-permutation near-duplicates against brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shiftgauge.llm import centroids, collocations, one_permutation
from shiftgauge.llm.word_runs import byte_kinds, words_in

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = "bigint, lang string, text string, phrase string, words string, a int, l int, rank int, row int"


# --- words ---------------------------------------------------------------------------


def test_words_with_their_pieces():
    rng = random.Random(4)
    signs = ["a", "B", "é", "中", " ", "\t", ".", "\n", "\x85", "\xa0", "\x1c", ":"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.choice([0, 1, 2, 9]))) for _ in range(3000)]
    got = words_in(pa.array([None, *texts, None])[1:], byte_kinds(b" \t", b".,;:!?\n\x0b\x0c\r"))
    found = defaultdict(list)
    for code, row, piece in zip(got.codes, got.rows, got.pieces, strict=True):
        found[int(row)].append((got.dictionary[int(code)].as_py(), int(piece)))
    for i, text in enumerate(texts):
        pieces = [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", text.translate(UPPER))]
        own = found.get(i, [])
        assert [w for w, _ in own] == [w for p in pieces for w in p]
        assert len({p for _, p in own}) == sum(bool(p) for p in pieces)


# --- collocations --------------------------------------------------------------------


def brute_collocations(rows, least, covered, top, longest=3, shortest=2):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang or "und"][tuple(words[i : i + size])] += 1
    out = []
    for lang, known in counts.items():
        candidates = {p: a for p, a in known.items() if len(p) >= shortest and a >= least}
        inside = Counter()
        for phrase, a in candidates.items():
            for size in range(shortest, len(phrase)):
                for i in range(len(phrase) - size + 1):
                    inside[phrase[i : i + size]] = max(inside[phrase[i : i + size]], a)
        ranked = []
        for phrase, a in candidates.items():
            if inside[phrase] and 100 * inside[phrase] >= covered * a:
                continue
            parts = [(known[phrase[:k]], known[phrase[k:]]) for k in range(1, len(phrase))]
            score, k = min((10**6 * a * a // (x * y), k) for k, (x, y) in enumerate(parts))
            ranked.append((-score, -a, " ".join(phrase).encode(), *parts[k]))
        for rank, (score, a, phrase, x, y) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, x, y, totals[lang], -score))
    return sorted(out)


def some_texts(rng, rows, vocabulary):
    for _ in range(rows):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 2, 30, 200]))]
        ends = [rng.choice([" ", " ", " ", "\t ", ". ", ",", "\n", "! "]) for _ in words]
        yield rng.choice(["en", "en", "en", "de", None]), "".join(w + e for w, e in zip(words, ends, strict=True))


@pytest.mark.parametrize(
    ("vocabulary", "share", "shortest", "longest"),
    [(12, 1000, 2, 3), (300, 5, 2, 3), (300, 1000, 2, 3), (6, 10, 3, 4), (40, 30, 2, 2)],
)
def test_collocations_equal_brute_force(spark, monkeypatch, vocabulary, share, shortest, longest):
    """Hot words, hot pairs and neither, with few and many different words."""
    rng = random.Random(vocabulary)
    kinds = [f"{rng.choice('AbÉz')}{i}" for i in range(vocabulary)]
    kinds += kinds[:2] * (vocabulary // 2)  # a third of the words is one of two
    rows = list(some_texts(rng, 400, kinds))
    monkeypatch.setattr(collocations, "SHARE", share)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    made = collocations.collocations(docs, min_words=shortest, max_words=longest, least=5, top=50, covered=60)
    assert sorted(map(tuple, made.collect())) == brute_collocations(rows, 5, 60, 50, longest, shortest)


def test_prefix_partitions_are_counts():
    rng = np.random.default_rng(2)
    for size in (0, 1, 7, 2000):
        keys = rng.integers(0, 9, (size, 3)).astype(np.int32)
        keys[rng.random(size) < 0.2, 2] = -1
        weights = rng.integers(1, 4, size)
        rows, lengths, sums = collocations.frequent_prefixes(keys, weights, 6)
        expected = Counter()
        for key, weight in zip(keys.tolist(), weights.tolist(), strict=True):
            for k in range(1, 4):
                if key[k - 1] >= 0:
                    expected[tuple(key[:k])] += weight
        got = {tuple(keys[r, :n].tolist()): s for r, n, s in zip(rows, lengths, sums.tolist(), strict=True)}
        assert len(got) == len(rows) and got == {k: v for k, v in expected.items() if v >= 6}


def test_scores_beyond_64_bits(spark):
    """10^12 occurrences: products of counts have 24 digits, with the factor 30."""
    a, x, y = 10**12 + 7, 10**12 + 39, 3 * 10**12 + 1
    row = spark.range(1).select(*[F.lit(v).cast("decimal(14,0)").alias(n) for n, v in zip("alr", (a, x, y), strict=True)])
    score = row.selectExpr("(cast(1000000 AS decimal(7,0)) * a * a) div (l * r) AS s").first().s
    assert score == 10**6 * a * a // (x * y)


def test_collocations_of_odd_rows(spark):
    texts = [None, "", "...", "x", "a b", "A B\na b. a b", "word " * 40_000, "a b " * 6, "a b " * 6]
    rows = [(None if i == 3 else i, "en" if i % 2 else None, t, "p", "w", 1, 2, 3, 4) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id " + ODD)
    got = sorted(map(tuple, collocations.collocations(docs).collect()))
    assert got == brute_collocations([(r[1], r[2]) for r in rows], 10, 50, 2000)
    assert collocations.collocations(docs.limit(0)).collect() == []


# --- centroids -----------------------------------------------------------------------


def brute_clusters(rows, k, rounds, size):
    kept = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = lambda r: (r[0] is None, sha256(f"2:{r[0]}".encode()).hexdigest(), r[1])
    means = [v for _, v in sorted(kept, key=order)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(means))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        means = [
            [sum(x) // len(x) for x in zip(*groups[j], strict=True)] if j in groups else c
            for j, c in enumerate(means)
        ]
    out = [(i, *nearest(v)) for i, v in kept]
    sums = Counter()
    for _, d, c in out:
        sums[c] += d
    digest = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in means]
    # What does not fit a long is NULL, and so is every sum over it.
    fits = lambda x: x if x is not None and x < 1 << 63 else None
    lost = {c for _, d, c in out if fits(d) is None}
    part = {c: None if c in lost else fits(x) for c, x in sums.items()}
    whole = None if lost else fits(sum(sums.values()))
    return [(i, c, fits(d), part[c], whole, digest[c]) for i, d, c in out]


def key(row):
    return tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in row)


@pytest.mark.parametrize(("spread", "digits"), [(1.0, 6), (0.02, 2), (3e5, 3), (1e7, 1)])
def test_clusters_equal_brute_force(spark, spread, digits):
    """Ordinary vectors, many ties, 64-bit products and Python integers."""
    rng = random.Random(digits)
    rows = [(i, [round(rng.uniform(-spread, spread), digits) for _ in range(6)]) for i in range(150)]
    rows += rows[:20] + [(None, rows[3][1]), (900, None), (901, [1.0]), (902, [math.nan] * 6)]
    rows += [(903, [math.inf] * 6), (904, [None] * 6), (905, [0.5] * 7)]
    frame = spark.createDataFrame(
        [(i, v, "x", 1) for i, v in rows], "vec_id bigint, embedding array<double>, cluster string, vector int"
    ).repartition(3)
    made = centroids.centroid_digest(frame, k=7, rounds=3, dimensions=6)
    assert sorted(map(tuple, made.collect()), key=key) == sorted(brute_clusters(rows, 7, 3, 6), key=key)
    few = centroids.centroid_digest(frame.where("vec_id < 4"), k=7, rounds=3, dimensions=6)
    chosen = [r for r in rows if r[0] is not None and r[0] < 4]
    assert sorted(map(tuple, few.collect()), key=key) == sorted(brute_clusters(chosen, 7, 3, 6), key=key)
    assert centroids.centroid_digest(frame.limit(0), dimensions=6).collect() == []
    with pytest.raises(ArithmeticError):
        centroids.cluster(spark.createDataFrame([(1, [1e300])], frame.select("vec_id", "embedding").schema), dimensions=1)


@pytest.mark.parametrize("k", [1, 2, 3, 7, 40])
def test_tournament_finds_the_nearest(k):
    rng = np.random.default_rng(k)
    points = rng.integers(-3, 4, (500, 4))
    means = rng.integers(-3, 4, (k, 4))
    far = ((points[:, None, :] - means[None, :, :]) ** 2).sum(axis=2)
    for kind in (np.float64, np.int64, object):
        own, distance = centroids.Bisectors(means.tolist(), kind).nearest(points.astype(kind))
        assert own.tolist() == far.argmin(axis=1).tolist()  # the first of equals
        assert distance.tolist() == far.min(axis=1).tolist()


# --- one-permutation near-duplicates ---------------------------------------------------


def shingles(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def brute_components(rows):
    """By row: number of shingles, least id of its component."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if both and 100 * both >= 85 * (len(x) + len(sets[j]) - both):
                root[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        ids = [x for x in (least.get(top(i)), doc_id) if x is not None]
        least[top(i)] = min(ids, default=None)
    return [(d, len(s), least[top(i)], d == least[top(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def near_texts(rng):
    """Chains of edits, so that ends of a component are not linked, and unrelated texts."""
    words = [f"w{i}" for i in range(400)]
    for _ in range(25):
        text = [rng.choice(words) for _ in range(rng.choice([1, 2, 3, 7, 30, 120]))]
        for _ in range(rng.choice([1, 2, 8])):
            yield " ".join(text)
            for _ in range(rng.choice([0, 1, 1, 3])):
                text[rng.randrange(len(text))] = rng.choice(words)


@pytest.mark.parametrize("blocks", [512, 3])
def test_components_equal_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(one_permutation, "BLOCK_MEMBERS", blocks)
    rng = random.Random(blocks)
    texts = list(near_texts(rng))
    texts += [None, "", " \t ", "Same Words here", "same words here", "two words", "TWO\nwords"]
    rng.shuffle(texts)
    rows = [(None if rng.random() < 0.05 else i, t) for i, t in enumerate(texts)]
    rows += [r for r in rows if r[0] is not None][:10]
    frame = spark.createDataFrame(
        [(i, t, 1, "s", 2) for i, t in rows], "doc_id bigint, text string, row int, set_id string, part int"
    ).repartition(4)
    got = sorted(map(tuple, one_permutation.component_digest(frame).collect()), key=key)
    assert got == sorted(brute_components(rows), key=key)


def test_a_component_whose_hubs_link_nobody(spark, monkeypatch):
    """Star edges that fail leave the members to the blocks, which find every link."""
    monkeypatch.setattr(one_permutation, "_confirmed", lambda edges, sets, p, q: edges.limit(0).selectExpr("a", "hub AS b"))
    rng = random.Random(8)
    rows = list(enumerate(near_texts(rng)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(map(tuple, one_permutation.component_digest(frame).collect()))
    assert got == sorted(brute_components(rows))


def test_components_of_nothing(spark, docs, no_docs):
    assert one_permutation.component_digest(no_docs).collect() == []
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(map(tuple, one_permutation.component_digest(docs).collect()), key=key)
    expected = [(d, n, c, d == c) for d, n, c, _ in brute_components(rows)]
    assert got == sorted(expected, key=key)


def test_bins_agree_as_often_as_sets_are_alike():
    rng = np.random.default_rng(5)
    hasher = one_permutation.OnePermutation(256, 35, 6)
    for size, shared in ((8, 7), (40, 36), (400, 380), (3000, 2700)):
        agreed, similarity = [], shared / (2 * size - shared)
        for _ in range(30):
            pool = rng.integers(0, 1 << 63, 2 * size - shared, np.uint64) * np.uint64(2)
            one, two = np.sort(pool[:size]), np.sort(pool[size - shared :])
            both = hasher.densified(np.concatenate([one, two]), np.array([0, size, 2 * size]))
            assert (both > 0).all()
            agreed.append((both[0] == both[1]).mean())
        assert abs(np.mean(agreed) - similarity) < 0.04
    assert not hasher.densified(np.zeros(0, np.uint64), np.array([0, 0])).any()

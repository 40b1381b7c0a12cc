"""Each operator against a brute-force version, and on the odd cases."""

from __future__ import annotations

import base64
import gzip
import itertools
import math
import random
import re
import time
import urllib.parse
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shiftgauge.llm import (
    decontaminate,
    jaccard,
    language_id,
    license_scan,
    packing,
    personal_data,
    search,
    secret_scan,
    token_files,
    tokens,
    toxicity,
)
from shiftgauge.llm.components import connected
from shiftgauge.llm.rows import word_counts, words_of
from shiftgauge.llm.tokens import text_encoder, vocabulary_path

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def rows_of(df):
    return df.collect()


# --- tokens, packing, files ----------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(vocabulary_path())
    made.encode_special_tokens = True
    return made


def test_pieces_give_the_ids_of_the_tokenizer(tokenizer):
    rng = random.Random(1)
    parts = [" ", "  ", "a", "\n", ".", "é", " ", "1", "\t", "'s", "\x85", "²", "Ⅷ", ".\nA", "!"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 3, 30]))) for _ in range(8000)]
    ids, offsets = text_encoder(vocabulary_path(), 50)(pa.array([*texts, None]))
    for i, text in enumerate(texts):
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids[offsets[i] : offsets[i + 1]].tolist() == expected, text
    assert offsets[-1] == offsets[-2]


def test_words_with_signs_give_the_ids_of_the_tokenizer(tokenizer):
    rng = random.Random(4)
    signs = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    parts = ["we", "Hello", "é", "Straße", "x", "7", "'ll", "'", "…", "Ж", "\n", *signs]
    words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(20_000)]
    texts = [" ".join(words[a : a + 10]) for a in range(0, len(words), 10)]
    ids, offsets = text_encoder(vocabulary_path(), 300)(pa.array(texts))
    for i, text in enumerate(texts):
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids[offsets[i] : offsets[i + 1]].tolist() == expected, text


def test_packing_places_every_piece(spark, docs, tokenizer):
    placed = rows_of(packing.pack(docs, capacity=64, pieces_per_partition=100))
    bins, whole = defaultdict(list), defaultdict(list)
    for r in placed:
        bins[r.sequence_id].append((r.offset, r.length))
        whole[r.row].append(r)
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    assert len(whole) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for own in whole.values():
        ids = tokenizer.encode(texts[own[0].doc_id] or "", add_special_tokens=False).ids + [2]
        at = 0
        for i, r in enumerate(sorted(own, key=lambda r: r.piece)):
            part = np.array(ids[at : at + r.length], "<u4").tobytes()
            assert (r.piece, r.start, r.ids_crc32) == (i, at, zlib.crc32(part))
            assert r.length == 64 or i == 0
            at += r.length
        assert at == len(ids)


@pytest.mark.parametrize("lengths, more", [("short", 1), ("half", 30)])
def test_partitions_are_certified(spark, monkeypatch, lengths, more):
    rng = np.random.default_rng(11)
    if lengths == "short":
        lengths = np.minimum(rng.geometric(1 / 14, 4000), 64)
    else:  # many that fit with few others: partitions of 200 pieces lack partners
        lengths = np.r_[rng.integers(1, 64, 3000), np.full(40, 64), rng.integers(30, 40, 1000)]
    made = [(i, i, 0, 0, int(n), 0) for i, n in enumerate(lengths)]
    pieces = spark.createDataFrame(made, packing._PIECES)
    monkeypatch.setattr(packing, "token_pieces", lambda docs, capacity, **_: pieces)
    got = packing.pack(None, 64, pieces_per_partition=200).toPandas()
    assert sorted(got["row"]) == list(range(len(lengths)))
    fill = got.groupby("sequence_id")["length"].sum()
    assert fill.max() <= 64 and fill.sum() == lengths.sum()
    assert (got["bound"] <= got["bins"]).all()
    # Partitions closed whole: all sequences they made are in the result.
    part = got["sequence_id"].to_numpy() >> packing._BINS
    closed = got[got.groupby(part)["sequence_id"].transform("nunique") == got["bins"]]
    closed = closed[closed["length"] < 64]
    assert len(closed)
    for _, own in closed.groupby(closed["sequence_id"].to_numpy() >> packing._BINS):
        assert packing.lower_bound(np.bincount(own["length"], minlength=65), 64) >= own["bound"].iloc[0]
    whole = len(packing.best_fit(lengths, 64)[2])
    assert packing.lower_bound(np.bincount(lengths, minlength=65), 64) <= len(fill) <= whole + more


def test_packing_of_nothing(no_docs):
    assert rows_of(packing.pack(no_docs)) == []


def test_best_fit_meets_the_bound():
    rng = np.random.default_rng(3)
    for _ in range(40):
        lengths = rng.integers(1, 101, 200)
        bins, _, fill = packing.best_fit(lengths, 100)
        assert fill.max() <= 100 and fill.sum() == lengths.sum()
        bound = packing.lower_bound(np.bincount(lengths, minlength=101), 100)
        assert math.ceil(lengths.sum() / 100) <= bound <= len(fill) <= bound + 3
    assert packing.lower_bound(np.bincount([51] * 7, minlength=101), 100) == 7
    assert packing.lower_bound(np.bincount([34] * 6, minlength=101), 100) == 3


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files_round_trip(spark, docs, tokenizer, tmp_path, encoding):
    path = str(tmp_path / "tokens")
    token_files.write_tokens(docs, path, encoding=encoding, shard_bytes=100_000)
    expected, start = [], 0
    for r in sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0)):
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
        expected.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = [tuple(r) for r in token_files.token_index(spark, path).collect()]
    assert sorted(got, key=lambda r: r[1]) == expected
    part = token_files.read_tokens(spark, path, F.col("doc_id") > 5, "doc_id", "n_tokens")
    assert sorted(r.doc_id for r in part.collect()) == [6, 7]
    plan = part._jdf.queryExecution().toString()
    assert "GreaterThan(doc_id,5)" in plan and "tokens:array" not in plan.split("ReadSchema")[-1]


def test_token_files_of_nothing(spark, no_docs, tmp_path):
    token_files.write_tokens(no_docs, str(tmp_path / "none"))
    assert rows_of(token_files.token_index(spark, str(tmp_path / "none"))) == []


# --- decontamination -----------------------------------------------------------------


def brute_hits(doc, items, window):
    windows = defaultdict(set)
    for item, own in items:
        n = min(len(own), window)
        for a in range(len(own) - n + 1 if n else 0):
            windows[tuple(own[a : a + n])].add(item)
    hit, found = set(), set()
    for run, ids in windows.items():
        for a in range(len(doc) - len(run) + 1):
            if tuple(doc[a : a + len(run)]) == run:
                hit.update(range(a, a + len(run)))
                found |= ids
    return hit, found


def test_automaton_against_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        letters = [b"a", b"b", b"c", b"d"][: rng.choice([2, 3, 4])]
        window = rng.choice([1, 2, 3, 5])
        sizes = [0, 1, 2, 3, 8, 15]
        items = [
            (str(i), [rng.choice(letters) for _ in range(rng.choice(sizes))])
            for i in range(rng.choice([0, 1, 3, 6]))
        ]
        doc = [rng.choice([*letters, b"z"]) for _ in range(rng.choice([0, 1, 5, 30]))]
        spans, found, _ = decontaminate.Matcher(items, window).match(doc)
        hit = {x for a, b in spans for x in range(a, b)}
        assert (hit, found) == brute_hits(doc, items, window)


@pytest.mark.parametrize("max_words", [200_000, 8])
def test_passages_are_found_and_cut(spark, docs, max_words):
    items = [(1, "quick brown fox jumps over the lazy dog today"), (2, "word word"), (3, None), (4, "")]
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    found = decontaminate.find_contamination(docs, benchmark, 4, max_words=max_words)
    keyed = [(str(i), [w.encode() for w in words(t)]) for i, t in items]
    for r in rows_of(found):
        hit, ids = brute_hits([w.encode() for w in words(r.text)], keyed, 4)
        assert (sum(s.end - s.start for s in r.spans), set(r["items"])) == (len(hit), ids)
    clean = decontaminate.remove_contamination(docs, benchmark, window=4, max_coverage=0.7)
    assert clean.columns == docs.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[1] == "Released under the MIT License. The ."
    assert 5 not in texts and texts[2] is None and texts[7] == docs.where("doc_id = 7").first().text


def test_decontamination_of_and_with_nothing(spark, docs, no_docs):
    none = spark.createDataFrame([], "item_id int, text string")
    digest = rows_of(decontaminate.contamination_digest(docs, none))
    assert len(digest) == docs.count() and not any(r.contaminated for r in digest)
    assert rows_of(decontaminate.contamination_digest(no_docs, none)) == []


# --- secrets, personal data, licenses ------------------------------------------------


def brute_secrets(text):
    out = []
    assign = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    for m in re.finditer(assign, text, re.I | re.A):
        if len(m[2]) >= 6:
            out.append(("assign", *m.span()))
    for kind, pattern, least in (("access", r"AKIA[A-Z0-9]+", 20), ("hex", r"[0-9a-f]+", 24)):
        out += [(kind, *m.span()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return sorted(out, key=lambda s: (s[1], secret_scan.KINDS.index(s[0])))


def brute_personal(text):
    out = [
        ("email", *m.span())
        for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)
    ]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"\D", "", m[0])
        if 14 <= len(digits) <= 19 and personal_data.luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub(r"\D", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], personal_data.KINDS.index(s[0])))


PARTS = [
    "1", "23", "4539578763621486", " ", "-", ".", "@", "a", "b.c", "+", "(", ")", "255", "tOken",
    "=", '"', "AKIA", "0123456789abcdef01234567", "ABCDEFGHIJKLMNOPQR", "é", ": ", "PASSWORD",
    "api_key", "\n", "%41", "\\u0041",
]


def test_base_spans_against_brute_force():
    rng = random.Random(5)
    for _ in range(20_000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.choice([3, 10, 25])))
        own = [s[:3] for s in personal_data.scan(text) if s[0] in personal_data.BASE]
        assert own == brute_personal(text)
        assert secret_scan.scan(text)[0] == brute_secrets(text)


SECRET = "password = hunter2secret"


@pytest.mark.parametrize(
    "wrapped",
    [
        urllib.parse.quote(SECRET),
        base64.b64encode(SECRET.encode()).decode(),
        base64.b64encode(gzip.compress(SECRET.encode())).decode(),
        base64.b64encode(urllib.parse.quote(SECRET).encode()).decode(),
        "".join(f"\\u{ord(c):04x}" for c in SECRET),
        "".join(f"&#{ord(c)};" for c in SECRET),
        zlib.compress(SECRET.encode()).hex(),
    ],
)
def test_secrets_below_layers(wrapped):
    text = f"héllo {wrapped} bye"
    _, more = secret_scan.scan(text)
    assert ("assign", 6, 6 + len(wrapped)) in more


def test_every_copy_of_an_encoded_secret_is_reported():
    once = base64.b64encode(SECRET.encode()).decode()
    twice = base64.b64encode(f"see {once} there".encode()).decode()
    text = f"{once} and {once}\n{twice} %41 {once} {twice}"
    _, more = secret_scan.scan(text)
    places = {m.span() for m in re.finditer(f"{re.escape(once)}|{re.escape(twice)}", text)}
    assert len(places) == 5
    assert {(a, b) for kind, a, b in more if kind == "assign"} >= places


def _encoded(data):
    return base64.b64encode(data).decode()


NOISE = bytes(random.Random(3).randrange(256) for _ in range(300))
FOREIGN = "пароль сервера: password=hunter2secret"


@pytest.mark.parametrize(
    "text",
    [
        _encoded(FOREIGN.encode()),
        FOREIGN.encode().hex(),
        "/path/of/" + _encoded(SECRET.encode()),
        "id-" + _encoded(SECRET.encode()) + " end",
        base64.encodebytes(zlib.compress(SECRET.encode() + NOISE.hex().encode())).decode(),
        base64.encodebytes(zlib.compress(SECRET.encode() + NOISE.hex().encode())).decode() + "Regards",
        urllib.parse.quote(SECRET) + "%20%FF",
        "%FF" + "".join(f"%{ord(c):02X}" for c in SECRET) + "%20",
    ],
)
def test_all_encoded_layers_are_opened(text):
    assert any(kind == "assign" for kind, _, _ in secret_scan.scan(text)[1])


def kinds_in(text):
    return {kind for kind, _, _ in secret_scan.scan(text)[1]}


def test_members_of_compressed_layers():
    members = gzip.compress(b"first part ") + gzip.compress(SECRET.encode())
    assert "assign" in kinds_in(_encoded(members))
    assert "assign" in kinds_in(_encoded(gzip.compress(SECRET.encode() + b" " + NOISE * 9)[:-8]))


@pytest.mark.parametrize("at", [0, 50, 95, 99, 100, 101, 130, 400])
def test_windows_of_compressed_layers(monkeypatch, at):
    """A secret, or an encoded one, wherever the borders of windows fall."""
    monkeypatch.setattr(secret_scan, "WINDOW", 100)
    monkeypatch.setattr(secret_scan, "OVERLAP", 60)
    monkeypatch.setattr(secret_scan, "_PIECE", 7)
    encoded = base64.b64encode(gzip.compress(SECRET.encode() + NOISE)).decode()
    for inner in (SECRET, encoded, SECRET.replace("=", "%25253D")):
        for filler in ("ф é ", "ab "):
            text = (filler * 200)[:at] + f" {inner} " + filler * 100
            assert "assign" in kinds_in(_encoded(gzip.compress(text.encode())))


def test_a_secret_behind_40_mebibytes():
    text = b"nothing to see here \n" * 2_000_000 + SECRET.encode()
    assert len(text) > 40 << 20
    assert "assign" in kinds_in(_encoded(gzip.compress(text)))


def test_long_chains_take_linear_time():
    rng = random.Random(6)
    parts = "/".join(base64.b64encode(rng.randbytes(15)).decode().replace("/", "a") for _ in range(20_000))
    for text in ("%" + "25" * 400_000 + "41", "&" + "amp;" * 200_000 + "lt;", "\\" + "u005c" * 200_000 + "u0041", parts):
        began = time.process_time()
        secret_scan.scan(text)
        assert time.process_time() - began < 20
    assert "assign" in kinds_in(SECRET.replace("=", "%" + "25" * 900 + "3D"))
    assert "assign" in kinds_in(SECRET.replace("=", "&" + "amp;" * 90 + "#61;"))
    assert "assign" in kinds_in(SECRET.replace("=", "\\" + "u005c" * 90 + "u003d"))
    assert not kinds_in("&amp;amp;nothing; %25 \\u005c")


def test_self_encoding_layers_end():
    assert secret_scan.scan("%25" * 200 + " %2525252541") == ([], [])


def test_digests_of_odd_rows(docs, no_docs):
    for digest, brute in (
        (secret_scan.secret_digest, brute_secrets),
        (personal_data.personal_data_digest, brute_personal),
    ):
        got = sorted((str(r.doc_id), r.base_sha256) for r in digest(docs).collect())
        expected = []
        for r in docs.collect():
            joined = ",".join(f"{k}:{a}:{b}" for k, a, b in brute(r.text or ""))
            expected.append((str(r.doc_id), sha256(joined.encode()).hexdigest()))
        assert got == sorted(expected)
        assert rows_of(digest(no_docs)) == []


def test_redaction_and_checksums(docs):
    assert personal_data.mod97("DE89370400440532013000")
    assert not personal_data.mod97("DE88370400440532013000")
    assert personal_data.scan("ssn 123-45-6789")[0][0] == "ssn"
    assert personal_data.scan("part 123-45-6789") == []
    clean = personal_data.redact_personal_data(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    text = clean.where("doc_id = 4").first().text
    assert "[EMAIL]" in text and "[IP]" in text and "[CARD]" in text and "bob" not in text


def test_accounts_in_a_row_are_all_found():
    first, second = "DE89 3704 0044 0532 0130 00", "GB29 NWBK 6016 1331 9268 19"
    for text in (f"{first} {second}", f"{first} {second} {first}", f"AB12 WORDS IN CAPITALS {second}"):
        got = [text[a:b] for kind, a, b, _ in personal_data.scan(text) if kind == "iban"]
        assert got == [m for m in re.findall(f"{first}|{second}", text)]
        assert second not in personal_data.redact(text)


def test_licenses_against_brute_force(spark, docs, no_docs):
    more = [
        (20, "MIT under the MIT license, UNDER-the mit LICENSE and cc by nc by nc"),
        (21, "Licensed under the GNU General Public License, version 3."),
        (22, "Permission is hereby granted, free of charge, to any person who gets a copy of this"
             " software and associated documentation files"),
        (23, "apache license version 2 apache license version 2"),
    ]
    both = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id bigint, text string"))
    got = Counter()
    for r in rows_of(license_scan.license_digest(both)):
        got[r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels] += 1
    expected = Counter()
    for r in both.collect():
        own, starts, labels = words(r.text), [], set()
        for label, phrase in license_scan.PHRASES:
            p = phrase.split()
            for i in range(len(own) - len(p) + 1):
                if own[i : i + len(p)] == p:
                    starts.append(i)
                    labels.add(label)
        key = (min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))
        expected[r.doc_id, len(own), len(starts), *key] += 1
    assert got == expected
    labels = {r.doc_id: r.labels for r in license_scan.license_digest(both).collect()}
    assert labels[21] == "gpl-3" and labels[22] == "mit-text"
    assert rows_of(license_scan.license_digest(no_docs)) == []
    plan = license_scan.license_digest(both)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# --- near duplicates -----------------------------------------------------------------


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.8, 0.95):
        bands, length = jaccard.choose_bands(threshold, 0.999)
        assert 1 - (1 - threshold**length) ** bands >= 0.999 and bands * length <= 256


def brute_classes(texts):
    sets = []
    for t in texts:
        w = words(t)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    root, links = list(range(len(texts))), [0] * len(texts)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 9 * shared >= 4 * (len(sets[i]) + len(sets[j])):
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(texts))], links


@pytest.mark.parametrize("members, grams", [(512, 1 << 20), (7, 1000)])
def test_jaccard_against_brute_force(spark, monkeypatch, members, grams):
    monkeypatch.setattr(jaccard, "BLOCK_MEMBERS", members)
    monkeypatch.setattr(jaccard, "BLOCK_GRAMS", grams)
    rng = random.Random(2)
    texts = [None, "", "one two", "One, two!", "two one", "a b c d e"]
    for _ in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([6, 40, 120]))]
        for _ in range(rng.choice([1, 3, 25])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                own[rng.randrange(len(own))] = "x" + str(rng.randrange(9))
            texts.append(" ".join(own))
    order = list(range(len(texts)))
    rng.shuffle(order)
    docs = spark.createDataFrame([(i, texts[i]) for i in order], "doc_id bigint, text string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.duplicate_digest(docs).collect()}
    classes, links = brute_classes(texts)
    assert got == {i: (classes[i], links[i]) for i in range(len(texts))}
    kept = {r.doc_id for r in jaccard.keep_one(docs).collect()}
    assert kept == set(classes)


def test_jaccard_on_odd_rows(docs, no_docs):
    assert jaccard.near_duplicates(docs).count() == docs.count()
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, 3, 4, 5, None, 6, 7])
    assert rows_of(jaccard.keep_one(no_docs)) == []


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}


# --- search --------------------------------------------------------------------------


def test_words_of_many_texts():
    rng = random.Random(8)
    parts = ["a", "B", "é", "Z9", "ÀB", " ", "\t", ".", "\x00", "\x85", "\u2028", "日本", "\x7f"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 9, 60]))) for _ in range(300)]
    for array in (pa.array([*texts, None]), pa.array([None, "x", *texts])[2:], pa.array([], pa.string())):
        found, rows, codes, counts, lengths = word_counts(array)
        own = [Counter() for _ in array]
        for row, code, n in zip(rows, codes, counts, strict=True):
            own[row][found[int(code)].as_py()] += int(n)
        assert own == [Counter(words(t)) for t in array.to_pylist()]
        assert lengths.tolist() == [c.total() for c in own]


@pytest.mark.parametrize("shard", [{}, {"shard_docs": 40}, {"shard_postings": 300}])
def test_search_against_brute_force(spark, shard):
    rng = random.Random(4)
    texts = {
        i: " ".join(f"t{int(rng.paretovariate(0.7)) % 60}" for _ in range(rng.choice([0, 3, 30])))
        for i in range(1500)
    }
    docs = spark.createDataFrame([*texts.items(), (3000, None)], "doc_id bigint, text string")
    queries = docs.where("doc_id % 10 = 0").selectExpr("doc_id AS query_id", "text")
    got = defaultdict(list)
    for r in search.search(docs, queries, 7, max_terms=5, queries_per_block=60, **shard).orderBy(
        "query_id", "rank"
    ).collect():
        got[r.query_id].append((r.doc_id, round(r.score, 9)))
    texts[3000] = ""
    own = {i: Counter(t.split()) for i, t in texts.items()}
    n, mean = len(own), sum(c.total() for c in own.values()) / len(own)
    df = Counter(w for c in own.values() for w in c)
    idf = {w: math.log(1 + (n - d + 0.5) / (d + 0.5)) for w, d in df.items()}
    for query in range(0, 1500, 10):
        terms = sorted(own[query], key=lambda w: (-own[query][w] * idf[w], w))[:5]
        scores = {}
        for i, c in own.items():
            norm = 1.2 * (0.25 + 0.75 * c.total() / mean)
            held = [idf[w] * (c[w] * 2.2 / (c[w] + norm)) for w in sorted(terms) if c[w]]
            if held:
                scores[i] = round(sum(held), 9)
        expected = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:7]
        assert got[query] == expected


@pytest.mark.parametrize("sizes", [{}, {"terms_per_block": 400, "shard_docs": 90}])
def test_search_takes_every_word_of_a_query(spark, sizes):
    rng = random.Random(14)
    texts = {i: " ".join(f"t{rng.randrange(300)}" for _ in range(60)) for i in range(600)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    queries = docs.where("doc_id % 20 = 0").selectExpr("doc_id AS query_id", "text")
    got = defaultdict(list)
    found = search.search(docs, queries, 10, **sizes).orderBy("query_id", "rank")
    for r in found.collect():
        got[r.query_id].append((r.doc_id, round(r.score, 9)))
    own = {i: Counter(t.split()) for i, t in texts.items()}
    df = Counter(w for c in own.values() for w in c)
    idf = {w: math.log(1 + (600 - d + 0.5) / (d + 0.5)) for w, d in df.items()}
    for query in range(0, 600, 20):
        assert len(own[query]) > 16
        scores = {
            i: sum(idf[w] * c[w] * 2.2 / (c[w] + 1.2) for w in sorted(own[query]) if c[w])
            for i, c in own.items()
        }  # all texts are of the mean length
        expected = sorted(((i, round(x, 9)) for i, x in scores.items()), key=lambda x: (-x[1], x[0]))
        assert got[query] == expected[:10]


@pytest.mark.parametrize("cells", [1 << 24, 2000, 0])
def test_frequent_words_of_a_shard_are_a_matrix(monkeypatch, cells):
    """The best of a shard are those of brute force, whatever part of the terms is a matrix."""
    monkeypatch.setattr(search, "MATRIX", cells)
    rng, n = random.Random(6), 400
    texts = [" ".join(f"t{int(rng.paretovariate(0.6)) % 500}" for _ in range(40)) for _ in range(n)]
    texts[50] = texts[20] = texts[7]  # ties go to the least id
    held = [Counter(t.split()) for t in texts]
    idf = {w: 1 + i % 7 / 3 for i, w in enumerate(sorted({w for c in held for w in c}))}
    rows = [(q, w, idf[w]) for q in range(0, n, 10) for w in held[q]] + [(7, w, idf[w]) for w in held[7]]
    queries = search.Queries(pa.table(dict(zip(("query_id", "word", "idf"), zip(*rows, strict=True), strict=True))))
    shard = search.Shard(queries, 40.0)
    shard.add(pa.array(range(n)), pa.array(texts))
    shard.index()
    assert len(shard.matrix) <= max(1, cells // n) and (cells < 1 << 24 or len(shard.matrix) > 10)
    impact = [{w: c * 2.2 / (c + 1.2) for w, c in own.items()} for own in held]
    tops = list(shard.tops(5))
    for query, (docs, scores) in zip(queries.ids, tops, strict=True):
        full = [sum(idf[w] * own[w] for w in sorted(held[query]) if w in own) for own in impact]
        best = sorted(range(n), key=lambda i: (-round(full[i], 9), i))[:5]
        assert list(docs) == best and [round(x, 9) for x in scores] == [round(full[i], 9) for i in best]
    queries.floors = np.array([scores[2] for _, scores in tops])  # what reaches the floor is found
    for (docs, scores), (some, few) in zip(tops, shard.tops(5), strict=True):
        reach = scores >= scores[2]
        assert list(docs[reach]) == list(some) and list(scores[reach]) == list(few)


def test_blocks_of_queries_share_one_pass(spark, monkeypatch):
    """However many blocks, documents are indexed once, and those of the last seeds not again."""
    read, given = [], search._shard_tops

    def counted(docs, blocks, *others):
        read.append((docs.count(), len(blocks)))
        return given(docs, blocks, *others)

    monkeypatch.setattr(search, "_shard_tops", counted)
    rng = random.Random(15)
    texts = [(i, " ".join(f"t{rng.randrange(300)}" for _ in range(40))) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    queries = docs.where("doc_id % 10 = 0").selectExpr("doc_id AS query_id", "text")
    one = rows_of(search.search(docs, queries, 5))
    assert [blocks for _, blocks in read] == [1, 1, 1] and read[1][0] + read[2][0] == 400
    read.clear()
    assert rows_of(search.search(docs, queries, 5, terms_per_block=200)) == one
    assert len(read) == 3 and all(blocks > 5 for _, blocks in read)


def test_a_shard_answers_block_after_block(monkeypatch):
    """Kinds of documents, products or lists, and words asked for earlier change no result."""
    rng, n = random.Random(16), 300
    texts = [" ".join(f"{'abc'[i % 3]}{int(rng.paretovariate(0.5)) % 300}" for _ in range(30)) for i in range(n)]
    texts[90], texts[31] = texts[30], " "
    held = [Counter(t.split()) for t in texts]
    idf = {w: 0.5 + i % 11 / 3 for i, w in enumerate(sorted({w for c in held for w in c}))}

    def block(ids):
        rows = zip(*[(q, w, idf[w]) for q in ids for w in held[q]], strict=True)
        return search.Queries(pa.table(dict(zip(("query_id", "word", "idf"), rows, strict=True))))

    blocks = [block(range(a, n, 7)) for a in range(3)]
    for cells in (0, 1, 1 << 30):  # all lists, by cost, all products
        monkeypatch.setattr(search, "PRODUCTS", cells)
        monkeypatch.setattr(search, "POSTINGS", 1 + cells % 1000)
        shard = search.Shard(blocks[0], 30.0)
        shard.add(pa.array(range(100)), pa.array(texts[:100]))
        shard.add(pa.array(range(100, n)), pa.array(texts[100:]))
        shard.index()
        for queries in blocks:
            shard.ask(queries)
            for query, (docs, scores) in zip(queries.ids, shard.tops(4), strict=True):
                full = [
                    sum(idf[w] * (c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * c.total() / 30))) for w in sorted(held[query]) if w in c)
                    for c in held
                ]
                best = sorted((i for i in range(n) if full[i]), key=lambda i: (-round(full[i], 9), i))[:4]
                assert list(docs) == best and [round(x, 9) for x in scores] == [round(full[i], 9) for i in best]


def test_seed_runs_have_few_shards(spark, monkeypatch):
    """Also where a shuffle has many partitions: every shard gives its best to every query."""
    kind, given = type(spark.range(1)), type(spark.range(1)).repartition

    def raised(df, count, *columns):
        return given(df, max(64, count), *columns) if isinstance(count, int) else given(df, 64, count)

    monkeypatch.setattr(kind, "repartition", raised)
    docs = spark.range(6400).selectExpr("id AS doc_id", "'a' AS text")
    some = search._seed(docs, 64, 1)
    assert some.rdd.getNumPartitions() <= 4 and 30 < some.count() < 300


def test_pieces_are_learnt_once_beside_white_space(monkeypatch):
    """A text with white space at the ends of pieces has the tokenizer's ids, and costs them once."""
    from tokenizers import Tokenizer

    given = Tokenizer.from_file(vocabulary_path())
    word = " naïve-word's"
    texts = ["a" + word * 3 + " \n b" + word * 3 + "  c\t" + word, "É" + word + " !? 12 x. \n", None, ""]
    calls, plain = [], tokens._PARTS

    class Counting:
        def findall(self, piece):
            calls.append(piece)
            return plain.findall(piece)

    monkeypatch.setattr(tokens, "_PARTS", Counting())
    encode = tokens.text_encoder.__wrapped__(vocabulary_path())
    ids, offsets = encode(pa.array(texts))
    expected = [given.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [ids[a:b].tolist() for a, b in itertools.pairwise(offsets)] == expected
    assert calls.count(word) == 1


def test_search_of_odd_rows(docs, no_docs):
    found = search.search(docs, docs.selectExpr("doc_id AS query_id", "text"), 3)
    assert {r.doc_id for r in found.where("query_id = 5").collect()} == {5}
    assert rows_of(search.every_50th(no_docs)) == []


# --- classifiers ---------------------------------------------------------------------


def test_codewords_are_apart():
    for languages in (2, 4, 6, 12):
        code = language_id.codewords(languages).astype(int)
        assert len({tuple(c) for c in code}) == languages
        odds = language_id.decode(code * 3.0, code)
        assert (odds.argmax(axis=1) == np.arange(languages)).all()


def test_languages_of_odd_rows(spark, docs, no_docs):
    sample = [("the house and the garden of them", "en"), ("das haus und der garten", "de")] * 5
    teach = spark.createDataFrame([*sample, (None, "de"), ("x", None)], "text string, lang string")
    model = language_id.train(teach)
    got = {r.doc_id: r.lang_pred for r in language_id.identify(docs, model).collect()}
    assert got[2] == got[3] == got[6] == "und" and got[1] == "en"
    assert rows_of(language_id.identify(no_docs, model)) == []
    none = language_id.identify(docs, language_id.train(teach.limit(0)))
    assert {r.lang_pred for r in none.collect()} == {"und"}


def test_disguised_words_are_restored(spark):
    corpus = "the idiot was stupid and a loser but the clown is not a moron or so " * 30
    lm = toxicity.language_model(spark.createDataFrame([(corpus,), (None,)], "text string"))
    for disguise, word in (
        ("stup1d", "stupid"), ("$tupid", "stupid"), ("s.t.u.p.i.d", "stupid"), ("l0ser", "loser"),
        ("stuuuupid", "stupid"), ("cl0wn!", "clown"), ("idi0t", "idiot"),
    ):
        assert word in toxicity.words_in(disguise, lm), disguise


@pytest.fixture(scope="module")
def small_model(spark):
    corpus = "the idiot was a stupid one and you are a loser but the clown is not so dumb " * 30
    return toxicity.language_model(spark.createDataFrame([(corpus,)], "text string"))


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("a s t u p i d", {"a", "stupid"}),
        ("y o u i d i o t", {"you", "idiot"}),
        ("$ t u p i d", {"stupid"}),
        ("i d 1 o t, really", {"idiot"}),
        ("so d u m b", {"dumb"}),
        ("n o t", {"not"}),
        ("t h e c l o w n i s n o t a s t u p i d i d i o t", {"clown", "stupid", "idiot"}),
    ],
)
def test_words_written_apart_are_found(small_model, text, expected):
    [(groups, _)] = toxicity.Reader(small_model).read(pa.array([text]))
    assert expected <= {w for group in groups for w in group}


@pytest.mark.parametrize(
    ("piece", "expected"),
    [
        ("i" * 60 + "diot", {"idiot"}),
        ("s.t.u.p.i.d.i.d.i.o.t", {"stupid", "idiot"}),
        ("t-h-e-c-l-o-w-n-i-s-n-o-t-s-o-s-t-u-p-i-d-b-u-t-y-o-u-a-r-e", {"clown", "stupid", "you"}),
        ("stuupiid", {"stupid"}),
    ],
)
def test_stretches_are_restored_whole(small_model, piece, expected):
    assert expected <= set(toxicity.words_in(piece, small_model))


def path_score(choices, odds, eager):
    """Log-probability of one way through the lattice, letter by letter."""
    before, total = (0, 0), 0.0
    for letters, cost in [*choices, (" ", 0.0)]:
        total -= cost
        for c in map(toxicity.char_class, letters):
            if c:
                total += float(odds[before[0], before[1], c])
                before = before[1], c
            elif before[1]:
                total += float(odds[before[0], before[1], 0]) + eager
                before = 0, 0
    return total


@pytest.mark.parametrize("apart, eager", [(False, 0.0), (True, 0.0), (True, 2.0)])
def test_decoding_finds_the_best_of_all_paths(apart, eager):
    rng, pick = np.random.default_rng(5), random.Random(5)
    odds = np.log(rng.dirichlet(np.ones(64), (64, 64))).astype(np.float32)
    signs = "abeiost" + "013$@!.-é"
    for _ in range(150):
        repeats = [pick.choice([1, 1, 1, 2, 3, 7]) for _ in range(pick.randint(1, 5))]
        word = "".join(pick.choice(signs) * n for n in repeats)
        places = [
            [o[:2] for o in toxicity._options(m.group(1), min(3, len(m.group())), apart)]
            for m in re.finditer(r"(.)\1*", word)
        ]
        best = max(itertools.product(*places), key=lambda way: path_score(way, odds, eager))
        expected = "".join(letters for letters, _ in best).strip()
        assert toxicity.restore(word, odds, apart, eager) == expected, word


def test_plain_words_are_read_like_all_others(small_model):
    rng = random.Random(8)
    ends = ["", ".", "***", "!", "'s", "$", "_", "\u00a0", "7"]
    stems = ["Stupid", "you", "hello", "ÀÖß", "idiot", "İx", "µm", "x", "a", "$tupid", "naïve"]
    words = [rng.choice(["", '"', "(", "-"]) + rng.choice(stems) + rng.choice(ends) for _ in range(900)]
    texts = pa.array([" ".join(words[a : a + 7]) for a in range(0, 900, 7)] + [None, "", " "])
    features = ["stupid$", "stu", "idiot$", "hel", "àöß$", "naïve$", "i\u0307x$", "a$"]
    value = toxicity._indexed(features)
    by_word = toxicity.Reader(small_model).read(texts)
    by_feature = toxicity.Reader(small_model, features, most=5).read(texts)
    for text, (groups, n), (told, m) in zip(texts.to_pylist(), by_word, by_feature, strict=True):
        assert n == m
        pieces = re.split(r"[ \t\n\r\f\v]+", text or "")
        known = Counter(w for p in pieces for w in toxicity.words_in(p, small_model))
        assert known <= Counter(w for group in groups for w in group)
        expected = Counter(f for group in groups for f in value(tuple(group)))
        assert Counter(f for group in told for f in group) == expected


def test_toxicity_learns_and_takes_odd_rows(spark, docs, no_docs):
    rng = random.Random(6)
    plain = [f"w{i}" for i in range(50)]
    rows, labels = [], []
    for i in range(400):
        own = [rng.choice(plain) for _ in range(30)]
        if i % 4 == 0:
            own[3] = own[9] = "nasty"
        rows.append((i, " ".join(own)))
        labels.append((i, None if i % 37 == 0 else int(i % 4 == 0)))
    corpus = spark.createDataFrame(rows, "doc_id bigint, text string")
    marked = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model, lm = toxicity.learn(corpus, marked)
    more = spark.createDataFrame([(1000, "w1 w2 n@sty w3 n a s t y")], "doc_id bigint, text string")
    scores = {r.doc_id: r.score for r in toxicity.score_toxicity(corpus.union(more), model, lm).collect()}
    assert scores[1000] > 0.3
    assert all((scores[i] >= 0.3) == (i % 4 == 0) for i in range(400))
    odd = toxicity.score_toxicity(docs, model, lm)
    assert odd.count() == docs.count() and odd.where("score IS NULL").count() == 0
    kept = toxicity.drop_toxic(docs, marked)
    assert kept.columns == docs.columns
    assert rows_of(toxicity.toxicity_digest(no_docs, marked.limit(0))) == []


def test_words_are_those_of_the_contract(docs):
    for r in docs.collect():
        assert [w.decode() for w in words_of(r.text)] == words(r.text)

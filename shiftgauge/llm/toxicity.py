"""Toxicity of texts that may be disguised.

Noisy channel: a word may have been written with look-alike characters, repeated letters,
signs between letters or its letters apart. Its character lattice holds what each sign may
stand for; Viterbi decoding finds the likeliest path under a character trigram model of the
corpus and the costs of the channel. Signs between letters, and in a run of single letters every
letter, may be followed by a word break. Stretches and runs of any length are decoded whole; a
repetition is one step, however long. The restored text is scored by a logistic model over
words and their first letters, learnt from labels.

The language model counts the trigrams of every word of every document given: each task sums
its own, a shuffle sums those of the tasks. The alphabet has ``CLASSES`` classes, which
bounds the model. The score model is fitted on at most ``max_training_rows`` labelled rows,
those with the least hash of their id; beyond that bound nothing is sampled.

NULL and empty texts score like a text without any known word; without labels of both
kinds every score is 0. Labels that are NULL teach nothing; a document labelled more than
once counts as toxic if one of its labels says so. Repeated rows are answered each.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shiftgauge.checkpoints import store
from shiftgauge.llm.rows import give_back, held_out, put_back, set_apart, text_chunks

CLASSES = 64
PREFIXES = range(3, 9)

# What a sign may stand for.
_LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e",
    "*": "aeiou", "#": "aeiou",
}
# Costs of the channel, in nats: a look-alike, a sign left out, a repetition undone.
_SWAP, _DROP, _DROP_LOOK, _UNDO = 1.0, 0.5, 5.0, 0.3
# Three letters hardly tell where words end, so a restored word of ``_LONG`` letters is also read
# with so many nats for each word break.
_LONG, _EAGER = 8, 2.0

_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_WORDS = re.compile(r"[^\W\d_]+")
_SIGN_FIRST = re.compile(r"[$@|(€+][^\W\d_]")
_TWICE = re.compile(r"(.)\1")
_REPEATED = re.compile(r"(.)\1+", re.DOTALL)
_LETTERS_OR_ONE = re.compile(r"[^\W\d_]+|.", re.DOTALL)
# A word of Latin letters without a doubled one, marks around it: nothing to restore.
_PLAIN = r"""^["'.,;:!?-]*[A-Za-zÀ-ÖØ-öø-ÿ]+[!-/:-@\[-`{-~]*$"""
_DOUBLED = "|".join(chr(c) * 2 for c in [*range(97, 123), *range(223, 247), *range(248, 256)])
_MARKS = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]))
# What no reading of a stretch depends on, at its end.
_LAST = ".,;:?\"'"


@lru_cache(maxsize=1 << 14)
def char_class(char: str) -> int:
    """0 outside words; a to z; other letters share the rest of the classes."""
    if "a" <= char <= "z":
        return ord(char) - 96
    return 27 + ord(char) % (CLASSES - 27) if char.isalpha() else 0


# --- language model ----------------------------------------------------------------


def _class_table() -> np.ndarray:
    return np.array([char_class(chr(c).lower()[:1]) for c in range(0x3000)], np.int64)


def count_trigrams(docs: DataFrame) -> DataFrame:
    """code, n: character trigrams of all texts, words padded by a class-0 sign."""

    def run(batches):
        table = _class_table()
        total = np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            for value in batch.column("text"):
                text = value.as_py()
                for at in range(0, len(text or ""), 1 << 20):
                    # Stretches overlap by two characters, so every trigram counts once.
                    part = text[max(0, at - 2) : at + (1 << 20)]
                    padded = part if at else " " + part
                    padded += " " if at + (1 << 20) >= len(text) else ""
                    chars = np.frombuffer(padded.encode("utf-32-le", "replace"), "<u4")
                    c = table[np.minimum(chars, len(table) - 1)]
                    code = (c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:]
                    total += np.bincount(code[c[1:-1] > 0], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["code", "n"]
        )

    texts = docs.select(F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    return texts.mapInArrow(run, "code int, n bigint").groupBy("code").agg(F.sum("n").alias("n"))


def language_model(docs: DataFrame) -> np.ndarray:
    """Log-probability of a class after two others, smoothed by shorter contexts."""
    n = np.zeros(CLASSES**3)
    for code, count in count_trigrams(docs).collect():  # CLASSES**3 rows at most
        n[code] = count
    n = n.reshape((CLASSES,) * 3)
    one = n.sum(axis=(0, 1)) + 1
    one /= one.sum()
    two = n.sum(axis=0)
    two = (two + 5 * one) / (two.sum(axis=1, keepdims=True) + 5)
    three = (n + 5 * two[None]) / (n.sum(axis=2, keepdims=True) + 5)
    # After a word break: the first letters of words.
    first = n[0].sum(axis=1)
    three[:, 0] = (first + 5 * one) / (first.sum() + 5)
    return np.log(three).astype(np.float32)


# --- noisy channel -----------------------------------------------------------------


@lru_cache(maxsize=1 << 16)
def _options(char: str, n: int, apart: bool) -> tuple[tuple[str, float, tuple[int, ...]], ...]:
    """What a sign that stands ``n`` times may stand for, the cost, and the classes of the letters.

    Three times is the same as more.
    """
    if char.isalpha():
        options = [(char, 0.0 if n == 1 else _UNDO)]
        if n >= 2:
            twice = 0.0 if n == 2 else _UNDO
            options += [(char * 2, twice)] + [(f"{char} {char}", twice)] * apart
    else:
        drop = _DROP_LOOK if char in _LOOKS_LIKE else _DROP
        options = [("", drop), (" ", drop)]
        for letter in _LOOKS_LIKE.get(char, ""):
            options.append((letter, _SWAP))
            if n >= 2:
                options.append((letter * 2, _SWAP))
    if apart:
        options += [(letters + " ", cost) for letters, cost in options if letters.strip()]
    return tuple((letters, cost, tuple(map(char_class, letters))) for letters, cost in options)


_END = ((" ", 0.0, (0,)),)


def _steps(word: str, apart: bool) -> list[tuple]:
    """Options along a stretch; letters next to each other that stand once are one step."""
    steps, at = [], 0
    for m in [*_REPEATED.finditer(word), None]:
        for part in _LETTERS_OR_ONE.findall(word[at : m.start() if m else len(word)]):
            if apart or len(part) == 1:
                steps += [_options(char, 1, apart) for char in part]
            else:
                steps.append(((part, 0.0, tuple(map(char_class, part))),))
        if m:
            steps.append(_options(m.group(1), min(3, m.end() - m.start()), apart))
            at = m.end()
    return steps


def log_odds(model: np.ndarray) -> list[float]:
    """The model as ``restore`` looks it up: by the classes of three letters, in one number."""
    return model.ravel().tolist()


def restore(
    word: str, model: np.ndarray | list[float], apart: bool = False, eager: float = 0.0
) -> str:
    """The likeliest undisguised words of a lower-case stretch, by Viterbi decoding.

    ``apart`` says that its letters were written apart, so a word may end after each;
    ``eager`` is what a word break gains. ``model`` is the language model or its ``log_odds``.
    """
    odds = model if isinstance(model, list) else log_odds(model)
    # A path is its score and the letters of its steps, each with those before it. Its state is
    # the classes of its last two letters, CLASSES * first + second.
    paths = {0: (0.0, None)}
    for options in [*_steps(word, apart), _END]:
        better: dict[int, tuple[float, tuple | None]] = {}
        for begin, (score, done) in paths.items():
            for letters, cost, classes in options:
                state, s = begin, score - cost
                for c in classes:
                    if c:
                        code = state * CLASSES + c
                        s += odds[code]
                        state = code % (CLASSES * CLASSES)
                    elif state:
                        s += odds[state * CLASSES] + eager
                        state = 0
                old = better.get(state)
                if old is None or s > old[0]:
                    better[state] = (s, (done, letters))
        paths = better
    done, found = max(paths.values(), key=lambda path: path[0])[1], []
    while done:
        done, letters = done
        found.append(letters)
    return "".join(reversed(found)).strip()


def _restored(form: str, model: np.ndarray | list[float], apart: bool = False) -> list[str]:
    words = restore(form, model, apart).split()
    if (apart or not form.isalpha()) and any(len(w) >= _LONG for w in words):
        words += restore(form, model, apart, _EAGER).split()
    return words


def words_in(piece: str, model: np.ndarray | list[float]) -> tuple[str, ...]:
    """Lower-case words of a stretch without white space, and those of its restored forms."""
    low = piece.lower()
    core = _EDGE.sub("", low)
    if core.isalpha() and not _TWICE.search(core) and not _SIGN_FIRST.match(low):
        words = [core]
    else:
        words = _WORDS.findall(low)
        # A look-alike may stand at an end ("$tupid", "idi0t!"), so both forms are tried.
        for form in {core, low.strip(_LAST)}:
            if len(form) >= 3 and any(map(str.isalpha, form)):
                if not form.isalpha() or _TWICE.search(form):
                    words += _restored(form, model)
    return tuple(w for w in dict.fromkeys(words) if w)


def lone_sign(piece: str) -> str:
    """The letter, digit or look-alike that a stretch consists of but for marks around; or nothing."""
    if len(piece) == 1:
        return piece if piece.isalnum() or piece in _LOOKS_LIKE else ""
    core = _EDGE.sub("", piece) if len(piece) <= 4 else ""
    return core if len(core) == 1 else ""


def words_apart(letters: str, model: list[float]) -> tuple[str, ...]:
    """Words of a run of signs that stood apart."""
    if not any(map(str.isalpha, letters)):
        return ()
    return tuple(dict.fromkeys(_restored(letters.lower(), model, apart=True)))


def features_of(word: str) -> list[str]:
    return [word + "$", *[word[:n] for n in PREFIXES if n <= len(word)]]


def _pieces(texts: pa.Array):
    """Codes of all stretches without white space, where texts begin, the different stretches."""
    split = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    coded = split.flatten().dictionary_encode()
    starts = split.offsets.to_numpy()
    return coded.indices.to_numpy().astype(np.int64), starts, coded.dictionary


class Reader:
    """What counts of texts: their words, restored ones included, or the features among ``features``.

    Plain words are told in Arrow; what other stretches stand for is kept, up to a bound.
    """

    def __init__(
        self, model: np.ndarray, features: list[str] | None = None, most: int = 150_000
    ):
        self.model, self.most = log_odds(model), most
        self.value = tuple if features is None else _indexed(features)
        self.features = None if features is None else pa.array(features, pa.large_string())
        self.known: dict[tuple, tuple] = {}

    def of(self, piece: str, words=words_in) -> tuple:
        piece = piece.lower().rstrip(_LAST)
        key = words, piece
        made = self.known.get(key)
        if made is None:
            made = self.value(words(piece, self.model))
            if len(piece) <= 256:
                if len(self.known) >= self.most:  # the older half goes
                    for old in list(islice(self.known, self.most // 2)):
                        del self.known[old]
                self.known[key] = made
        return made

    def _values(self, different: pa.Array) -> list[tuple]:
        values = [()] * len(different)
        low = pc.utf8_lower(different)
        plain = pc.and_not(
            pc.match_substring_regex(different, _PLAIN), pc.match_substring_regex(low, _DOUBLED)
        )
        told = plain
        if self.features is not None:
            told = pc.and_(plain, _may_tell(pc.utf8_trim(low, characters=_MARKS), self.features))
        told, rough = told.to_numpy(zero_copy_only=False), pc.invert(plain)
        cores = pc.utf8_trim(low.filter(told), characters=_MARKS).to_pylist()
        for i, core in zip(np.flatnonzero(told).tolist(), cores, strict=True):
            values[i] = self.value((core,))
        at = np.flatnonzero(rough.to_numpy(zero_copy_only=False)).tolist()
        for i, piece in zip(at, different.filter(rough).to_pylist(), strict=True):
            values[i] = self.of(piece)
        return values

    def read(self, texts: pa.Array):
        """Per text: its values and how many stretches it has."""
        for part in text_chunks(pa.RecordBatch.from_arrays([texts], names=["text"]), "text"):
            yield from self._read(part.column("text"))

    def _read(self, texts: pa.Array):
        codes, starts, different = _pieces(texts)
        values = self._values(different)
        filled = np.fromiter(map(bool, values), bool, len(values))[codes]
        short = np.flatnonzero(pc.utf8_length(different).to_numpy(zero_copy_only=False) <= 4)
        signs = dict(zip(short.tolist(), map(lone_sign, different.take(short).to_pylist())))
        alone = np.zeros(len(values), bool)
        alone[[i for i, sign in signs.items() if sign]] = True
        apart = alone[codes]
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            out = [values[c] for c in codes[a:b][filled[a:b]].tolist()]
            if apart[a:b].any():
                edges = np.flatnonzero(np.diff(np.r_[False, apart[a:b], False].astype(np.int8)))
                for s, e in edges.reshape(-1, 2).tolist():
                    if e - s >= 2:  # letters written apart
                        letters = "".join([signs[c] for c in codes[a + s : a + e].tolist()])
                        out.append(self.of(letters, words_apart))
            yield out, b - a


def _may_tell(words: pa.Array, features: pa.Array) -> pa.Array:
    """Whether a word may have one of the features; some that have none are among them."""
    end, none = pa.scalar("$", words.type), pa.scalar("", words.type)
    may = pc.is_in(pc.binary_join_element_wise(words, end, none), features)
    for n in PREFIXES:
        may = pc.or_(may, pc.is_in(pc.utf8_slice_codeunits(words, 0, n), features))
    return may


# --- score model -------------------------------------------------------------------


def labelled(docs: DataFrame, labels: DataFrame, max_training_rows: int) -> DataFrame:
    """text and toxic of the documents that labels teach about, within the bound."""
    marked = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    marked = marked.where("_id IS NOT NULL AND toxic IS NOT NULL").groupBy("_id")
    marked = marked.agg(F.max("toxic").alias("toxic"))
    least = marked.orderBy(F.xxhash64("_id"), "_id").limit(max_training_rows)
    # At most max_training_rows pairs of numbers.
    return docs.join(F.broadcast(least), F.col("doc_id") == F.col("_id")).select("text", "toxic")


@lru_cache(maxsize=1)  # the tasks of a worker process share what they have decoded
def _word_reader(lm: Broadcast) -> Reader:
    return Reader(lm.value)


def _words_of_rows(rows: DataFrame, lm: Broadcast) -> DataFrame:
    """words, times (how often each stands), length and toxic of labelled texts."""

    def run(batches):
        reader = _word_reader(lm)
        for batch in (part for whole in batches for part in text_chunks(whole)):
            words, times, length = [], [], []
            for groups, n in reader.read(batch.column("text")):
                own = Counter(w for group in groups for w in group)
                words.append(list(own))
                times.append(list(own.values()))
                length.append(math.log1p(n))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(words, pa.list_(pa.string())),
                    pa.array(times, pa.list_(pa.int32())),
                    pa.array(length, pa.float64()),
                    batch.column("toxic"),
                ],
                names=["words", "times", "length", "toxic"],
            )
        give_back()

    schema = "words array<string>, times array<int>, length double, toxic int"
    return rows.mapInArrow(run, schema)


def _feature_counts(read: DataFrame) -> DataFrame:
    """feature, toxic and clean documents that have it; tasks add up before the shuffle."""

    def run(batches):
        counts = {0: Counter(), 1: Counter()}
        for batch in batches:
            labels = batch.column("toxic").to_pylist()
            for words, toxic in zip(batch.column("words"), labels, strict=True):
                own = {f for w in words.as_py() for f in features_of(w)}
                counts[toxic > 0].update(own)
                if len(counts[0]) + len(counts[1]) > 200_000:
                    yield from _counted(counts)
        yield from _counted(counts)
        give_back()

    made = read.select("words", "toxic").mapInArrow(
        run, "feature string, toxic bigint, clean bigint"
    )
    return made.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _counted(counts: dict[int, Counter]):
    """What was counted, as rows; the counters start anew."""
    for toxic, own in counts.items():
        n, none = pa.array(list(own.values()), pa.int64()), pa.array(np.zeros(len(own), np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(own), pa.string()), n if toxic else none, none if toxic else n],
            names=["feature", "toxic", "clean"],
        )
        own.clear()


def _telling(counts: DataFrame, n_toxic: int, n_clean: int, most: int) -> list[str]:
    """The features that speak most for label 1, by the likelihood ratio of their counts."""

    def part(a, share):
        return F.when(a > 0, a * F.log(a / share)).otherwise(F.lit(0.0))

    a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
    share = n_toxic / (n_toxic + n_clean)
    ratio = 2 * (part(a, (a + b) * share) + part(b, (a + b) * (1 - share)))
    good = counts.where((F.col("toxic") >= 3) & (a > (a + b) * share)).withColumn("ratio", ratio)
    top = good.where(F.col("ratio") > 8).orderBy(F.desc("ratio"), "feature").limit(most)
    return [r[0] for r in top.select("feature").collect()]


def _vectors(texts: pa.Array, reader: Reader):
    """Per text: features with what counts for each, and the log of the length."""
    for groups, n in reader.read(texts):
        own = Counter(f for group in groups for f in group)
        yield list(own), [math.log1p(v) for v in own.values()], math.log1p(n)


def _indexed(features: list[str]):
    index = {f: i for i, f in enumerate(features)}

    def value(words: tuple[str, ...]) -> tuple[int, ...]:
        return tuple(index[f] for w in words for f in features_of(w) if f in index)

    return value


def fit(
    docs: DataFrame,
    labels: DataFrame,
    lm: np.ndarray,
    *,
    max_training_rows: int = 40_000,
    max_features: int = 4096,
) -> tuple[list[str], np.ndarray]:
    """Features and their weights; the last two are for the length and the constant."""
    shared = docs.sparkSession.sparkContext.broadcast(lm)
    # Decoded once: both the choice of features and the vectors read the stored words.
    read, seen = store(
        _words_of_rows(labelled(docs, labels, max_training_rows), shared),
        toxic=F.count(F.when(F.col("toxic") > 0, 1)),
        rows=F.count(F.lit(1)),
    )
    n_toxic, n_clean = seen["toxic"], seen["rows"] - seen["toxic"]
    if not n_toxic or not n_clean:
        return [], np.array([0.0, -np.inf])
    features = _telling(_feature_counts(read), n_toxic, n_clean, max_features)

    def vectors(batches):
        value = _indexed(features)
        for batch in batches:
            at, values = [], []
            for words, times in zip(batch.column("words"), batch.column("times"), strict=True):
                own = Counter()
                for word, n in zip(words.as_py(), times.as_py(), strict=True):
                    for f in value((word,)):
                        own[f] += n
                at.append(list(own))
                values.append([math.log1p(n) for n in own.values()])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(at, pa.list_(pa.int32())),
                    pa.array(values, pa.list_(pa.float32())),
                    batch.column("length"),
                    batch.column("toxic"),
                ],
                names=["at", "value", "length", "toxic"],
            )

    schema = "at array<int>, value array<float>, length double, toxic int"
    sparse = read.mapInArrow(vectors, schema)

    def solve(batches):
        table = pa.Table.from_batches(list(batches))  # max_training_rows at most
        made = pa.array(_logistic(table, len(features)))
        del table
        give_back()
        yield pa.RecordBatch.from_arrays([made], names=["weight"])

    weights = sparse.repartition(1).mapInArrow(solve, "weight double").collect()
    return features, np.array([r[0] for r in weights])


def _logistic(table: pa.Table, n: int, steps: int = 150, penalty: float = 0.3) -> np.ndarray:
    """Penalised logistic regression by accelerated gradient steps, one scale per feature."""
    lists = table.column("at").combine_chunks()
    cols = lists.values.to_numpy()
    vals = table.column("value").combine_chunks().values.to_numpy().astype(np.float64)
    rows = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    y = (table.column("toxic").to_numpy() > 0).astype(np.float64)
    length = table.column("length").to_numpy()
    m = len(y)
    # The length and the constant are two dense columns of the same matrix.
    cols = np.concatenate([cols, np.full(m, n), np.full(m, n + 1)])
    rows = np.concatenate([rows, np.arange(m), np.arange(m)])
    vals = np.concatenate([vals, length, np.ones(m)])
    lone = np.full(n + 2, penalty)
    lone[n:] = 1e-6
    # Rows have several features each, so steps of one feature are shortened by their number.
    busy = np.bincount(rows, np.abs(vals), m)
    scale = 0.25 * np.bincount(cols, np.abs(vals) * busy[rows], n + 2) + lone + 1e-9
    w = np.zeros(n + 2)
    w[n + 1] = math.log((y.sum() + 1) / (m - y.sum() + 1))
    ahead, t = w.copy(), 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.bincount(rows, vals * ahead[cols], m)))
        step = np.bincount(cols, vals * (p - y)[rows], n + 2) + lone * ahead * (scale > 0)
        new = ahead - step / scale
        t, before = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
        ahead, w = new + (before - 1) / t * (new - w), new
    return w


@lru_cache(maxsize=1)
def _feature_reader(shared: Broadcast) -> Reader:
    features, _, lm = shared.value
    return Reader(lm, features)


def score_toxicity(
    docs: DataFrame, model: tuple[list[str], np.ndarray], lm: np.ndarray
) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) of each row; a column of that name is replaced."""
    features, weights = model
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((features, weights, lm))
    docs = docs.drop("score").withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        weights = shared.value[1]
        reader = _feature_reader(shared)
        own, per_length, constant = weights[:-2], weights[-2], weights[-1]
        for batch in batches:
            for part in text_chunks(batch):
                scores = []
                for at, values, length in _vectors(part.column("text"), reader):
                    z = constant + per_length * length + float(np.dot(own[at], values) if at else 0)
                    scores.append(1 / (1 + math.exp(-z)) if z > -700 else 0.0)
                columns = [c.cast(t) for c, t in zip(part.columns, arrow.types, strict=False)]
                scored = pa.array(scores, pa.float64())
                yield pa.RecordBatch.from_arrays([*columns, scored], schema=arrow)
        give_back()

    return docs.mapInArrow(run, schema)


def learn(docs: DataFrame, labels: DataFrame, kept_out=None, **bounds):
    """Language model of all ``docs``, score model of the labelled ones that are not kept out."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    lm = language_model(rows)
    teach = rows if kept_out is None else rows.where(~kept_out)
    return fit(teach, labels, lm, **bounds), lm


def toxicity_digest(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row, learnt from rows not held out."""
    kept_out = held_out(F.col("doc_id"), 4, 2)
    model, lm = learn(docs, labels, kept_out)
    rows = docs.select("doc_id", kept_out.alias("held_out"), "text")
    scored = score_toxicity(rows, model, lm).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``docs`` without those that score ``threshold`` or more."""
    model, lm = learn(docs, labels)
    scored = score_toxicity(set_apart(docs), model, lm).where(F.col("score") < threshold)
    return put_back(scored, docs.columns)

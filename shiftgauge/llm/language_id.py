"""Language identification with error-correcting output codes.

Every language has a codeword of bits; one binary classifier per bit, over hashed character
2- and 3-grams, says how strongly a text speaks for a one. Loss-weighted decoding takes the
codeword with the least logistic loss over all bits; languages that come close mark the text
as ambiguous.

The classifiers are log-odds of n-gram counts, learnt from every text given for learning:
counts per language and n-gram are summed in the tasks and once more after a shuffle, and
their number is bounded by the languages times ``BUCKETS``. Texts without letters and NULL
are ``und``; learning skips NULL texts and NULL languages; without any language everything
is ``und``. Repeated rows are answered each. Ties go to the first language by name. A table
of more than ``MAX_LANGUAGES`` different languages is refused.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftgauge.llm.rows import give_back, held_out, text_chunks

BUCKETS = 1 << 15
MAX_LANGUAGES = 500
UNKNOWN = "und"

_AT_ONCE = 1 << 20  # characters
_ALPHABET = 0x3000  # characters above share classes


def codewords(languages: int, seed: int = 7) -> np.ndarray:
    """One row of +1/-1 per language: all splits for few languages, else far random words."""
    if languages <= 6:
        columns = [
            [1 if (c >> i) & 1 else -1 for i in range(languages)]
            for c in range(1, 1 << (languages - 1))
        ]
        return np.array(columns, np.int8).T.reshape(languages, len(columns))
    bits = max(15, int(10 * np.log2(languages)))
    rng = np.random.default_rng(seed)
    best, apart = None, -1
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], np.int8), (languages, bits))
        code = code[:, np.abs(code.sum(axis=0)) < languages]
        gram = code.astype(np.int32) @ code.T.astype(np.int32)
        least = int(((code.shape[1] - gram) // 2 + np.eye(languages) * bits).min())
        if least > apart:
            best, apart = code, least
    return best


def _classes() -> np.ndarray:
    """Character classes: 0 separates words, letters are themselves in lower case."""
    table = np.zeros(_ALPHABET, np.int64)
    for c in range(_ALPHABET):
        char = chr(c)
        if char.isalpha():
            low = char.lower()
            table[c] = ord(low[0]) if ord(low[0]) < _ALPHABET else c
    return table


def _grams(
    texts: list[str], classes: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed 2- and 3-grams of the joined texts, and where each text's begin.

    ``BUCKETS`` is no n-gram.
    """
    joined = "  ".join(texts) + "  "
    chars = np.frombuffer(joined.encode("utf-32-le", "replace"), "<u4").astype(np.int64)
    letter = classes[np.minimum(chars, _ALPHABET - 1)]
    if (chars >= _ALPHABET).any():
        for c in np.unique(chars[chars >= _ALPHABET]):
            if chr(c).isalpha():
                letter[chars == c] = _ALPHABET + c % 997
    starts = np.cumsum([0, *[len(t) + 2 for t in texts]])
    a, b = letter[:-2], letter[1:-1]
    c = letter[2:]
    two = (a * 31_337 + b * 2_654_435_761 + 17) % 4_294_967_291 % BUCKETS
    three = (a * 961_748_941 + b * 373_587_883 + c * 67_867_979 + 5) % 4_294_967_291 % BUCKETS
    # Only n-grams with a letter in front and those that start a word count.
    real = (a > 0) | (b > 0)
    return np.where(real, two, BUCKETS), np.where(real, three, BUCKETS), starts


def _stretches(sizes: list[int]) -> list[list[int]]:
    """Neighbouring rows that make about ``_AT_ONCE`` characters, empty ones left out."""
    part = (np.cumsum(sizes) // _AT_ONCE).tolist()
    groups: dict[int, list[int]] = {}
    for i, p in enumerate(part):
        if sizes[i]:
            groups.setdefault(p, []).append(i)
    return list(groups.values())


def count_ngrams(docs: DataFrame) -> DataFrame:
    """lang, bucket, n over ``docs`` (text, lang)."""

    def run(batches):
        classes = _classes()
        sums: dict[str, np.ndarray] = {}
        for batch in (part for whole in batches for part in text_chunks(whole)):
            langs = batch.column("lang").to_pylist()
            texts = batch.column("text").to_pylist()
            for lang in set(langs):
                own = [t for t, x in zip(texts, langs, strict=True) if x == lang]
                for part in _stretches([len(t) for t in own]):
                    made = np.zeros(BUCKETS + 1, np.int64)
                    for codes in _grams([own[i] for i in part], classes)[:2]:
                        made += np.bincount(codes, minlength=BUCKETS + 1)
                    sums[lang] = sums[lang] + made if lang in sums else made
        for lang, n in sums.items():
            at = np.flatnonzero(n[:BUCKETS])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())],
                names=["lang", "bucket", "n"],
            )
        give_back()

    rows = docs.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    counted = rows.mapInArrow(run, "lang string, bucket int, n bigint")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages by name, their codewords, and per bit a weight for every bucket."""
    counts = count_ngrams(docs)
    languages = [r[0] for r in counts.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()]
    languages.sort()
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table = np.zeros((len(languages), BUCKETS))
    for lang, bucket, n in counts.collect():  # languages x BUCKETS at most
        table[languages.index(lang), bucket] = n
    if not languages:
        return [], np.ones((0, 1), np.int8), np.zeros((1, BUCKETS + 1), np.float32)
    code = codewords(len(languages))
    # Each language weighs the same, however much there is of it.
    share = (table + 0.5) / (table + 0.5).sum(axis=1, keepdims=True)
    weights = np.zeros((code.shape[1], BUCKETS + 1), np.float32)
    for bit in range(code.shape[1]):
        one, zero = share[code[:, bit] > 0], share[code[:, bit] < 0]
        weights[bit, :BUCKETS] = np.log(one.mean(axis=0)) - np.log(zero.mean(axis=0))
    return languages, code, weights


def decode(margins: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Probability of each codeword, from the logistic losses over all bits."""
    losses = np.logaddexp(0, -margins[:, None, :] * code[None, :, :]).sum(axis=2)
    likely = np.exp(losses.min(axis=1, keepdims=True) - losses)
    return likely / likely.sum(axis=1, keepdims=True)


def identify(
    docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], ambiguous_below: float = 0.8
) -> DataFrame:
    """All columns of ``docs`` but ``text``, with lang_pred, score and ambiguous."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = ["lang_pred", "score", "ambiguous"]
    docs = docs.drop(*added).withColumn("text", F.col("text").cast("string"))
    kept = [c for c in docs.columns if c != "text"]
    schema = docs.select(*kept).selectExpr(
        "*", "'' AS lang_pred", "0D AS score", "true AS ambiguous"
    ).schema

    def run(batches):
        languages, code, weights = shared.value
        classes = _classes()
        for batch in (part for whole in batches for part in text_chunks(whole)):
            names, scores = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows
            texts = batch.column("text").to_pylist()
            for at in _stretches([len(t or "") for t in texts]) if languages else []:
                two, three, starts = _grams([texts[i] for i in at], classes)
                n = np.add.reduceat((two < BUCKETS).astype(np.int64), starts[:-1])
                margins = np.zeros((len(at), code.shape[1]))
                for bit, weight in enumerate(weights):
                    values = weight[two]
                    values += weight[three]
                    margins[:, bit] = np.add.reduceat(values, starts[:-1], dtype=np.float64)
                # Neighbouring n-grams overlap, so evidence grows with the root of their number.
                margins /= np.sqrt(np.maximum(n, 1))[:, None]
                odds = decode(margins, code)
                best = odds.argmax(axis=1)
                for j, i in enumerate(at):
                    if any(map(str.isalpha, texts[i])):
                        names[i], scores[i] = languages[best[j]], float(odds[j, best[j]])
            columns = [batch.column(c) for c in kept]
            columns += [pa.array(names), pa.array(scores, pa.float64())]
            columns.append(pa.array([s < ambiguous_below for s in scores], pa.bool_()))
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *added])
        give_back()

    return docs.select(*kept, "text").mapInArrow(run, schema)


def language_digest(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out, and answer for all."""
    kept_out = held_out(F.col("doc_id"), 3, 1)
    model = train(docs.where(~kept_out).select("text", "lang"))
    rows = docs.select("doc_id", kept_out.alias("held_out"), "text")
    return identify(rows, model)

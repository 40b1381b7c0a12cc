"""Personal data in texts.

Regular expressions propose spans, checksums confirm them (Luhn for cards, mod 97 for bank
accounts), words nearby adjust the score. Base kinds, always reported: ``email``, ``ip``,
``card`` and ``phone``, leftmost and not overlapping per kind, failing ones dropped. Added:
``iban``, ``ssn`` and ``birth`` (a date), the last two only with a word that speaks for them
within ``NEAR`` characters.

NULL and empty texts have none; rows repeat as they come; other columns are not read unless
a function says so. Every pattern takes time in proportion to the text.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftgauge.llm.rows import map_texts, put_back, set_apart

KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "birth")
BASE = KINDS[:4]
NEAR = 40

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_BIRTH = re.compile(r"(?<![0-9])(?:19|20)[0-9]{2}-[01][0-9]-[0-3][0-9](?![0-9])")

# Score without and with a word nearby that speaks for the kind, and the words.
_SCORES = {
    "email": (0.9, 1.0, ("mail", "contact", "write to")),
    "ip": (0.6, 0.9, ("ip", "address", "host", "server", "login")),
    "card": (0.8, 1.0, ("card", "visa", "credit", "payment", "karte", "carte", "tarjeta")),
    "phone": (0.8, 1.0, ("phone", "call", "tel", "mobile", "fax")),
    "iban": (0.9, 1.0, ("iban", "account", "bank", "konto", "compte", "cuenta")),
    "ssn": (0.3, 0.9, ("ssn", "social security")),
    "birth": (0.1, 0.8, ("born", "birth", "geboren", "naissance", "nacimiento")),
}
_LEAST = 0.5
_AGAINST = ("version", "isbn", "serial", "example only")


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def mod97(account: str) -> bool:
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str):
    """From each @ back over the local part, so that long runs without @ cost nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", done)


def _proposed(text: str):
    """(kind, start, end) of the base kinds."""
    for a, b in _emails(text):
        yield "email", a, b
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            yield "ip", *m.span()
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _digits(m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield "card", *m.span()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m.group())) <= 15:
                yield "phone", *m.span()


def _further(text: str):
    m = _IBAN.search(text)
    while m:
        # The longest part that passes: a following word in capitals is no part of it.
        found = m.group()
        end = m.start() + (found.find(" ") if " " in found else len(found))
        while found:
            plain = found.replace(" ", "")
            if len(plain) < 15:
                break
            if mod97(plain):
                end = m.start() + len(found)
                yield "iban", m.start(), end
                break
            found = found[: found.rfind(" ")] if " " in found else ""
        # What was cut off, or after a failure the next word, may begin another one.
        m = _IBAN.search(text, end)
    if "-" in text:
        for m in _SSN.finditer(text):
            yield "ssn", *m.span()
        for m in _BIRTH.finditer(text):
            yield "birth", *m.span()


def _score(kind: str, text: str, a: int, b: int) -> float:
    plain, near, words = _SCORES[kind]
    around = text[max(0, a - NEAR) : a].lower() + " " + text[b : b + NEAR].lower()
    score = near if any(w in around for w in words) else plain
    return round(score * 0.7, 2) if any(w in around for w in _AGAINST) else score


def scan(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by start, then kind as listed."""
    if not text:
        return []
    spans = [(k, a, b, _score(k, text, a, b)) for k, a, b in _proposed(text)]
    for kind, a, b in _further(text):
        score = _score(kind, text, a, b)
        if score >= _LEAST:
            spans.append((kind, a, b, score))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


_SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and its spans with scores, for each row of ``docs``."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return map_texts(rows, lambda: lambda text: (_structs(scan(text)),), f"found {_SPANS}")


def _structs(spans):
    return [{"kind": k, "start": a, "end": b, "score": s} for k, a, b, s in spans]


def personal_data_digest(docs: DataFrame) -> DataFrame:
    """One row per document: counts per base kind, a digest of the base spans, and all spans."""
    found = find_personal_data(docs)
    base = F.filter("found", lambda s: s["kind"].isin(*BASE))

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")

    def listed(spans):
        shown = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.concat_ws(",", shown)

    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
        F.array_max(F.transform("found", lambda s: s["score"])).alias("top_score"),
    )


def redact(text: str | None) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans as one."""
    spans = scan(text)
    if not spans:
        return text
    out, at = [], 0
    for kind, a, b, _ in spans:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact_personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; ``n_chars`` follows if it is a column.

    No row goes, and texts without personal data, NULL ones too, stay as they are.
    """

    def start():
        def one(text):
            made = redact(text)
            return made, made != text

        return one

    out, made = map_texts(set_apart(docs), start, "text string, changed boolean"), {}
    if "n_chars" in docs.columns:
        kind, count = docs.schema["n_chars"].dataType, F.col("own.n_chars")
        made["n_chars"] = F.when(F.col("changed"), F.char_length("text").cast(kind)).otherwise(count)
    return put_back(out, docs.columns, **made)

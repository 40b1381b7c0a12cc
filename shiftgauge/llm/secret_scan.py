"""Secrets in texts, also below layers of encoding.

Recursive decoding worklist: the text itself is the first layer. Each layer is scanned, and
its encoded stretches (percent and backslash escapes, character references, base64, hex,
and compressed data below the last two) are decoded into new layers until nothing new
appears. A layer that was seen before below the same stretch, a cycle included, is not opened
again; a stretch that stands at several places is opened once and reported at each. A finding in
a decoded layer is reported where its encoded form stands in the text: escapes map
character by character, base64, hex and compressed data as the whole stretch.

Kinds in the text itself: ``assign`` (name, sign and value), ``access`` (access key ids) and
``hex`` strings, leftmost and not overlapping per kind; besides, also in layers, ``pem``,
``github`` and ``jwt``. NULL and empty texts have none; rows repeat as they come. Compressed
layers are scanned to their end, in windows of ``WINDOW`` characters that overlap, so one small
text cannot fill a worker. Chains of escaped escape signs are decoded at once.
"""

from __future__ import annotations

import base64
import binascii
import codecs
import hashlib
import html
import re
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftgauge.llm.rows import map_texts

#: Characters of a decompressed layer that are scanned at once, and those scanned again with
#: what follows, so that nothing up to that size is missed between two windows.
WINDOW, OVERLAP = 32 << 20, 1 << 20
_PIECE = 1 << 20

KINDS = ("assign", "access", "hex", "pem", "github", "jwt")
BASE = KINDS[:3]

_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_PEM = re.compile(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----")
_GITHUB = re.compile(r"(?<![A-Za-z0-9_])gh[pousr]_[A-Za-z0-9]{36,}")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")

# Escapes of escape signs are taken with what they end in: %252541, &amp;amp;lt;, \\u005cu0041.
_ESCAPE = re.compile(
    r"((?:%(?:25)*[0-9A-Fa-f]{2})+)|\\(?:u005[cC])*u([0-9A-Fa-f]{4})|\\(?:x5[cC])*x([0-9A-Fa-f]{2})"
    r"|&((?:amp;)*)((?:\#[0-9]{1,7}|\#[xX][0-9A-Fa-f]{1,6}|[A-Za-z]{2,8});)"
)
_PERCENT = re.compile(r"%(?:25)*([0-9A-Fa-f]{2})")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
# Lines of base64 that one stretch was wrapped over.
_WRAPPED = re.compile(
    r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{16,}+\r?\n[ \t]*+)+[A-Za-z0-9+/_-]++={0,2}"
)
_SEPARATOR = re.compile(r"[/_-]+")
_CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]")
_HEX_ANY = re.compile(r"(?:[0-9A-Fa-f]{2}){12,}")


def _matches(text: str):
    """(kind, start, end) of one layer."""
    low = text.lower()
    if any(name in low for name in _NAMES):
        for m in _ASSIGN.finditer(text):
            if len(m.group(2)) >= 6:
                yield "assign", m.start(), m.end()
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= 20:
                yield "access", m.start(), m.end()
    for m in _HEX.finditer(text):
        yield "hex", m.start(), m.end()
    for kind, sign, pattern in (
        ("pem", "PRIVATE KEY", _PEM),
        ("github", "gh", _GITHUB),
        ("jwt", "eyJ", _JWT),
    ):
        if sign in text:
            for m in pattern.finditer(text):
                yield kind, m.start(), m.end()


def scan(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans and further spans."""
    if not text:
        return [], []
    spans = list(_matches(text))
    base = [s for s in spans if s[0] in BASE]
    more = {s for s in spans if s[0] not in BASE}
    # Escapes keep the place of each character; what is below a stretch has the stretch's place.
    layer, place, seen = text, None, {text}
    opened: dict[str | bytes, set[str]] = {}
    while True:
        for inner, where in _stretches(layer, place):
            name = _name(inner)
            if name not in opened:
                opened[name] = _below(inner)
            more |= {(kind, *where) for kind in opened[name]}
        layer, place = _unescaped(layer, place) or (text, None)
        if layer in seen:
            break
        seen.add(layer)
        more |= {(kind, *_outer(place, a, b)) for kind, a, b in _matches(layer)}
    more -= set(base)
    return _ordered(base), _ordered(more)


def _below(text: str) -> set[str]:
    """Kinds found in a decoded stretch and in all layers below it."""
    kinds: set[str] = set()
    seen, work = {_name(text)}, [iter([text])]
    while work:  # deepest first, so that windows of a large layer are held one at a time
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        kinds.update(kind for kind, _, _ in _matches(layer))
        work.append(_new_layers(layer, seen))
    return kinds


def _new_layers(layer: str, seen: set):
    for inner, _ in _stretches(layer, (0, 0)):
        if _name(inner) not in seen:
            seen.add(_name(inner))
            yield inner
    whole = _unescaped(layer, (0, 0))
    if whole is not None and _name(whole[0]) not in seen:
        seen.add(_name(whole[0]))
        yield whole[0]


def _name(text: str) -> str | bytes:
    """What a layer is known by: itself, or a digest that is smaller."""
    if len(text) < 1 << 16:
        return text
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=20).digest()


def _outer(place, a: int, b: int) -> tuple[int, int]:
    """Where characters a to b of a layer stand in the text."""
    if place is None:
        return a, b
    if isinstance(place, tuple):
        return place
    return place[a][0], place[b - 1][1]


def _stretches(text: str, place):
    """Decoded stretches one step below: (text, place); a large one in several windows."""
    for m in _BASE64.finditer(text):
        for a, b, inner in _base64_parts(m.group()):
            yield inner, _outer(place, m.start() + a, m.start() + b)
    for m in _WRAPPED.finditer(text) if "\n" in text else ():
        lines = m.group().split()
        # The last line may be a word that follows.
        for n in (len(lines), len(lines) - 1):
            data, found = _from_base64("".join(lines[:n])) if n > 1 else None, False
            end = m.end() if n == len(lines) else m.start() + len(m.group()[: -len(lines[-1])].rstrip())
            for inner in _texts(data) if data is not None else ():
                found = True
                yield inner, _outer(place, m.start(), end)
            if found:
                break
    for m in _HEX_ANY.finditer(text):
        for inner in _texts(bytes.fromhex(m.group())):
            yield inner, _outer(place, *m.span())


def _unescaped(text: str, place):
    """The layer with its escapes decoded, and the place of each character."""
    if "%" not in text and "\\" not in text and "&" not in text:
        return None
    out: list[str] = []
    where: list[tuple[int, int]] = []
    at = 0
    for m in _ESCAPE.finditer(text):
        percent, u, x, signs, entity = m.groups()
        if percent:
            units = list(_PERCENT.finditer(text, *m.span()))
            made = bytes.fromhex("".join(unit[1] for unit in units)).decode(errors="replace")
        elif entity:
            made = html.unescape(f"&{entity}")
            if made == f"&{entity}" and not signs:
                continue
        else:
            made = chr(int(u or x, 16))
            if "\ud800" <= made <= "\udfff":
                continue
        for i in range(at, m.start()):
            where.append(_outer(place, i, i + 1))
        out += [text[at : m.start()], made]
        if percent and made.isascii():
            where += [_outer(place, *unit.span()) for unit in units]
        else:
            where += [_outer(place, *m.span())] * len(made)
        at = m.end()
    if not out:
        return None
    for i in range(at, len(text)):
        where.append(_outer(place, i, i + 1))
    return "".join([*out, text[at:]]), where


def _base64_parts(word: str):
    """(start, end, text) of a stretch, or of its parts that separators begin or end."""
    data, found = _from_base64(word), False
    for inner in _texts(data) if data is not None else ():
        found = True
        yield 0, len(word), inner
    if found:
        return
    edges = [m.span() for m in _SEPARATOR.finditer(word)]
    starts = [0] + [b for _, b in edges]
    ends = [a for a, _ in edges] + [len(word)]
    rest, bad = False, {}
    for a, b in zip(starts, ends, strict=True):
        # From here to the end unless that is part of what was found, and up to the next one.
        for end in dict.fromkeys((len(word), b)):
            if end - a < 16 or (a, end) == (0, len(word)) or rest or not _promising(word[a : a + 16]):
                continue
            if end == len(word) and not _is_zipped(_from_base64(word[a : a + 16]) or b""):
                # What follows is decoded once per alignment to see from where on it is text.
                if a % 4 not in bad:
                    bad[a % 4] = _last_bad(_from_base64(word[a % 4 :]) or b"")
                if (a - a % 4) // 4 * 3 < bad[a % 4]:
                    continue
            data = _from_base64(word[a:end])
            for inner in _texts(data) if data is not None else ():
                rest = rest or end == len(word)
                yield a, end, inner


def _last_bad(data: bytes) -> int:
    """Where the last byte ends that is no part of a character."""
    text = data.decode("utf-8", "surrogateescape")
    bad = [m.end() for m in re.finditer(r"[\udc80-\udcff]", text)]
    return len(text[: bad[-1]].encode("utf-8", "surrogateescape")) if bad else 0


def _is_zipped(data: bytes) -> bool:
    """The signs that compressed data begins with."""
    zlib_header = data[:1] == b"\x78" and len(data) > 1 and not (data[0] * 256 + data[1]) % 31
    return zlib_header or data[:2] == b"\x1f\x8b"


def _promising(word: str) -> bool:
    """Whether 16 characters begin text or compressed data; spares decoding all that follows."""
    data = _from_base64(word) or b""
    if data[:1] == b"\x78" or data[:2] == b"\x1f\x8b":
        return True
    text = codecs.getincrementaldecoder("utf-8")("replace").decode(data)
    return bool(text) and "\ufffd" not in text and not _CONTROL.search(text)


def _from_base64(word: str) -> bytes | None:
    body = word.rstrip("=").translate(_URL_SAFE)
    body = body[: len(body) // 4 * 4 + (0 if len(body) % 4 == 1 else len(body) % 4)]
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except binascii.Error:
        return None


_URL_SAFE = str.maketrans("-_", "+/")


def _inflated(data: bytes):
    """The decompressed members, a piece at a time; data that is not compressed as it is."""
    rest, any_piece = data, False
    while True:
        engine = zlib.decompressobj(47)
        while not engine.eof:
            try:
                made = engine.decompress(rest, _PIECE)
            except zlib.error:
                if not any_piece:
                    yield data
                return
            rest = engine.unconsumed_tail
            if made:
                any_piece = True
                yield made
            elif not rest and not engine.eof:
                return  # the end is missing
        rest = engine.unused_data
        if rest[:2] != b"\x1f\x8b":
            return


def _texts(data: bytes):
    """The data as text, decompressed if need be, in windows; nothing if it is no text.

    A window ends at white space, as far as there is any, and the next begins ``OVERLAP``
    characters or a little more before it. So a stretch is never cut, however long it is.
    """
    pieces = _inflated(data) if _is_zipped(data) else iter([data])
    decoder = codecs.getincrementaldecoder("utf-8")()
    held, size, wanted = [], 0, WINDOW
    try:
        for piece in pieces:
            held.append(decoder.decode(piece))
            size += len(held[-1])
            if size < wanted:
                continue
            text = "".join(held)
            end = _last_space(text, len(text))
            if end <= OVERLAP:
                held, wanted = [text], 2 * size  # one stretch: it has to be held whole
                continue
            if _is_plain(text[:end]):
                yield text[:end]
            held = [text[_last_space(text, end - OVERLAP) :]]
            size, wanted = len(held[0]), WINDOW
        held.append(decoder.decode(b"", True))
    except UnicodeDecodeError:
        return
    text = "".join(held)
    if len(text) >= 6 and _is_plain(text):
        yield text


def _last_space(text: str, end: int) -> int:
    """The place of the last white space before ``end``, or 0."""
    return max(0, *(text.rfind(c, 0, end) for c in " \n\t\r"))


def _is_plain(text: str) -> bool:
    if not _CONTROL.search(text):
        return True
    return sum(32 <= ord(c) < 127 or c in "\t\r\n" for c in text) >= 0.9 * len(text)


def _ordered(spans) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


_SPANS = "array<struct<kind:string,start:int,end:int>>"


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, base spans and further spans, for each row of ``docs``."""

    def start():
        def one(text):
            base, more = scan(text)
            return _structs(base), _structs(more)

        return one

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return map_texts(rows, start, f"base {_SPANS}, more {_SPANS}")


def _structs(spans):
    return [{"kind": k, "start": a, "end": b} for k, a, b in spans]


def secret_digest(docs: DataFrame) -> DataFrame:
    """One row per document: counts per base kind, a digest of the base spans, and all spans."""
    found = find_secrets(docs)
    return found.select(
        "doc_id",
        *[_count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(span_list("base", KINDS).cast("binary"), 256).alias("base_sha256"),
        span_list(F.concat("base", "more"), KINDS).alias("spans"),
    )


def _count(kind: str, spans="base"):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def span_list(spans, kinds):
    """kind:start:end by start, then kind as listed, comma-joined."""
    order = F.array(*[F.lit(k) for k in kinds])
    keyed = F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.array_position(order, s["kind"]).alias("at"),
            s["end"].alias("end"),
            s["kind"].alias("kind"),
        ),
    )
    shown = F.transform(
        F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    )
    return F.concat_ws(",", shown)

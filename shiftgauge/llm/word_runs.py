"""Words of many texts at once, as numbers into the different words, with their places."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

WORD, SPACE, BREAK = 0, 1, 2

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_kinds(spaces: bytes, breaks: bytes = b"") -> np.ndarray:
    """What each byte is: part of a word, a space between words, or a break between pieces."""
    kinds = np.zeros(256, np.uint8)
    kinds[list(spaces)] = SPACE
    kinds[list(breaks)] = BREAK
    return kinds


class Words(NamedTuple):
    dictionary: pa.Array  # the different words, A-Z lower-cased
    codes: np.ndarray  # of every word, in order
    rows: np.ndarray  # the text it stands in
    pieces: np.ndarray  # equal for neighbours with no break and no end of text between


def words_in(texts: pa.Array, kinds: np.ndarray) -> Words:
    """The words of every text; NULL is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    size = int(ends[-1] - ends[0]) if len(texts) else 0
    if not size:
        none = np.zeros(0, np.int64)
        return Words(pa.array([], pa.large_string()), none, none, none)
    chars = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
    begins = ends[:-1] - ends[0]
    kind = kinds[chars]
    inside = kind == WORD
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    first = begins[begins < size]
    starts[first] = inside[first]
    starts = np.flatnonzero(starts)
    letters = _LOWER[chars[inside]]
    at = np.cumsum(inside)[starts] - 1
    plain = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(np.append(at, len(letters)).astype(np.int64)), pa.py_buffer(letters)
    )
    coded = plain.dictionary_encode()
    rows = np.searchsorted(begins, starts, side="right") - 1
    pieces = np.cumsum(kind == BREAK)[starts] + rows
    return Words(coded.dictionary, coded.indices.to_numpy().astype(np.int64), rows, pieces)

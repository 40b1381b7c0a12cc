"""Token ids of a public tokenizer, fast enough for a corpus.

Byte-level BPE never merges across the space that starts a word, so the ids of a text
are the ids of its space-separated pieces in order. Pieces repeat: Arrow finds the
different ones of a batch, each task keeps their ids, and the tokenizer is asked for new
ones only.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = "byte_bpe_50k.json"

# The printable characters that byte-level BPE writes for bytes.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_VISIBLE = {b: b for b in _SHOWN}
_VISIBLE |= {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _VISIBLE)}

# Words and punctuation that the tokenizer's pattern keeps apart, in the plain cases;
# what they do not cover whole goes through the tokenizer itself.
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
_SIGN = "!-&(-/:-@\\[-`{-~"  # an apostrophe may start a part of its own
_PARTS = re.compile(rf" ?[{_LETTER}]+|[{_SIGN}]+|\n(?=[{_LETTER}])")
_WORD = re.compile(rf"[{_LETTER}]+")
_MARKS = "".join(chr(c) for c in range(33, 127) if re.match(f"[{_SIGN}]", chr(c)))


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)  # the tasks of a worker process share what it has learnt
def text_encoder(path: str, max_pieces: int = 400_000) -> Callable:
    """A function from an Arrow array of texts to (ids, offsets of each text's ids).

    ``max_pieces`` bounds the pieces kept; beyond it they are forgotten and asked for
    again. NULL is empty. Strings of special tokens in a text are ordinary text.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    tokenize = tokenizer.model.tokenize
    packed = [i.to_bytes(4, "little") for i in range(tokenizer.get_vocab_size())]
    known: dict[str, bytes] = {}  # pieces after a space, without white space at their ends

    def ask(piece: str) -> bytes:
        parts = _PARTS.findall(piece)
        if "".join(parts) != piece:
            made = tokenizer.encode(piece, add_special_tokens=False).ids
            return b"".join([packed[i] for i in made])
        return b"".join(map(part, parts))

    @lru_cache(maxsize=1 << 14)  # signs, line ends and frequent words beside them
    def part(shown: str) -> bytes:
        return b"".join([packed[t.id] for t in tokenize(_visible(shown))])

    def learn(piece: str) -> bytes:
        if len(known) >= max_pieces:  # the older half goes
            for old in list(islice(known, max(1, max_pieces // 2))):
                del known[old]
        plain = piece.isascii()
        word = piece if plain and piece.isalpha() else piece.rstrip(_MARKS)
        if (word.isalpha() if plain else _WORD.fullmatch(word)):  # by far the most
            shown = "Ġ" + word if plain else _visible(" " + word)
            ids = b"".join([packed[t.id] for t in tokenize(shown)])
            if len(word) < len(piece):
                ids += part(piece[len(word) :])
        else:
            ids = ask(" " + piece)
        known[piece] = ids
        return ids

    def after_space(piece: str) -> bytes:
        """``ask`` of a piece that starts with a space, remembered where ``known`` may hold it."""
        if not _solid(piece[-1:]):
            return ask(piece)
        ids = known.get(piece[1:])
        return learn(piece[1:]) if ids is None else ids

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        split = pc.split_pattern(texts.cast(pa.large_string()).fill_null(""), " ")
        starts = split.offsets.to_numpy()
        first = starts[:-1]
        coded = split.flatten().dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int64)
        found, rough = [], []
        for code, piece in enumerate(coded.dictionary.to_pylist()):
            ids = known.get(piece)
            if ids is None:
                if piece.isalpha() or (_solid(piece[:1]) and _solid(piece[-1:])):
                    ids = learn(piece)
                else:
                    ids = b""
                    rough.append(code)
            found.append(ids)
        # The first piece of a text has no space before it.
        firsts = pc.take(coded.dictionary, pa.array(codes[first])).to_pylist()
        is_rough = np.zeros(len(found) + 1, bool)
        is_rough[rough] = True
        odd = np.add.reduceat(is_rough[codes], first) > 0 if len(first) else first
        new = dict.fromkeys(firsts)
        for piece in new:
            new[piece] = len(found)
            found.append(ask(piece))
        codes[first] = [new[piece] for piece in firsts]
        # Where a piece has white space at an end, the text is split with more care.
        for i in np.flatnonzero(odd):
            codes[starts[i] : starts[i + 1]] = rough[0]
            codes[starts[i]] = len(found)
            first, *others = _pieces(texts[int(i)].as_py() or "")
            found.append(b"".join([ask(first), *map(after_space, others)]))
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begins = np.cumsum(sizes) - sizes
        lengths = sizes[codes]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        take = np.repeat(begins[codes] - (ends - lengths), lengths)
        take += np.arange(total)
        ids = np.frombuffer(b"".join(found), "<u4")[take]
        return ids, np.concatenate([[0], ends])[starts]

    return encode


def _pieces(text: str) -> list[str]:
    """Split before each space that stands alone between two characters that are no white space.

    The pattern of the tokenizer starts a new word there, whatever comes before.
    """
    first, *rest = text.split(" ")
    pieces = [first]
    for part in rest:
        if part and pieces[-1] and _solid(pieces[-1][-1]) and _solid(part[0]):
            pieces.append(" " + part)
        else:
            pieces[-1] += " " + part
    return pieces


def _visible(word: str) -> str:
    if word.isascii() and "\n" not in word:
        return "Ġ" + word[1:] if word[0] == " " else word
    return word.encode().decode("latin-1").translate(_VISIBLE)


def _solid(char: str) -> bool:
    """No white space under any definition of it: printable ASCII or a letter."""
    return "!" <= char <= "~" or char.isalpha()

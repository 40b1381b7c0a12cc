from __future__ import annotations

import pytest

# Cases every operator has to take: NULL, empty and long texts, ties, repeated rows.
TEXTS = [
    (1, "Released under the MIT License. The quick brown fox jumps over the lazy dog today."),
    (2, None),
    (3, ""),
    (4, "mail bob@example.com or 10.1.2.3, token = abcdef123456, card 4539578763621486"),
    (5, "word " * 30_000),
    (5, "word " * 30_000),
    (None, "a text without an id"),
    (6, "!!! ... ???"),
    (7, "é ü 中文 K \u0000   end"),
]


@pytest.fixture
def docs(spark):
    """Rows with columns whose names clash with those of the operators."""
    rows = [(i, t, "en", "s", 0, 0.5, "x", 7) for i, t in TEXTS]
    return spark.createDataFrame(
        rows,
        "doc_id bigint, text string, lang string, source string, n_chars bigint, score double,"
        " spans string, row int",
    )


@pytest.fixture
def no_docs(docs):
    return docs.limit(0)

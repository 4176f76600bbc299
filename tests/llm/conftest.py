from __future__ import annotations

import random
import string

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """documents rows from (doc_id, text) pairs, optionally (doc_id, text, source)."""

    def build(rows, extra: bool = False):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            for name in ("score", "key", "c", "row", "shard", "token", "variant", "places", "fp", "size"):
                df = df.selectExpr("*", f"'x' as {name}")
        return df

    return build


def sentence(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(word(rng.randrange(vocabulary)) for _ in range(n))


def word(k: int) -> str:
    letters = string.ascii_lowercase
    return letters[k % 26] + letters[k // 26 % 26] + letters[(k * 7) % 26] + "aeiou"[k % 5]


def lower_ascii(text: str | None) -> str:
    return (text or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))


def split_words(text: str | None) -> list[str]:
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# Texts every operator must take: none, blank, one word, odd spaces, repeats, many languages.
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, "One"),
    (5, "one two  three\tfour\nfive\x0bsix\x0cseven\reight nine ten eleven"),
    (6, "Größe ñandú été   non-breaking   line"),
    (7, "a " * 300),
    (7, "a " * 300),
    (8, "same words here again and again until twelve words are reached now yes"),
    (9, "same words here again and again until twelve words are reached now yes"),
    (None, "same words here again and again until twelve words are reached now yes"),
    (None, None),
]

"""Words, shingles and splits shared by the corpus operators."""

from __future__ import annotations

import string
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The six characters that separate words: space and the controls 09 to 0D.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
# bytes.split() splits on the same six characters.
LOWER_TABLE = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else changed."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """The words of ``text`` as an array; NULL and blank texts have none."""
    trimmed = F.btrim(text, F.lit(SPACES))
    none = F.array().cast("array<string>")
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE_RUN)).otherwise(none)


def text_bytes(text: str | None, lower: bool = False) -> bytes:
    """UTF-8 bytes of ``text``; NULL is empty, lone surrogates become question marks."""
    raw = (text or "").encode("utf-8", "replace")
    return raw.translate(LOWER_TABLE) if lower else raw


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


def id_remainder_py(value: object, modulus: int) -> int:
    return zlib.crc32(b"" if value is None else str(value).encode()) % modulus


def columns_of(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra columns can't clash with inner names."""
    return df.select(*[F.col(f"`{name}`") for name in names])


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    An expression used inside a lambda is evaluated again for every element; as the
    element of a one-item array it is a bound variable.
    """
    return F.transform(F.array(value), body)[0]

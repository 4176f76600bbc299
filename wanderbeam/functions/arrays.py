"""Array expressions for ordered behaviour sequences."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


NULL_TOKEN = "\\N"
EMPTY_TOKEN = "\\E"


def to_delimited(values: Column, sep: str = ",") -> Column:
    """Items joined by ``sep``: a NULL item is ``\\N``, an empty array ``\\E``, so positions stay.

    An item that starts with a backslash gets another one in front. A NULL array stays NULL.
    """

    def item(v: Column) -> Column:
        written = v.cast("string")
        escaped = F.when(F.startswith(written, F.lit("\\")), F.concat(F.lit("\\"), written)).otherwise(written)
        return F.coalesce(escaped, F.lit(NULL_TOKEN))

    joined = F.array_join(F.transform(values, item), sep)
    return F.when(F.size(values) == 0, F.lit(EMPTY_TOKEN)).otherwise(joined)


def from_delimited(text: Column, item_type: str = "string", sep: str = ",") -> Column:
    """What ``to_delimited`` wrote; ``sep`` is taken literally."""

    def item(v: Column) -> Column:
        plain = F.when(F.startswith(v, F.lit("\\")), F.substr(v, F.lit(2))).otherwise(v)
        return F.when(v != NULL_TOKEN, plain)

    parts = F.transform(F.split(text, re.escape(sep)), item)
    none = F.array().cast("array<string>")
    return F.when(text == EMPTY_TOKEN, none).otherwise(parts).cast(f"array<{item_type}>")


def prefix(values: Column, length: int) -> Column:
    return F.slice(values, 1, length)


def last_item(values: Column) -> Column:
    return F.try_element_at(values, F.lit(-1))


def all_but_last(values: Column) -> Column:
    return F.slice(values, F.lit(1), F.greatest(F.size(values) - 1, F.lit(0)))


def first_of_delimited(text: Column, k: int, sep: str = ",") -> Column:
    return F.slice(from_delimited(text, sep=sep), 1, k)


def overlap(left: Column, right: Column) -> Column:
    """Number of distinct values present in both arrays."""
    return F.size(F.array_intersect(left, right))


def argmax(values: Column) -> Column:
    """0-based index of the largest value; the first one on ties."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def distinct_count(values: Column) -> Column:
    return F.size(F.array_distinct(values))


def count_windows(values: Column, length: int, step: int) -> Column:
    """Windows of ``length`` items starting every ``step`` items, then the tail window.

    The tail window is always added, so it comes twice where the last regular window
    already ends at the last item. NULL where there are fewer than ``length`` items.
    """
    surplus = F.size(values) - length
    # greatest() keeps sequence() valid on short arrays, where the CASE drops the result.
    starts = F.sequence(F.lit(0), F.greatest(surplus, F.lit(0)), F.lit(step))
    return F.when(
        surplus >= 0,
        F.transform(F.concat(starts, F.array(surplus)), lambda s: F.slice(values, s + 1, length)),
    )

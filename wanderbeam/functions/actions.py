"""Action names and their class codes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class code of every action.
ACTION_CODES = {
    "unfav": 0,
    "view": 1,
    "click": 2,
    "fav": 3,
    "share": 4,
    "purchase": 5,
}
ACTION_NAMES = tuple(ACTION_CODES)


def encode(action: Column, codes: Mapping[str, int] = ACTION_CODES) -> Column:
    """Class code of an action; NULL for an action without a code."""
    branches = F.lit(None).cast("int")
    for name, code in codes.items():
        branches = F.when(action == name, F.lit(code)).otherwise(branches)
    return branches


def replace_values(value: Column, codes: Mapping[str, int]) -> Column:
    """Like ``encode`` but as text, and values without a code pass through."""
    return F.coalesce(encode(value, codes).cast("string"), value)


def decode(code: Column, codes: Mapping[str, int] = ACTION_CODES) -> Column:
    branches = F.lit(None).cast("string")
    for name, number in codes.items():
        branches = F.when(code == number, F.lit(name)).otherwise(branches)
    return branches


def booking_action(status: Column) -> Column:
    return F.when(status == "CONFIRMED", "purchase").otherwise("check")

"""Rounding of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nearest(value: Column, places: int) -> Column:
    """``round(value, places)`` of a double, bit for bit, at a small part of its cost.

    ``round`` goes through a decimal number. That is needed only where the digits behind the last place are so near to a
    half that the multiplication may fall on the other side, or where the value is too large for such a margin. ``value``
    is used several times: let it be a column, not a long expression. For up to nine ``places``.
    """
    shifted = value * 10.0**places + 0.5
    whole = F.floor(shifted)
    rest = shifted - whole
    sure = (F.abs(value) < 1000) & (rest > 0.001) & (rest < 0.999)
    return F.when(sure, whole / 10.0**places).otherwise(F.round(value, places))

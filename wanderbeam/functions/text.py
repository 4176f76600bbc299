"""Text normalisation used by the dimensions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNSPECIFIED = "unspecified"


def snake(value: Column) -> Column:
    """Lower case with spaces turned into underscores."""
    return F.lower(F.replace(value, F.lit(" "), F.lit("_")))


def squeeze(value: Column) -> Column:
    """Trimmed value without inner spaces."""
    return F.replace(F.trim(value), F.lit(" "), F.lit(""))


def location_key(location: Column, city: Column) -> Column:
    """``location_<area>_<city>``; the city alone where the area is missing.

    NULL city gives NULL, commas are removed.
    """
    no_area = location.isNull() | (location == "")
    area = F.when(no_area, squeeze(city)).otherwise(
        F.concat(squeeze(location), F.lit("_"), squeeze(city))
    )
    return F.concat(F.lit("location_"), F.replace(F.lower(area), F.lit(","), F.lit("")))


def prefixed_id(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def override(value: Column, replacements: dict[str, str]) -> Column:
    """Replace single values, leave the others alone."""
    result = value
    for old, new in replacements.items():
        result = F.when(value == old, F.lit(new)).otherwise(result)
    return result


def full_address(*parts: Column) -> Column:
    """Trimmed parts joined by a space; any NULL part makes the address NULL."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(" "))
        pieces.append(F.trim(part))
    return F.concat(*pieces)

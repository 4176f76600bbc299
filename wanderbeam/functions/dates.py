"""Dates and ages. No function reads the clock; ``as_of`` is always an argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_OFFSET_HOURS = 7

# Lower age bound (inclusive), label and group code of every bin.
AGE_BINS = (
    (0, "elementary", "group_1"),
    (13, "junior_high", "group_2"),
    (16, "high_school", "group_3"),
    (19, "undergrad", "group_4"),
    (23, "early_jobber", "group_5"),
    (26, "establishment", "group_6"),
    (30, "mid_career", "group_7"),
    (45, "senior", "group_8"),
    (60, "retirement", "group_9"),
)
AGE_LIMIT = 999999


def as_date(day: str | dt.date) -> dt.date:
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(day)


def local_time(ts: Column, hours: int = LOCAL_OFFSET_HOURS) -> Column:
    return F.timestamp_add("HOUR", F.lit(hours), ts)


def local_days(ts: Column, first: dt.date, last: dt.date, hours: int = LOCAL_OFFSET_HOURS) -> Column:
    """``first <= date(local_time(ts)) <= last``, inclusive.

    The shift is applied to the bounds, so the comparison is on the bare column
    and reaches the scan.
    """
    shift = dt.timedelta(hours=hours)
    start = dt.datetime.combine(first, dt.time()) - shift
    stop = dt.datetime.combine(last + dt.timedelta(days=1), dt.time()) - shift
    return (ts >= F.lit(start.isoformat(" ")).cast("timestamp_ntz")) & (
        ts < F.lit(stop.isoformat(" ")).cast("timestamp_ntz")
    )


def trailing_days(as_of: str | dt.date, days: int = 8) -> tuple[dt.date, dt.date]:
    """The ``days`` days before ``as_of``, not counting ``as_of``."""
    end = as_date(as_of)
    return end - dt.timedelta(days=days), end - dt.timedelta(days=1)


def completed_years(birth: Column, as_of: str | dt.date, literal_adjust: bool = False) -> Column:
    """Age in completed years.

    ``literal_adjust`` takes one more year off before the birthday, as the
    original job does although the year difference already counts completed years.
    """
    today = F.lit(as_date(as_of))
    years = F.timestamp_diff("YEAR", birth.cast("timestamp_ntz"), today.cast("timestamp_ntz"))
    if not literal_adjust:
        return years
    before_birthday = (F.month(birth) > F.month(today)) | (
        (F.month(birth) == F.month(today)) & (F.dayofmonth(birth) > F.dayofmonth(today))
    )
    return years - F.when(before_birthday, 1).otherwise(0)


def age_bin(age: Column, field: str) -> Column:
    """``label`` or ``group`` of the half-open bin; NULL outside every bin."""
    position = {"label": 1, "group": 2}[field]
    result = F.lit(None).cast("string")
    for row in AGE_BINS:
        result = F.when(age >= row[0], F.lit(row[position])).otherwise(result)
    return F.when(age < AGE_LIMIT, result)

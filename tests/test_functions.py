from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wanderbeam.functions import actions, arrays, dates, json, text


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("location", "city", "key"),
    [
        (None, " Big City ", "location_bigcity"),
        ("", "Big City", "location_bigcity"),
        ("Old Town", "Big City", "location_oldtown_bigcity"),
        (" Old, Town", "Big City", "location_oldtown_bigcity"),
        ("Old Town", None, None),
    ],
)
def test_location_key(spark, location, city, key):
    found = text.location_key(F.lit(location).cast("string"), F.lit(city).cast("string"))
    assert one(spark, found) == key


def test_text_helpers(spark):
    assert one(spark, text.snake(F.lit("Grand Brand"))) == "grand_brand"
    assert one(spark, text.override(F.lit("a"), {"a": "b", "c": "d"})) == "b"
    assert one(spark, text.full_address(F.lit(" a "), F.lit("b"))) == "a b"
    assert one(spark, text.full_address(F.lit("a"), F.lit(None).cast("string"))) is None
    assert one(spark, text.prefixed_id("hotel_", F.lit(7))) == "hotel_7"


def test_actions(spark):
    assert one(spark, actions.encode(F.lit("purchase"))) == 5
    assert one(spark, actions.encode(F.lit("check"))) is None
    assert one(spark, actions.replace_values(F.lit("check"), actions.ACTION_CODES)) == "check"
    assert one(spark, actions.replace_values(F.lit("view"), actions.ACTION_CODES)) == "1"
    assert one(spark, actions.decode(F.lit(0))) == "unfav"
    assert one(spark, actions.decode(F.lit(9))) is None
    assert one(spark, actions.booking_action(F.lit("CONFIRMED"))) == "purchase"
    assert one(spark, actions.booking_action(F.lit(None).cast("string"))) == "check"


@pytest.mark.parametrize(
    ("as_of", "age", "literal"), [("2024-06-14", 23, 22), ("2024-06-15", 24, 24)]
)
def test_completed_years(spark, as_of, age, literal):
    born = F.lit(dt.date(2000, 6, 15))
    assert one(spark, dates.completed_years(born, as_of)) == age
    assert one(spark, dates.completed_years(born, as_of, literal_adjust=True)) == literal


@pytest.mark.parametrize(
    ("age", "group"),
    [(-1, None), (0, 1), (12, 1), (13, 2), (15, 2), (16, 3), (29, 6), (30, 7), (60, 9), (None, None)],
)
def test_age_bins(spark, age, group):
    found = one(spark, dates.age_bin(F.lit(age).cast("double"), "group"))
    assert found == (None if group is None else f"group_{group}")


def test_local_days_shift_the_bounds(spark):
    first, last = dates.trailing_days("2024-02-01", 8)
    assert (first, last) == (dt.date(2024, 1, 24), dt.date(2024, 1, 31))
    times = ["2024-01-23 16:59:59", "2024-01-23 17:00:00", "2024-01-31 16:59:59", "2024-01-31 17:00:00"]
    frame = spark.createDataFrame([(t,) for t in times], "t string").select(
        F.col("t").cast("timestamp_ntz").alias("ts")
    )
    kept = frame.filter(dates.local_days(F.col("ts"), first, last))
    same = frame.filter(F.to_date(dates.local_time(F.col("ts"))).between(first, last))
    assert kept.count() == 2
    assert rows(kept) == rows(same)


def test_array_helpers(spark):
    letters = F.array(*[F.lit(x) for x in "abca"])
    assert one(spark, arrays.last_item(letters)) == "a"
    assert one(spark, arrays.all_but_last(letters)) == ["a", "b", "c"]
    assert one(spark, arrays.prefix(letters, 9)) == ["a", "b", "c", "a"]
    assert one(spark, arrays.distinct_count(letters)) == 3
    assert one(spark, arrays.to_delimited(F.array(F.lit(1), F.lit(2)))) == "1,2"
    assert one(spark, arrays.from_delimited(F.lit("1,2.5"), "float")) == [1.0, 2.5]
    assert one(spark, arrays.first_of_delimited(F.lit("a,b,c"), 2)) == ["a", "b"]
    assert one(spark, arrays.overlap(letters, F.array(F.lit("a"), F.lit("z")))) == 1
    empty = F.array().cast("array<string>")
    assert one(spark, arrays.last_item(empty)) is None
    assert one(spark, arrays.all_but_last(empty)) == []


def test_argmax_takes_the_first_of_equal_values(spark):
    values = F.array(F.lit(0.4), F.lit(0.4), F.lit(0.2))
    assert one(spark, arrays.argmax(values)) == 0


def expected_windows(n: int, length: int, step: int) -> list[list[int]]:
    """Brute force: every ``step``, then the tail."""
    items = list(range(1, n + 1))
    if n < length:
        return []
    found = [items[s : s + length] for s in range(0, n - length + 1, step)]
    return [*found, items[n - length :]]


@pytest.mark.parametrize(
    ("n", "windows"),
    [
        (5, []),
        (6, [(1, 6), (1, 6)]),
        (7, [(1, 6), (2, 7)]),
        (11, [(1, 6), (6, 11), (6, 11)]),
        (13, [(1, 6), (6, 11), (8, 13)]),
    ],
)
def test_count_windows(spark, n, windows):
    items = F.sequence(F.lit(1), F.lit(n))
    found = one(spark, arrays.count_windows(items, 6, 5)) or []
    assert [(w[0], w[-1]) for w in found] == windows
    assert found == expected_windows(n, 6, 5)


@settings(max_examples=15, deadline=None)
@given(st.integers(1, 25), st.integers(1, 7), st.integers(1, 7))
def test_count_windows_against_brute_force(spark, n, length, step):
    items = F.sequence(F.lit(1), F.lit(n))
    found = one(spark, arrays.count_windows(items, length, step)) or []
    assert found == expected_windows(n, length, step)


def test_json(spark):
    good = F.lit('{"hotelId": "7", "price": 1.5, "room": [{"adults": 2}]}')
    parsed = json.parse(good, json.REQUEST_SCHEMA)
    assert one(spark, parsed["hotelId"]) == "7"
    assert one(spark, parsed["room"][0]["adults"]) == 2
    assert one(spark, json.parse(F.lit("{broken"), json.REQUEST_SCHEMA)["hotelId"]) is None
    assert one(spark, json.path_long(good, "hotelId")) == 7
    assert one(spark, json.path_long(F.lit('{"hotelId": "x"}'), "hotelId")) is None
    details = F.lit('{"roomDetails": {"cancellationPolicy": {"th": [{"days": 3}]}}, "taxes": 0.5}')
    deep = json.parse(details, json.DETAILS_SCHEMA)
    assert one(spark, deep["roomDetails"]["cancellationPolicy"]["th"][0]["days"]) == 3

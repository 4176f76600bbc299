from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wanderbeam.operators import dims

PROFILE = "raw_user_id long, register_date date, gender string, birth_date date"


def profile(spark, *people):
    return spark.createDataFrame(list(people), PROFILE)


def day(text):
    return dt.date.fromisoformat(text)


def test_one_row_per_user_with_the_latest_profile(spark):
    people = profile(
        spark,
        (1, day("2020-01-01"), "M", day("1990-01-01")),
        (1, day("2021-01-01"), "m", day("1991-01-01")),
        (1, day("2021-01-01"), "m", None),
        (2, day("2020-01-01"), None, None),
        (None, day("2020-01-01"), "m", None),
    )
    assert rows(dims.latest_profile(people)) == [
        (1, day("2021-01-01"), day("1991-01-01"), "m"),
        (2, day("2020-01-01"), None, None),
    ]


def test_new_users_in_spite_of_null_keys(spark):
    existing = spark.createDataFrame([(1,), (None,)], "raw_user_id long")
    people = profile(
        spark, (1, day("2020-01-01"), "m", None), (2, day("2020-01-01"), "m", None)
    )
    assert rows(dims.new_users(people, existing), "raw_user_id") == [(2,)]


def test_first_load_then_increment(spark):
    first = dims.build_user_dim(
        profile(
            spark,
            (5, day("2020-01-02"), "Male", day("1990-06-15")),
            (4, day("2020-01-02"), "female", day("2000-06-15")),
            (9, day("2020-01-01"), "male", None),
            (7, day("2020-01-03"), "male", day("1980-06-15")),
        ),
        None,
        "2024-06-14",
    )
    assert rows(first, "int_user_id", "raw_user_id", "age", "age_group") == [
        (1, 9, None, None),
        (2, 4, 23.0, "group_5"),
        (3, 5, 33.0, "group_7"),
        (4, 7, 43.0, "group_7"),
    ]
    more = dims.build_user_dim(
        profile(
            spark,
            (5, day("2024-01-02"), "male", None),
            (11, day("2024-02-01"), "male", None),
            (10, day("2024-02-01"), None, None),
            (12, day("2024-01-31"), "none", day("1960-01-01")),
        ),
        first,
        "2024-06-15",
    )
    fresh = more.filter(F.col("busi_dt") == "2024-06-15")
    # The median is over the existing users of the gender; no gender, no median.
    assert rows(fresh, "int_user_id", "user_id", "raw_user_id", "age", "age_group_label") == [
        (5, "user_5", 12, 64.0, "retirement"),
        (6, "user_6", 10, None, None),
        (7, "user_7", 11, 38.0, "mid_career"),
    ]
    assert more.count() == 7


def test_medians(spark):
    users = spark.createDataFrame(
        [("a", 10.0), ("a", 20.0), ("a", None), (None, 5.0), ("b", 7.0), ("b", 7.0), ("b", 9.0)],
        "gender string, age double",
    )
    assert rows(dims.median_age_by_gender(users)) == [("a", 15.0), ("b", 7.0), (None, 5.0)]


def items(spark, wide=False):
    listed = spark.createDataFrame(
        [
            (30, "en", "Old Town", "Big City", 1.5, 2.5),
            (10, "en", "", "Big City", None, 2.5),
            (20, "en", None, None, 1.5, 2.5),
            (20, "th", "X", "Y", 1.5, 2.5),
        ],
        "hotel_code long, language string, location_name string, city_name string,"
        " latitude double, longitude double",
    )
    styles = spark.createDataFrame(
        [(30, "Sea View"), (30, "Art Deco"), (10, "Zen")], "hotel_code long, style_name string"
    )
    overrides = {"location_bigcity": "location_metro"}
    return dims.build_item_dim(listed, styles, "2024-01-31", overrides, wide)


def test_item_dim(spark):
    built = items(spark)
    assert rows(built, "hotel_code", "hotel_id", "location_name", "style_name") == [
        (10, "hotel_1", "location_metro", "zen"),
        (20, "hotel_2", "unspecified", "unspecified"),
        (30, "hotel_3", "location_oldtown_bigcity", "art_deco"),
    ]
    assert "style_onehot" not in built.columns
    by_code = {r["hotel_code"]: r for r in dims.spelled_out(built).collect()}
    assert by_code[30]["style_name_index"] == 0 and by_code[30]["style_name_size"] == 3
    assert by_code[30]["style_onehot"] == [1, 0, 0]
    assert by_code[20]["style_onehot"] == [0, 1, 0]
    assert by_code[10]["location_onehot"] == [1, 0, 0]


def test_wide_item_dim_keeps_both_null_labels(spark):
    wide = items(spark, wide=True)
    assert rows(wide, "hotel_code", "style_unspecified", "location_unspecified", "location_metro") == [
        (10, 0, 0, 1),
        (20, 1, 1, 0),
        (30, 0, 0, 0),
    ]
    with pytest.raises(ValueError, match="too many values"):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(dims, "MAX_WIDE", 2)
            items(spark, wide=True)
    assert dims.feature_columns(wide, "location_", ("location_name", *dims.SPARSE)) == [
        "location_metro",
        "location_oldtown_bigcity",
        "location_unspecified",
    ]


def test_vocabulary_ways_agree(spark):
    words = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "w string")
    small, large = dims.vocabulary(words, "w"), dims.vocabulary(words, "w", small_rows=0)
    assert rows(small) == rows(large) == [("a", 0, 3), ("b", 1, 3), ("unspecified", 2, 3)]


def test_index_of_unknown_values(spark):
    vocab = dims.vocabulary(spark.createDataFrame([("a",)], "w string"), "w")
    words = spark.createDataFrame([("a",), ("zzz",)], "w string")
    assert rows(dims.one_hot_index(words, "w", vocab), "w", "w_index") == [("a", 0), ("zzz", None)]
    with pytest.raises(Exception, match="w not in vocabulary: zzz"):
        dims.one_hot_index(words, "w", vocab, strict=True).collect()

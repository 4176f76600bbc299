from __future__ import annotations

from conftest import at, rows

from wanderbeam.operators import evaluate, quality

BY_ID = ("event_timestamp", "event_id")


def test_segments_have_every_action_column(spark):
    predicted = spark.createDataFrame(
        [("a", "h1", "view"), ("a", "h2", "fav"), ("b", "h1", "view"), ("b", "h2", None), ("c", "h1", "share")],
        "user_id string, hotel_id string, main_action string",
    )
    got = evaluate.segment_users(predicted)
    assert got.columns == ["user_id", "unfav", "view", "click", "fav", "share", "purchase", "segment"]
    assert rows(got, "user_id", "view", "fav", "segment") == [
        ("a", 1, 1, "promising"),
        ("b", 1, 0, "ordinary"),
        ("c", 0, 0, "ordinary"),
    ]


def held_out(spark, items, user="u1", gender="male"):
    data = [(user, gender, "g1", h, a, at(i // 2), i) for i, (h, a) in enumerate(items)]
    return spark.createDataFrame(
        data,
        "user_id string, gender string, age_group string, hotel_id string, main_action int,"
        " event_timestamp timestamp_ntz, event_id long",
    )


def test_runs_are_collapsed(spark):
    events = held_out(spark, [("a", 1), ("a", 5), ("b", 2), ("a", 1), (None, 1), (None, 2)])
    assert rows(evaluate.collapse_repeats(events, order=BY_ID), "run", "hotel_id", "main_action") == [
        (1, "a", 5),
        (2, "b", 2),
        (3, "a", 1),
        (4, None, 1),
        (5, None, 2),
    ]
    unknown = held_out(spark, [("a", 1)], gender=None)
    assert evaluate.collapse_repeats(unknown).count() == 0


def test_skip_first(spark):
    events = held_out(spark, [("a", 1)] * 8).unionByName(held_out(spark, [("a", 1)] * 3, "u2"))
    assert rows(evaluate.skip_first(events, 6, order=BY_ID), "user_id", "event_id", "place") == [("u1", 6, 7), ("u1", 7, 8)]


def test_hits_at_n(spark):
    lists = spark.createDataFrame(
        [("u1", ["a", "b", "z"]), ("u2", ["a"]), ("u3", ["a"])], "user_id string, hotel_ids array<string>"
    )
    runs = spark.createDataFrame(
        [("u1", i + 1, h) for i, h in enumerate("abaz")] + [("u2", 1, "a"), ("u2", 2, "b")],
        "user_id string, run long, hotel_id string",
    )
    # Only the first three runs count, as a set; u2 has too few; u3 did nothing.
    assert rows(evaluate.hits_at_n(lists, runs, 3)) == [("u1", 2), ("u2", None)]


def test_holdout_end_to_end_is_the_same_for_heavy_users(spark):
    events = spark.createDataFrame(
        [(1, i % 3, "view", at(60 * i), i) for i in range(40)] + [(2, 1, "view", at(60 * 30), 99), (9, 1, "view", at(0), 98)],
        "user_id long, hotel_code long, event_name string, event_timestamp timestamp_ntz, event_id long",
    )
    event_map = spark.createDataFrame([("view", 1)], "event_name string, encoded_main_action int")
    users = spark.createDataFrame(
        [(1, "user_1", "m", "g1"), (2, "user_2", "m", "g1")],
        "raw_user_id long, user_id string, gender string, age_group string",
    )
    items = spark.createDataFrame([(0, "hotel_0"), (1, "hotel_1")], "hotel_code long, hotel_id string")
    plain = evaluate.holdout(events, event_map, users, items, "2024-01-01")
    split = evaluate.holdout(events, event_map, users, items, "2024-01-01", max_rows=4)
    # Events 24..39 are late, the first six are skipped, item 2 is unknown.
    assert plain.count() == 10
    assert rows(plain.filter("run = 1"), "user_id", "hotel_id") == [("user_1", "hotel_0")]
    assert rows(split) == rows(plain)


def test_top_k_history(spark):
    lists = spark.createDataFrame([("u1", ["a"]), ("u2", ["b"])], "user_id string, hotel_ids array<string>")
    pairs = spark.createDataFrame([("u1", "x,y,z"), ("u9", "q")], "user_id string, sequence_hotel_ids string")
    assert rows(evaluate.top_k_history(pairs, lists, 2)) == [("u1", ["a"], ["x", "y"]), ("u2", ["b"], None)]


def test_quality(spark):
    frame = spark.createDataFrame([(1, None), (1, "a"), (2, "b")], "k int, v string")
    assert rows(quality.null_profile(frame)) == [(3, 0, 1)]
    assert rows(quality.time_range(frame, "k")) == [(1, 2)]
    assert rows(quality.largest_groups(frame, "k", 1)) == [(1, 2)]

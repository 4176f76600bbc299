from __future__ import annotations

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from wanderbeam.operators import behaviour, quality, sequences


@pytest.fixture(scope="module")
def world(spark):
    events = spark.createDataFrame(
        [(1, 100 + i % 4, "view", at(i)) for i in range(8)]
        + [(1, 100, "view", at(50)), (1, 100, "click", at(50)), (2, 101, "click", at(1))]
        + [(2, 101, "error", at(9)), (2, None, "view", at(9)), (3, 999, "view", at(1))],
        "user_id long, hotel_code long, event_name string, event_timestamp timestamp_ntz",
    )
    event_map = spark.createDataFrame(
        [("view", "view"), ("click", "click"), ("error", None)], "event_name string, main_action string"
    )
    bookings = spark.createDataFrame(
        [
            ('{"customerId": "2"}', '{"hotelId": "100"}', "CONFIRMED", at(0)),
            ('{"customerId": "2"}', '{"hotelId": "100"}', "CONFIRMED", at(0)),
            ('{"customerId": "2"}', '{"hotelId": "100"}', "PENDING", at(3)),
            ("{broken", '{"hotelId": "100"}', "CONFIRMED", at(3)),
        ],
        "customer_info string, request string, status string, updated_at timestamp_ntz",
    )
    users = spark.createDataFrame(
        [(1, "user_1", "group_1", "male"), (2, "user_2", None, None), (3, "user_3", "group_2", "none")],
        "raw_user_id long, user_id string, age_group string, gender string",
    )
    items = spark.createDataFrame(
        [(100 + i, f"hotel_{i}", f"style_{i % 2}") for i in range(4)],
        "hotel_code long, hotel_id string, style_name string",
    )
    trained = items.filter("hotel_id <> 'hotel_3'").select("hotel_id")
    return bookings, events, event_map, users, items, trained


def test_recent_behaviour(world):
    last = behaviour.recent_behaviour(*world, length=3)
    # Latest time per (user, item, action); hotel_3 is not trained; equal times go by item, action.
    assert rows(last, "user_id", "hotel_id_sequence", "main_action_sequence", "gender") == [
        ("user_1", ["hotel_2", "hotel_0", "hotel_0"], [1, 1, 2], "male"),
        ("user_2", ["hotel_1", "hotel_0"], [2, 5], None),
    ]
    first = behaviour.recent_behaviour(*world, length=3, keep="first")
    assert rows(first, "user_id", "hotel_id_sequence")[0] == ("user_1", ["hotel_1", "hotel_2", "hotel_0"])
    with pytest.raises(ValueError):
        behaviour.recent_behaviour(*world, keep="middle")


def test_repeat_visit_rule_keeps_everything(world):
    bookings, events, event_map, *_ = world
    both = behaviour.union_events(bookings, events, event_map)
    marked = behaviour.repeat_visits(both)
    assert marked.filter("kept_hotel_code IS NULL AND hotel_code IS NOT NULL").count() == 0
    assert marked.count() == both.count()


def test_eligibility_is_a_partition(spark):
    shown = spark.createDataFrame(
        [("a", ["x"] * 6), ("b", ["x"] * 5), ("c", ["x"] * 6), ("d", None)],
        "user_id string, hotel_id_sequence array<string>",
    )
    trained = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "user_id string")
    eligible, cold = behaviour.split_eligible(shown, trained, 6)
    assert rows(eligible, "user_id") == [("a",)]
    assert rows(cold, "user_id") == [("b",), ("c",), ("d",)]
    assert quality.shared_keys(cold, eligible, "user_id").first()[0] == 0


def training(spark):
    data = [("u1", f"h{i % 3}", "view" if i % 2 else "purchase", at(i // 2), i, i % 2, float(i)) for i in range(7)]
    data += [("u2", "h1", "view", at(i), 100 + i, 0, 1.0) for i in range(9)]
    data += [("u3", None if i == 2 else f"h{i}", "click", at(i), 200 + i, 0, 0.5) for i in range(6)]
    return spark.createDataFrame(
        data,
        "user_id string, hotel_id string, main_action string, event_timestamp timestamp_ntz,"
        " event_id long, complete_flag int, duration double",
    )


def users(spark):
    return spark.createDataFrame(
        [("u1", "male", 30.0, "mid_career", "group_7")],
        "user_id string, gender string, age double, age_group_label string, age_group string",
    )


def test_training_sequences(spark):
    built = sequences.training_sequences(training(spark), users(spark), 6, 5, 3, order=("event_timestamp", "event_id"))
    got = rows(built, "user_id", "win", "hotel_id_sequence", "main_action_sequence", "gender")
    # u2 saw one item only; u1 has ties settled by event id; u3's missing item keeps its place.
    assert got[:2] == [
        ("u1", 0, ["h0", "h1", "h2", "h0", "h1", "h2"], [5, 1, 5, 1, 5, 1], "male"),
        ("u1", 1, ["h1", "h2", "h0", "h1", "h2", "h0"], [1, 5, 1, 5, 1, 5], "male"),
    ]
    third = [("u3", w, ["h0", "h1", None, "h3", "h4", "h5"], [2] * 6, None) for w in (0, 1)]
    assert got[2:] == third


def test_history_and_target(spark):
    windows = sequences.training_sequences(training(spark), users(spark), 6, 5, 3, order=("event_timestamp", "event_id"))
    one = sequences.history_target(windows).filter("user_id = 'u1' AND win = 0").first()
    assert one["sequence_hotel_ids"] == ["h0", "h1", "h2", "h0", "h1"]
    assert (one["target_hotel_id"], one["target"]) == ("h2", 1)
    assert one["main_action_sequence"] == [5, 1, 5, 1, 5]


@pytest.mark.parametrize(("n", "sizes"), [(10, (7, 1, 2)), (2057, (1439, 308, 310)), (1, (1, 0, 0))])
def test_exact_split_sizes(spark, n, sizes):
    frame = spark.range(n).select(F.col("id").alias("user_id"), F.lit(0).alias("win"))
    got = sequences.exact_split(frame)
    counts = {r["split"]: r["count"] for r in got.groupBy("split").count().collect()}
    assert tuple(counts.get(s, 0) for s in ("train", "test", "eval")) == sizes
    again = sequences.exact_split(frame.repartition(3))
    assert rows(got) == rows(again)


def test_user_split_keeps_users_together(spark):
    frame = spark.range(60).select((F.col("id") % 20).alias("user_id"), F.col("id").alias("win"))
    splits = sequences.user_split(frame).groupBy("user_id").agg(F.count_distinct("split").alias("n"))
    assert rows(splits.select("n").distinct()) == [(1,)]


@pytest.mark.parametrize(("n", "k", "sizes"), [(10, 3, [3, 3, 4]), (6, 2, [3, 3]), (2, 3, [2]), (5, 1, [5])])
def test_kway_split(spark, n, k, sizes):
    parts = sequences.kway_split(spark.range(n).toDF("id"), ["id"], k)
    counts = [r["count"] for r in parts.groupBy("part").count().orderBy("part").collect()]
    assert counts == sizes
    if n < k:
        assert rows(parts.select("part").distinct()) == [(k,)]


def test_kway_split_needs_a_part(spark):
    with pytest.raises(ValueError):
        sequences.kway_split(spark.range(3).toDF("id"), ["id"], 0)

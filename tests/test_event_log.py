from __future__ import annotations

import pytest
from conftest import at, rows

from wanderbeam.operators import event_log

VALUE = "struct<string_value:string,int_value:bigint,float_value:float,double_value:double>"
RAW = (
    "event_date string, event_timestamp timestamp_ntz, event_name string, user_id string,"
    f" ga_session_id bigint, app_info struct<id:string>, event_params array<struct<key:string,value:{VALUE}>>"
)


def event(minute, name, user="u1", app="My.App", session=1, **params):
    given = [
        (k, (v, None, None, None) if isinstance(v, str) else (None, v, None, None))
        for k, v in params.items()
    ]
    return ("20240101", at(minute), name, user, session, (app,), given)


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(
        [
            event(0, "open", content_group="OTA", hotel_id="1"),
            event(1, "open", content_group="ota hotel", hotel_id="1"),
            event(3, "pick", content_group="ota", hotel_id="2", hotel_name="Two"),
            event(3, "pick", content_group="ota", hotel_id="2", hotel_name="Zwei"),
            event(4, "open", content_group="ota", hotel_id="1"),
            event(9, "buy", content_group="ota", booking_id=77),
            event(5, "open", "u2", content_group="ota", hotel_id="3"),
            event(6, "open", "u2", content_group="ota flight", hotel_id="3"),
            event(7, "open", content_group="web", hotel_id="1"),
            event(7, "open", user=None, content_group="ota"),
            event(7, "open", user=" ", content_group="ota"),
            event(7, "open", session=None, content_group="ota"),
            event(7, "open", app="Other", content_group="ota"),
            event(7, "noise", content_group="ota"),
        ],
        RAW,
    )


@pytest.fixture(scope="module")
def event_map(spark):
    return spark.createDataFrame(
        [("open", "view", "search"), ("pick", "click", "carousel"), ("buy", "purchase", "N")],
        "event_name string, main_action string, upstream_event_tag string",
    )


def test_unified_events(raw, event_map):
    got = event_log.unified_events(raw, "my.app", event_map)
    # Equal keys become one row with the larger value; numbers come as text.
    assert rows(got.filter("event_name <> 'open'"), "uid", "event_name", "hotel_name", "booking_id") == [
        ("u11", "buy", None, "77"),
        ("u11", "pick", "Zwei", None),
    ]
    assert got.count() == 7
    mark = event_log.high_water_mark(got.filter("event_name = 'pick'"), "event_timestamp")
    assert mark == at(3)
    assert event_log.unified_events(raw, "my.app", event_map, mark).count() == 4
    assert event_log.high_water_mark(got.filter("false"), "event_timestamp") is None


def test_carousel_events_need_one_of_the_parameters(raw):
    got = event_log.carousel_events(raw, "MY.APP", ("pick", "buy"))
    assert rows(got, "event_name", "hotel_id", "hotel_name", "carousel_id") == [("pick", "2", "Zwei", None)]


def test_event_runs(raw, event_map):
    unified = event_log.unified_events(raw, "my.app", event_map)
    got = event_log.event_runs(unified)
    columns = ("uid", "event_name", "duration", "shift_duration", "total_duration", "hotel_id")
    assert rows(got, *columns) == [
        ("u11", "buy", 0, 0, 0, None),
        ("u11", "open", 0, 300, 300, "1"),
        ("u11", "open", 60, 120, 180, "1"),
        ("u11", "pick", 0, 60, 60, "2"),
        ("u21", "open", 0, 0, 0, "3"),
    ]
    split = event_log.event_runs(unified, max_rows=2)
    assert rows(split) == rows(got)
    assert rows(event_log.event_runs(unified, after=at(4)), "event_name", "uid") == [("buy", "u11"), ("open", "u21")]


def test_upstream_report(raw, event_map):
    got = event_log.upstream_report(raw, "my.app", event_map)
    # Different names at the same time are the same event key: the larger name stays.
    assert rows(got.filter("event_name = 'pick'"), "hotel_name", "carousel_impression", "carousel_reach") == [
        ("Zwei", 1, 1)
    ]
    searched = got.filter("event_name = 'open'")
    assert rows(searched.select("search_impression", "search_reach", "banner_reach").distinct()) == [(1, 1, 0)]
    assert "location_bubble_reach" in got.columns and got.filter("event_name = 'buy'").count() == 0


def test_training_events(spark, raw, event_map):
    runs = event_log.event_runs(event_log.unified_events(raw, "my.app", event_map))
    runs = runs.withColumn("user_id", runs["uid"].substr(2, 1))
    bookings = spark.createDataFrame([("77", "2")], "booking_id string, booking_hotel_id string")
    users = spark.createDataFrame([(1, "user_1")], "raw_user_id long, user_id string")
    items = spark.createDataFrame(
        [(1, "hotel_1", "s"), (2, "hotel_2", "s")], "hotel_code long, hotel_id string, style_name string"
    )
    got = event_log.training_events(runs, bookings, event_map, users, items)
    assert rows(got, "user_id", "main_action", "hotel_id", "complete_flag", "duration") == [
        ("user_1", "click", "hotel_2", 0, 1.0),
        ("user_1", "purchase", "hotel_2", 1, 0.0),
        ("user_1", "view", "hotel_1", 0, 8.0),
    ]

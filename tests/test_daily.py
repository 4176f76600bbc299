"""State that is carried from load to load: event runs, recent behaviour, distinct counts."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from wanderbeam.operators import behaviour, day_counts, event_log

FLAT = "uid string, user_id string, ga_session_id bigint, event_timestamp timestamp_ntz, content_group string, " + ", ".join(
    f"{c} string" for c in event_log.RUN_ATTRIBUTES
)


def flat_event(rng, uid, minute):
    given = {"first_touch_source": rng.choice(["a", None]), "event_name": rng.choice(["view", "view", "click", None]), "hotel_id": rng.choice(["1", "2", None])}
    return (uid, uid, 1, at(minute), "ota", *[given.get(c) for c in event_log.RUN_ATTRIBUTES])


@pytest.mark.parametrize("max_rows", [1_000_000, 20])
def test_five_loads_of_runs_equal_one(spark, tmp_path, max_rows):
    rng = random.Random(4)
    events = [flat_event(rng, rng.choice(["hot", "hot", "u1", "u2", "u3"]), m) for m in range(400)]
    events += [flat_event(rng, None, m) for m in range(0, 400, 40)]
    store = event_log.RunStore(spark, str(tmp_path / "runs"), max_rows=max_rows)
    for k in range(5):
        store.add(spark.createDataFrame(events[80 * k : 80 * (k + 1)] if k < 4 else events[320:], FLAT).filter("uid IS NOT NULL"))
    whole = event_log.event_runs(spark.createDataFrame(events, FLAT).filter("uid IS NOT NULL"), max_rows=max_rows)
    assert store.loads() == 5
    assert rows(store.read()) == rows(whole)
    closed = spark.read.parquet(*[f"{tmp_path}/runs/closed/load={n}" for n in range(5)]).count()
    assert closed > 0.8 * whole.count()


def test_users_that_stay_away_leave_the_state(spark, tmp_path):
    rng = random.Random(5)
    store = event_log.RunStore(spark, str(tmp_path / "runs"), idle="1 hour")
    store.add(spark.createDataFrame([flat_event(rng, "gone", m) for m in range(5)], FLAT))
    store.add(spark.createDataFrame([flat_event(rng, "here", m) for m in range(200, 205)], FLAT))
    assert {r.uid for r in store._spans(1).collect()} == {"here"}
    assert {r.uid for r in store.read().collect()} == {"gone", "here"}


@pytest.fixture(scope="module")
def domain(spark):
    items = spark.createDataFrame([(i, f"hotel_{i}", f"s{i % 3}") for i in range(6)], "hotel_code bigint, hotel_id string, style_name string")
    names = spark.createDataFrame([("view", "view"), ("click", "click"), ("noise", None)], "event_name string, main_action string")
    users = spark.createDataFrame([(u, f"user_{u}", "g", "f") for u in range(5)], "raw_user_id bigint, user_id string, age_group string, gender string")
    return items, names, users


def test_loads_of_behaviour_equal_one(spark, domain):
    items, names, users = domain
    rng = random.Random(6)
    bookings, events = [], []
    for m in range(300):
        user, item = rng.choice([0, 0, 0, 1, 2, 3]), rng.randrange(7)
        if rng.random() < 0.3:
            bookings.append((m, f'{{"customerId":"{user}"}}', f'{{"hotelId":"{item}"}}', "{}", rng.choice(["CONFIRMED", "X"]), at(m)))
        else:
            events.append((m, user, item, rng.choice(["view", "click", "noise"]), at(m + 420), 1.0))
    booking_schema = "booking_id bigint, customer_info string, request string, details string, status string, updated_at timestamp_ntz"
    event_schema = "event_id bigint, user_id bigint, hotel_code bigint, event_name string, event_timestamp timestamp_ntz, duration double"

    def frames(low, high):
        return (
            spark.createDataFrame([b for b in bookings if low <= b[0] < high], booking_schema),
            spark.createDataFrame([e for e in events if low <= e[0] < high], event_schema),
        )

    state = None
    for low in range(0, 300, 60):
        state = behaviour.recent_state(state, *frames(low, low + 60), names, items, 4)
        state = spark.createDataFrame(state.collect(), state.schema)
        assert state.groupBy("raw_user_id").count().agg(F.max("count")).first()[0] <= 4
    whole = behaviour.recent_behaviour(*frames(0, 300), names, users, items, items.select("hotel_id"), 4)
    assert rows(behaviour.behaviour_sequences(state, users)) == rows(whole)


def test_distinct_counts_from_stored_days(spark, tmp_path):
    rng = random.Random(7)
    data = [(dt.date(2024, 1, 1 + rng.randrange(12)), rng.choice("abb"), rng.choice([1, 5, 32768, 32769, 70000, rng.randrange(100_000)])) for _ in range(800)]
    data += [(None, "a", 1), (dt.date(2024, 1, 3), "a", None), (dt.date(2024, 1, 3), None, 4)]
    events = spark.createDataFrame(data, "day date, k string, id bigint")
    path, asked = str(tmp_path / "days"), []

    def between(after, upto):
        asked.append((after, upto))
        return events.filter(F.col("day") <= F.lit(upto)).filter(F.lit(True) if after is None else F.col("day") > F.lit(after))

    for upto in (4, 4, 9, 12):
        day_counts.add_days(spark, path, between, ["k"], "id", dt.date(2024, 1, upto))
    assert asked == [(None, dt.date(2024, 1, 4)), (dt.date(2024, 1, 4), dt.date(2024, 1, 9)), (dt.date(2024, 1, 9), dt.date(2024, 1, 12))]
    known = events.filter("day IS NOT NULL AND id IS NOT NULL")
    first, last = dt.date(2024, 1, 3), dt.date(2024, 1, 8)
    direct = known.filter(F.col("day").between(first, last)).groupBy("k").agg(F.count_distinct("id"))
    assert rows(day_counts.distinct_over(spark, path, first, last, ["k"], "n")) == rows(direct)
    got = {(r.until, r.k): r.n for r in day_counts.trailing_distinct(spark, path, 3, ["k"], "n").collect()}
    for (until, k), n in got.items():
        assert n == len({i for d, x, i in data if d and i is not None and x == k and 0 <= (until - d).days < 3})
    assert max(u for u, _ in got) == dt.date(2024, 1, 12)


def test_only_the_days_asked_for_are_read(spark, tmp_path):
    path = str(tmp_path / "days")
    events = spark.range(100).select(F.date_add(F.lit("2024-01-01"), (F.col("id") % 10).cast("int")).alias("day"), F.lit("a").alias("k"), "id")
    day_counts.day_bitmaps(events, ["k"], "id").write.partitionBy("day").parquet(path)
    plan = day_counts.distinct_over(spark, path, dt.date(2024, 1, 2), dt.date(2024, 1, 3), ["k"], "n")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan

"""Recent behaviour: bookings and app events as one ordered sequence per user."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wanderbeam.functions import actions, dates, json
from wanderbeam.operators.skew import lookup_join


def booking_events(bookings: DataFrame) -> DataFrame:
    """(user, item, action, local time) of the bookings."""
    return bookings.select(
        json.field(bookings, "customer_info", "customerId", "bigint").alias("raw_user_id"),
        json.field(bookings, "request", "hotelId", "bigint").alias("hotel_code"),
        actions.booking_action(F.col("status")).alias("main_action"),
        dates.local_time(F.col("updated_at")).alias("event_timestamp"),
    )


def latest_app_events(events: DataFrame, event_map: DataFrame) -> DataFrame:
    """Latest time of every (user, item, action); unmapped events and items are left out."""
    return (
        lookup_join(
            events.filter(F.col("hotel_code").isNotNull()),
            event_map.filter(F.col("main_action").isNotNull()),
            "event_name",
        )
        .groupBy(F.col("user_id").alias("raw_user_id"), "hotel_code", "main_action")
        .agg(F.max("event_timestamp").alias("event_timestamp"))
    )


def union_events(bookings: DataFrame, events: DataFrame, event_map: DataFrame) -> DataFrame:
    """Both sources as one set of distinct events."""
    both = booking_events(bookings).unionByName(latest_app_events(events, event_map))
    return both.distinct()


def repeat_visits(events: DataFrame) -> DataFrame:
    """Keep an item only where it equals the previous item of the same (user, item).

    The previous item is looked up inside the (user, item) pair, so it is the item itself or
    NULL and the rule keeps every row; collapsing consecutive repeats is ``number_runs``.
    """
    pair = Window.partitionBy("raw_user_id", "hotel_code").orderBy("event_timestamp", "main_action")
    previous = F.lag("hotel_code").over(pair)
    kept = F.when((F.col("hotel_code") == previous) | previous.isNull(), F.col("hotel_code"))
    return events.withColumn("prev_hotel_code", previous).withColumn("kept_hotel_code", kept)


def encoded_events(events: DataFrame, items: DataFrame) -> DataFrame:
    """Events of known items with class codes; actions without a code are left out."""
    known = items.select("hotel_code", "hotel_id", "style_name")
    coded = events.withColumn("main_action", actions.encode(F.col("main_action")))
    return lookup_join(coded.filter(F.col("main_action").isNotNull()), known, "hotel_code").select(
        "raw_user_id", "hotel_id", "style_name", "main_action", "event_timestamp"
    )


def recent_behaviour(
    bookings: DataFrame,
    events: DataFrame,
    event_map: DataFrame,
    users: DataFrame,
    items: DataFrame,
    trained_items: DataFrame,
    length: int = 6,
    keep: str = "last",
) -> DataFrame:
    """The ``length`` latest (``keep='last'``) or earliest (``'first'``) events of every user.

    The sequences are aligned and in time order; equal times are settled by item id and action.
    Users are cut to ``length`` rows by a rank filter, which Spark applies before the shuffle,
    and only then joined to the user dimension.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    trained = lookup_join(items, trained_items, "hotel_id", "left_semi")
    # Events of other items leave before copies are looked for.
    booked = encoded_events(booking_events(bookings), trained)
    coded = booked.unionByName(encoded_events(latest_app_events(events, event_map), trained)).distinct()
    return behaviour_sequences(_first_places(coded, length, keep), users)


ORDER = ("event_timestamp", "hotel_id", "main_action")


def _first_places(events: DataFrame, length: int, keep: str = "last") -> DataFrame:
    """The ``length`` latest or earliest events of every user; the map side already cuts to as many."""
    ranked = [F.col(c).desc() if keep == "last" else F.col(c).asc() for c in ORDER]
    window = Window.partitionBy("raw_user_id").orderBy(*ranked)
    placed = events.withColumn("place", F.row_number().over(window))
    return placed.filter(F.col("place") <= length).drop("place")


def behaviour_sequences(kept: DataFrame, users: DataFrame) -> DataFrame:
    """Aligned sequences, in time order, of a bounded number of events per user."""
    entry = F.struct(*ORDER, "style_name")
    sequences = kept.groupBy("raw_user_id").agg(F.sort_array(F.collect_list(entry)).alias("s"))
    return lookup_join(
        sequences, users.select("raw_user_id", "user_id", "age_group", "gender"), "raw_user_id"
    ).select(
        "user_id",
        F.col("s.hotel_id").alias("hotel_id_sequence"),
        F.col("s.main_action").alias("main_action_sequence"),
        F.col("s.style_name").alias("style_sequence"),
        "age_group",
        "gender",
    )


def recent_state(
    state: DataFrame | None,
    bookings: DataFrame,
    events: DataFrame,
    event_map: DataFrame,
    items: DataFrame,
    length: int = 6,
) -> DataFrame:
    """The latest events of every user after some more bookings and app events: at most ``length`` rows per user.

    ``state`` is what the load before left (None at the start), so a load reads its own rows and the bounded
    state, never the history. ``booked`` and ``app`` say which source an event comes from: of an (item, action) only the
    latest app event counts, bookings all do. An event that left the ``length`` latest can't come back, since only newer
    ones push it out; so loads in any order of time, in any number, end with the state of one load of everything.
    (The earliest events have no such state: a newer app event moves its pair back and would let an event in that was dropped.)
    """
    booked = encoded_events(booking_events(bookings), items)
    app = encoded_events(latest_app_events(events, event_map), items)
    columns = ["raw_user_id", "main_action", "hotel_id", "style_name"]
    if state is not None:
        booked = booked.unionByName(state.filter("booked").select(*booked.columns))
        app = app.unionByName(state.filter("app").select(*app.columns))
    latest = app.groupBy(*columns).agg(F.max("event_timestamp").alias("event_timestamp"))
    both = booked.withColumns({"booked": F.lit(True), "app": F.lit(False)}).unionByName(
        latest.withColumns({"booked": F.lit(False), "app": F.lit(True)})
    )
    merged = both.groupBy(*columns, "event_timestamp").agg(F.max("booked").alias("booked"), F.max("app").alias("app"))
    return _first_places(merged, length)


def flag_eligible(behaviour: DataFrame, trained_users: DataFrame, length: int = 6) -> DataFrame:
    """``is_eligible``: the user was trained on and has at least ``length`` events."""
    trained = trained_users.select("user_id").distinct().withColumn("__trained", F.lit(True))
    long_enough = F.coalesce(F.size("hotel_id_sequence"), F.lit(0)) >= length
    return (
        behaviour.join(trained, "user_id", "left")
        .withColumn("is_eligible", F.coalesce("__trained", F.lit(False)) & long_enough)
        .drop("__trained")
    )


def split_eligible(
    behaviour: DataFrame, trained_users: DataFrame, length: int = 6
) -> tuple[DataFrame, DataFrame]:
    """(eligible, cold start): disjoint, and together all users."""
    flagged = flag_eligible(behaviour, trained_users, length)
    return (
        flagged.filter("is_eligible").drop("is_eligible"),
        flagged.filter("NOT is_eligible").drop("is_eligible"),
    )

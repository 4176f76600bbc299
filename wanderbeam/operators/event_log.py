"""From raw app events with key-value parameters to the training events table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wanderbeam.operators.skew import (
    MAX_GROUP_ROWS,
    group_limit,
    lookup_join,
    number_runs,
    with_neighbour,
)
from wanderbeam.session import materialise
from wanderbeam.sources.tables import partition_values

# Parameters of the unified event table.
EVENT_PARAMS = (
    "content_group",
    "first_touch_source",
    "carousel_id",
    "carousel_name",
    "hotel_id",
    "hotel_name",
    "booking_id",
    "hotel_destination_id",
    "banner_id",
    "recommendlocation_id",
    "search_term",
)
# Events and parameters of the carousel table.
CAROUSEL_EVENTS = (
    "hotel_main_carousel_click",
    "hotel_main_carouselviewall_click",
    "hotel_carouselviewall_select_click",
)
CAROUSEL_PARAMS = ("hotel_id", "hotel_name", "carousel_id", "carousel_name")
# Entry points counted by the upstream report.
UPSTREAM_TAGS = (
    "search",
    "location_bubble",
    "search_recommend",
    "favorite_list",
    "carousel",
    "banner",
)
UPSTREAM_PARAMS = ("hotel_id", "hotel_name", "first_touch_source")
# Content groups kept by the two event tables.
EVENT_CONTENT = ("ota hotel", "ota", "ota flight")
SESSION_CONTENT = ("ota", "ota hotel")

EVENT_KEY = ("event_date", "event_timestamp", "event_name", "user_id", "ga_session_id", "uid")
RUN_ATTRIBUTES = (
    "first_touch_source",
    "event_name",
    "hotel_id",
    "booking_id",
    "hotel_destination_id",
    "banner_id",
    "carousel_id",
    "recommendlocation_id",
)


def app_events(raw: DataFrame, app_id: str) -> DataFrame:
    """Events of one app with a user and a session, and their joint ``uid``."""
    return raw.filter(
        (F.lower("app_info.id") == app_id.lower())
        & F.col("user_id").isNotNull()
        & (F.col("user_id") != " ")
        & F.col("ga_session_id").isNotNull()
    ).withColumn("uid", F.concat("user_id", F.col("ga_session_id").cast("string")))


def _values_of(key: str) -> Column:
    """All values given for ``key``, whichever typed slot they are in."""
    hits = F.filter("event_params", lambda p: p["key"] == key)
    return F.transform(
        hits,
        lambda p: F.coalesce(
            p["value"]["string_value"],
            p["value"]["int_value"].cast("string"),
            p["value"]["float_value"].cast("string"),
            p["value"]["double_value"].cast("string"),
        ),
    )


def flatten_params(
    events: DataFrame, params: Sequence[str], key: Sequence[str] = EVENT_KEY, any_of: bool = False
) -> DataFrame:
    """One row per event key with one column per parameter (its largest value).

    The values are taken out of the array in place; nothing is exploded, so one row per
    event is shuffled instead of one per parameter. ``any_of`` keeps only events that carry
    at least one of the parameters.
    """
    if any_of:
        events = events.filter(F.exists("event_params", lambda p: p["key"].isin(*params)))
    taken = events.select(*key, *[F.array_max(_values_of(p)).alias(p) for p in params])
    return taken.groupBy(*key).agg(*[F.max(p).alias(p) for p in params])


def carousel_events(raw: DataFrame, app_id: str, names: Sequence[str] = CAROUSEL_EVENTS) -> DataFrame:
    wanted = app_events(raw, app_id).filter(F.col("event_name").isin(*names))
    return flatten_params(wanted, CAROUSEL_PARAMS, any_of=True)


def unified_events(
    raw: DataFrame,
    app_id: str,
    event_names: DataFrame,
    after: dt.datetime | None = None,
    content: Sequence[str] = EVENT_CONTENT,
) -> DataFrame:
    """Known events newer than ``after`` (all if None) in the wanted content groups."""
    return in_content(known_events(raw, app_id, event_names, after), content)


def known_events(
    raw: DataFrame, app_id: str, event_names: DataFrame, after: dt.datetime | None = None
) -> DataFrame:
    """One row per event key of the known events, whatever its content group."""
    wanted = app_events(raw, app_id)
    if after is not None:
        wanted = wanted.filter(F.col("event_timestamp") > F.lit(after))
    named = lookup_join(wanted, event_names.select("event_name").distinct(), "event_name", "left_semi")
    return flatten_params(named, EVENT_PARAMS)


def merged_events(flat: DataFrame) -> DataFrame:
    """Rows of one event key as one row: its largest value of every parameter.

    Merging what was merged before changes nothing, so parts and copies of an event may be merged in any order.
    """
    return flat.groupBy(*EVENT_KEY).agg(*[F.max(p).alias(p) for p in EVENT_PARAMS])


def in_content(events: DataFrame, content: Sequence[str] = EVENT_CONTENT) -> DataFrame:
    return events.filter(F.lower("content_group").isin(*content))


def high_water_mark(table: DataFrame, column: str):
    """Largest value already loaded; None for an empty table, which then loads everything."""
    return table.agg(F.max(column)).first()[0]


# What settles the order of events, and of spans, of one time.
TIE = [
    "event_name",
    "hotel_id",
    "booking_id",
    "hotel_destination_id",
    "banner_id",
    "carousel_id",
    "recommendlocation_id",
    "first_touch_source",
]
SPAN_KEY = ("uid", "user_id", "ga_session_id", "run", *RUN_ATTRIBUTES)


def _session_events(events: DataFrame, content: Sequence[str]) -> DataFrame:
    rows = in_content(events, content)
    return rows.select("uid", "user_id", "ga_session_id", "event_timestamp", *RUN_ATTRIBUTES)


def _run_spans(rows: DataFrame, limit: int | None) -> DataFrame:
    """First and last time of equal events in each run of a ``uid``."""
    runs = number_runs(rows, ["uid"], ["event_timestamp", *TIE], "event_name", "run", limit)
    return runs.groupBy(*SPAN_KEY).agg(
        F.min("event_timestamp").alias("min_event_timestamp"),
        F.max("event_timestamp").alias("max_event_timestamp"),
    )


def _linked(spans: DataFrame, limit: int | None) -> DataFrame:
    """Spans with the time of the next span of their uid (NULL for the last)."""
    order = ["max_event_timestamp", "run", *TIE]
    return with_neighbour(spans, ["uid"], order, "max_event_timestamp", "next_event_timestamp", 1, limit)


def _durations(linked: DataFrame) -> DataFrame:
    inside = F.timestamp_diff("SECOND", F.col("min_event_timestamp"), F.col("max_event_timestamp"))
    shift = F.coalesce(
        F.timestamp_diff("SECOND", F.col("max_event_timestamp"), F.col("next_event_timestamp")),
        F.lit(0),
    )
    return linked.select(
        "uid",
        "user_id",
        "ga_session_id",
        "event_name",
        inside.alias("duration"),
        shift.alias("shift_duration"),
        (inside + shift).alias("total_duration"),
        "hotel_id",
        "booking_id",
        "hotel_destination_id",
        "banner_id",
        "carousel_id",
        "recommendlocation_id",
        "min_event_timestamp",
        "max_event_timestamp",
    )


def event_runs(
    events: DataFrame,
    after: dt.datetime | None = None,
    content: Sequence[str] = SESSION_CONTENT,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Consecutive equal events of a ``uid`` as one row with its durations in seconds.

    ``duration`` is the time inside the run, ``shift_duration`` the time until the next row
    of the uid (0 for the last), ``total_duration`` their sum. Run numbers count per uid, so
    no global ordering is needed; equal times are settled by event name, item and booking.
    """
    rows = _session_events(events, content)
    if after is not None:
        rows = rows.filter(F.col("event_timestamp") > F.lit(after))
    limit = group_limit(rows, ["uid"], max_rows)
    return _durations(_linked(_run_spans(rows, limit), limit))


class RunStore:
    """Event runs that grow load by load, so that no load reads the history again.

    ``closed/load=n`` holds the rows that load n made final. ``open/load=n`` holds, for every uid, the spans of
    its last two runs: the last run may go on, and until it has ended the time of the next span may still change for
    the run before it. A uid without an event for ``idle`` (its session is over) is closed as it stands.
    """

    def __init__(self, spark: SparkSession, root: str, idle: str = "2 days", max_rows: int = MAX_GROUP_ROWS) -> None:
        self.spark, self.root, self.idle, self.max_rows = spark, root, idle, max_rows

    def loads(self) -> int:
        """Number of finished loads; a load is finished when its open spans are written."""
        return len(partition_values(self.spark, f"{self.root}/open", "load"))

    def _spans(self, load: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/open/load={load}")

    def add(self, events: DataFrame, content: Sequence[str] = SESSION_CONTENT) -> None:
        """Continue the runs with events that are not older than the loaded ones of their uid."""
        rows, load = _session_events(events, content), self.loads()
        spans = _run_spans(rows, group_limit(rows, ["uid"], self.max_rows))
        if load:
            held = self._spans(load - 1).drop("next_event_timestamp")
            last = held.groupBy("uid").agg(F.max_by("event_name", "run").alias("name"), F.max("run").alias("upto"))
            first = spans.filter("run = 1").groupBy("uid").agg(F.max("event_name").alias("first"))
            goes_on = F.when(F.col("first") == F.col("name"), 1).otherwise(0)
            shift = first.join(last, "uid").select("uid", (F.col("upto") - goes_on).alias("shift"))
            spans = lookup_join(spans, shift, "uid", "left")
            spans = spans.withColumn("run", F.col("run") + F.coalesce("shift", F.lit(0))).drop("shift")
            spans = held.unionByName(spans).groupBy(*SPAN_KEY).agg(
                F.min("min_event_timestamp").alias("min_event_timestamp"),
                F.max("max_event_timestamp").alias("max_event_timestamp"),
            )
        spans = materialise(spans, "run-spans")
        limit = group_limit(spans, ["uid"], self.max_rows)
        over = F.max("max_event_timestamp") - F.expr(f"INTERVAL {self.idle}")
        over = spans.agg(F.unix_micros(over.cast("timestamp")).alias("over")).first()["over"]
        ends = spans.groupBy("uid").agg(F.max("run").alias("upto"), F.max("max_event_timestamp").alias("seen"))
        marked = lookup_join(_linked(spans, limit), ends, "uid", "left")
        final = F.col("run") < F.col("upto") - 1
        if over is not None:
            final = final | (F.unix_micros(F.col("seen").cast("timestamp")) < over)
        marked = materialise(marked.withColumn("final", final).drop("upto", "seen"), "run-marks")
        marked.filter("final").drop("final").write.mode("overwrite").parquet(f"{self.root}/closed/load={load}")
        kept = marked.filter("NOT final").select(*SPAN_KEY, "min_event_timestamp", "max_event_timestamp", "next_event_timestamp")
        # Written last: a load that failed before is simply done again.
        kept.write.mode("errorifexists").parquet(f"{self.root}/open/load={load}")

    def read(self) -> DataFrame:
        """The runs as ``event_runs`` over all loaded events gives them."""
        load = self.loads() - 1
        closed = self.spark.read.parquet(*[f"{self.root}/closed/load={n}" for n in range(load + 1)])
        return _durations(closed.unionByName(self._spans(load)))


def upstream_report(
    raw: DataFrame, app_id: str, event_map: DataFrame, tags: Sequence[str] = UPSTREAM_TAGS
) -> DataFrame:
    """Distinct sessions (``<tag>_impression``) and users (``<tag>_reach``) per entry point.

    One row per event time, name and the three parameters; events without an item or with
    the tag ``N`` are left out. Users and sessions are made distinct before they are counted.
    """
    tagged = lookup_join(
        app_events(raw, app_id),
        event_map.filter(F.col("upstream_event_tag") != "N").select("event_name", "upstream_event_tag"),
        "event_name",
    )
    key = ["user_id", "event_date", "event_timestamp", "event_name", "upstream_event_tag", "uid"]
    flat = flatten_params(tagged, UPSTREAM_PARAMS, key, any_of=True).filter(
        F.col("hotel_id").isNotNull()
    )
    group = ["event_date", "event_timestamp", "event_name", *UPSTREAM_PARAMS]
    counts = flat.groupBy(*group, "upstream_event_tag").agg(
        F.count_distinct("uid").alias("impression"), F.count_distinct("user_id").alias("reach")
    )
    # Every (group, tag) is one row now, so the pivot only moves values into columns.
    columns = []
    for tag in tags:
        here = F.col("upstream_event_tag") == tag
        for measure in ("impression", "reach"):
            columns.append(
                F.coalesce(F.max(F.when(here, F.col(measure))), F.lit(0)).alias(f"{tag}_{measure}")
            )
    return counts.groupBy(*group).agg(*columns)


def training_events(
    runs: DataFrame,
    bookings: DataFrame,
    event_map: DataFrame,
    users: DataFrame,
    items: DataFrame,
) -> DataFrame:
    """Per (uid, user, action, item, completed): minutes spent and the latest time.

    ``bookings`` has (booking_id, booking_hotel_id), one row per booking. A run without an
    item takes the booked one; ``complete_flag`` tells whether a booking was found. The runs
    are summed up before the dimension lookups, which then meet one row per group.
    """
    booked = lookup_join(runs, bookings, "booking_id", "left")
    mapped = lookup_join(
        booked, event_map.select("event_name", "main_action"), "event_name"
    ).filter(F.col("main_action").isNotNull())
    spent = (
        mapped.withColumn("hotel_code", F.coalesce("hotel_id", "booking_hotel_id").try_cast("bigint"))
        .withColumn("raw_user_id", F.col("user_id").try_cast("bigint"))
        .withColumn("complete_flag", F.col("booking_hotel_id").isNotNull().cast("int"))
        .groupBy("uid", "raw_user_id", "main_action", "hotel_code", "complete_flag")
        .agg(
            # Whole seconds are summed before the division: the result has no sum order.
            F.round(F.sum("total_duration") / 60, 2).alias("duration"),
            F.max("max_event_timestamp").alias("event_timestamp"),
        )
    )
    known_users = users.select("raw_user_id", "user_id")
    known_items = items.select("hotel_code", "hotel_id", "style_name")
    located = lookup_join(spent, known_items, "hotel_code")
    return lookup_join(located, known_users, "raw_user_id").select(
        "user_id",
        "main_action",
        "hotel_id",
        "style_name",
        F.coalesce("duration", F.lit(0.0)).alias("duration"),
        "complete_flag",
        "event_timestamp",
    )

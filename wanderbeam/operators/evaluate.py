"""Offline evaluation: user segments, held-out behaviour, hits@n."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wanderbeam.functions import actions, arrays
from wanderbeam.operators.recommend import Offered
from wanderbeam.operators.skew import (
    MAX_GROUP_ROWS,
    group_limit,
    lookup_join,
    number_rows,
    number_runs,
)

PROMISING = ("click", "fav", "purchase")


def action_counts(predictions: DataFrame | Offered) -> DataFrame:
    """Predicted items per user and action; every action is a column, 0 if absent.

    Of ``Offered`` rows the items are counted once per location.
    """
    if isinstance(predictions, Offered):
        counted = predictions.per_user("main_action")
        here = [F.sum(F.when(F.col("main_action") == a, F.col("n")).otherwise(0)).alias(a) for a in actions.ACTION_NAMES]
        return counted.groupBy("user_id").agg(*here)
    return predictions.groupBy("user_id").agg(
        *[F.count_if(F.col("main_action") == a).alias(a) for a in actions.ACTION_NAMES]
    )


def segment_users(predictions: DataFrame | Offered) -> DataFrame:
    counts = action_counts(predictions)
    hits = sum((F.col(a) for a in PROMISING), F.lit(0))
    return counts.withColumn("segment", F.when(hits > 0, "promising").otherwise("ordinary"))


# Total up to equal rows.
ORDER = ("event_timestamp", "hotel_id", "main_action")


def held_out_events(
    events: DataFrame,
    event_map: DataFrame,
    users: DataFrame,
    items: DataFrame,
    after: str | dt.date,
) -> DataFrame:
    """Mapped events of known users after day ``after``; unknown items stay as NULL."""
    codes = event_map.filter(F.col("encoded_main_action").isNotNull()).select(
        "event_name", "encoded_main_action"
    )
    late = events.filter(
        (F.to_date("event_timestamp") > F.lit(str(after)).cast("date"))
        & F.col("hotel_code").isNotNull()
    )
    mapped = lookup_join(late, codes, "event_name")
    known = users.filter(F.col("user_id").isNotNull()).select(
        F.col("raw_user_id"), F.col("user_id").alias("dim_user_id"), "gender", "age_group"
    )
    owned = lookup_join(
        mapped.withColumnRenamed("user_id", "raw_user_id"), known, "raw_user_id"
    )
    return lookup_join(owned, items.select("hotel_code", "hotel_id"), "hotel_code", "left").select(
        F.col("dim_user_id").alias("user_id"),
        "gender",
        "age_group",
        "hotel_id",
        F.col("encoded_main_action").alias("main_action"),
        "event_timestamp",
    )


def skip_first(
    events: DataFrame, n_skip: int = 6, max_rows: int | None = MAX_GROUP_ROWS, order: Sequence[str] = ORDER
) -> DataFrame:
    """Every user's events without the first ``n_skip``."""
    numbered = number_rows(events, ["user_id"], list(order), "place", max_rows=max_rows)
    return numbered.filter(F.col("place") > n_skip)


def collapse_repeats(
    events: DataFrame, max_rows: int | None = MAX_GROUP_ROWS, order: Sequence[str] = ORDER
) -> DataFrame:
    """Runs of the same item as one row: first item, largest action code.

    (user_id, gender, age_group, run, hotel_id, main_action); users without gender or age
    group are left out. The long form stays whole however long a user's history is.
    """
    order = list(order)
    grouped = events.filter(F.col("gender").isNotNull() & F.col("age_group").isNotNull()).select(
        "user_id", "gender", "age_group", *dict.fromkeys([*order, "hotel_id", "main_action"])
    )
    runs = number_runs(grouped, ["user_id"], order, "hotel_id", "run", max_rows)
    return runs.groupBy("user_id", "gender", "age_group", "run").agg(
        F.min_by("hotel_id", F.struct(*order)).alias("hotel_id"),
        F.max("main_action").alias("main_action"),
    )


def holdout(
    events: DataFrame,
    event_map: DataFrame,
    users: DataFrame,
    items: DataFrame,
    after: str | dt.date,
    n_skip: int = 6,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """What users did after ``after``, past their first ``n_skip`` events, without repeats."""
    late = held_out_events(events, event_map, users, items, after)
    # Nothing below gives a user more rows than the event table has for them.
    limit = group_limit(events, ["user_id"], max_rows)
    return collapse_repeats(skip_first(late, n_skip, limit), limit)


def first_runs(runs: DataFrame, n: int) -> DataFrame:
    """(user_id, actual, n_runs): the first ``n`` items; at most ``n`` are ever collected."""
    entry = F.struct("run", "hotel_id")
    heads = runs.filter(F.col("run") <= n)
    return heads.groupBy("user_id").agg(
        F.sort_array(F.collect_list(entry))["hotel_id"].alias("actual"),
        F.count(F.lit(1)).alias("n_runs"),
    )


def hits_at_n(playlists: DataFrame, runs: DataFrame, n: int = 10) -> DataFrame:
    """(user_id, hits): playlist items among the first ``n`` held-out ones, as sets.

    NULL if a user has fewer than ``n``; users without held-out items are left out.
    """
    joined = playlists.join(first_runs(runs, n), "user_id")
    hits = F.when(F.col("n_runs") >= n, arrays.overlap(F.col("hotel_ids"), F.col("actual")))
    return joined.select("user_id", hits.alias("hits"))


def top_k_history(pairs: DataFrame, playlists: DataFrame, k: int = 10) -> DataFrame:
    """Playlists with the first ``k`` entries of the user's delimited history."""
    histories = pairs.join(playlists.select("user_id"), "user_id", "left_semi").select(
        "user_id", arrays.first_of_delimited(F.col("sequence_hotel_ids"), k).alias("history")
    )
    return playlists.join(histories, "user_id", "left")

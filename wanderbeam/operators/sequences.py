"""Training sequences: ordered lists, count-based windows, targets and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wanderbeam.functions import actions, arrays
from wanderbeam.operators.ids import dense_ids
from wanderbeam.operators.skew import (
    MAX_GROUP_ROWS,
    Grouped,
    lookup_join,
    number_groups,
    split_heavy_groups,
)

SEQUENCE_FIELDS = ("hotel_id", "main_action", "complete_flag", "duration")
# Total up to equal rows; events with more columns to tell apart pass a longer order.
ORDER = ("event_timestamp", "hotel_id", "main_action")


def seen_items(events: DataFrame) -> DataFrame:
    """Distinct items per user; a NULL item counts as one.

    Pairs are made distinct first, so a user's rows never meet in one task.
    """
    pairs = events.select("user_id", "hotel_id").distinct()
    return pairs.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_items"))


def sliding_windows(
    events: DataFrame,
    fields: Sequence[str] = SEQUENCE_FIELDS,
    length: int = 6,
    step: int = 5,
    order: Sequence[str] = ORDER,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Count-based windows of every user's events: (user_id, win, <field>_sequence...).

    Starts are 0, step, 2*step, ... and then always the last ``length`` events, so the last
    window comes twice where the steps hit it. Users with fewer events give no window.
    Users with more than ``max_rows`` events are never collected: their events are numbered
    and each is sent to the windows it belongs to.
    """
    light, heavy = _window_parts(events, fields, length, step, order, max_rows)
    return light if heavy is None else light.unionByName(heavy)


def _window_parts(
    events: DataFrame,
    fields: Sequence[str],
    length: int,
    step: int,
    order: Sequence[str],
    max_rows: int | None,
) -> tuple[DataFrame, DataFrame | None]:
    """Windows of the users with few events and of the others (None if there are none)."""
    rows = events.select(*dict.fromkeys(["user_id", *order, *fields])).filter(F.col("user_id").isNotNull())
    # Both ways settle equal places by the fields, so a user's windows don't depend on how many events they have.
    groups = split_heavy_groups(rows, ["user_id"], list(dict.fromkeys([*order, *fields])), max_rows)
    light = _windows_from_lists(groups.light, fields, length, step, order)
    if groups.heavy is None:
        return light, None
    return light, _windows_from_positions(groups, fields, length, step, order)


def _windows_from_lists(
    events: DataFrame, fields: Sequence[str], length: int, step: int, order: Sequence[str]
) -> DataFrame:
    entry = F.struct(*dict.fromkeys([*order, *fields]))
    lists = events.groupBy("user_id").agg(F.sort_array(F.collect_list(entry)).alias("s"))
    windows = lists.select(
        "user_id", F.posexplode(arrays.count_windows(F.col("s"), length, step)).alias("win", "w")
    )
    return windows.select(
        "user_id", F.col("win").cast("long").alias("win"), *_aligned(fields)
    )


def _aligned(fields: Sequence[str]) -> list[Column]:
    return [F.col(f"w.{f}").alias(f"{f}_sequence") for f in fields]


def _windows_from_positions(
    groups: Grouped, fields: Sequence[str], length: int, step: int, order: Sequence[str]
) -> DataFrame:
    heavy = Grouped(groups.light.limit(0), groups.heavy, groups.keys, groups.order)
    placed = number_groups(heavy, "place", "n").filter(F.col("n") >= length)
    at = F.col("place") - 1
    last_start = F.col("n") - length
    regular = F.floor(last_start / step)
    lowest = F.greatest(F.ceil((at - length + 1) / step), F.lit(0))
    highest = F.least(F.floor(at / step), regular)
    inside = F.when(highest >= lowest, F.sequence(lowest, highest)).otherwise(
        F.array().cast("array<bigint>")
    )
    tail = F.when(at >= last_start, F.array(regular + 1)).otherwise(F.array().cast("array<bigint>"))
    member = placed.withColumn("win", F.explode(F.concat(inside, tail)))
    entry = F.struct(*dict.fromkeys([*order, *fields]))
    return (
        member.groupBy("user_id", "win")
        .agg(F.sort_array(F.collect_list(entry)).alias("w"))
        .select("user_id", "win", *_aligned(fields))
    )


def training_sequences(
    events: DataFrame,
    users: DataFrame,
    length: int = 6,
    step: int = 5,
    min_items: int = 5,
    fields: Sequence[str] = SEQUENCE_FIELDS,
    order: Sequence[str] = ORDER,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Windows of the users who saw at least ``min_items`` items, with the user's attributes."""
    coded = events.withColumn("main_action", actions.encode(F.col("main_action")))
    keen = seen_items(coded).filter(F.col("n_items") >= min_items).select("user_id")
    owners = users.select("user_id", "gender", "age", "age_group_label", "age_group")
    light, heavy = _window_parts(coded, fields, length, step, order, max_rows)
    # Lists are built per user, so these joins reuse their partitioning by user.
    windows = light.join(keen, "user_id", "left_semi").join(owners, "user_id", "left")
    if heavy is None:
        return windows
    kept = lookup_join(heavy, keen, "user_id", "left_semi")
    return windows.unionByName(lookup_join(kept, owners, "user_id", "left"))


def history_target(windows: DataFrame, target_field: str = "main_action") -> DataFrame:
    """Last item and last target of a window are the label, the items before are the history."""
    target_sequence = f"{target_field}_sequence"
    result = windows.withColumns(
        {
            "target_hotel_id": arrays.last_item(F.col("hotel_id_sequence")),
            "sequence_hotel_ids": arrays.all_but_last(F.col("hotel_id_sequence")),
            "target": arrays.last_item(F.col(target_sequence)),
            target_sequence: arrays.all_but_last(F.col(target_sequence)),
        }
    )
    if "style_name_sequence" in windows.columns:
        result = result.withColumns(
            {
                "target_style": arrays.last_item(F.col("style_name_sequence")),
                "style_name_sequence": arrays.all_but_last(F.col("style_name_sequence")),
            }
        )
    return result


def split_bounds(n: int, test_size: float = 0.15, eval_size: float = 0.15) -> tuple[int, int]:
    """(train rows, train + test rows) for ``n`` rows; the remainder is for evaluation."""
    train = int(n * (1 - (test_size + eval_size)) - 1) + 1
    return train, train + int(n * test_size)


def exact_split(
    windows: DataFrame,
    keys: Sequence[str] = ("user_id", "win"),
    seed: int = 42,
    shuffle_key: Column | None = None,
    test_size: float = 0.15,
    eval_size: float = 0.15,
) -> DataFrame:
    """Seeded 70/15/15 split by exact row counts; adds ``split``.

    Rows are ordered by a hash of their key, never by chance, so a rerun gives the same split.
    Pass ``keys=("user_id",)`` with a frame of users to keep a user's windows together.
    """
    if shuffle_key is None:
        shuffle_key = F.xxhash64(*keys, F.lit(seed))
    mixed = windows.withColumn("__mix", shuffle_key)
    numbered = dense_ids(mixed, ["__mix", *keys], "__row")
    train, until_test = split_bounds(numbered.count(), test_size, eval_size)
    part = (
        F.when(F.col("__row") <= train, "train")
        .when(F.col("__row") <= until_test, "test")
        .otherwise("eval")
    )
    return numbered.withColumn("split", part).drop("__mix", "__row")


def user_split(
    windows: DataFrame, seed: int = 42, shuffle_key: Column | None = None
) -> DataFrame:
    """The same shares over users: overlapping windows of a user stay in one split."""
    users = exact_split(windows.select("user_id").distinct(), ("user_id",), seed, shuffle_key)
    return lookup_join(windows, users, "user_id")


def kway_split(df: DataFrame, order: Sequence[str], k: int, part: str = "part") -> DataFrame:
    """``k`` consecutive parts of equal size in ``order``; the last one takes the remainder."""
    if k <= 0:
        raise ValueError(f"cannot cut into {k} parts")
    numbered = dense_ids(df, order, "__row")
    size = numbered.count() // k
    number = F.lit(k) if size == 0 else F.least(F.ceil(F.col("__row") / size), F.lit(k))
    return numbered.withColumn(part, number.cast("long")).drop("__row")

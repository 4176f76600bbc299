"""The best items of every user without scoring every item for every user.

The score of a pair is a user part plus an item part (see ``bayes``). Items of a location are laid
in blocks of similar items; for a user, a block has an upper bound that no item in it can
pass. Blocks are opened from the highest bound down, until ``k`` items are safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wanderbeam.operators.bayes import class_probabilities
from wanderbeam.operators.scoring import N_CLASSES, with_importance
from wanderbeam.operators.skew import MAX_GROUP_ROWS, expanding_join, lookup_join, number_rows
from wanderbeam.session import materialise, shuffle_width

BLOCK = 32
# Scores are rounded before they are compared; a bound must not fall short by that.
SLACK = 1e-6
PLACES = 9


def item_blocks(items: DataFrame, size: int = BLOCK, max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Blocks of up to ``size`` items of one location: block_id, location_name, n, entries and gaps.

    ``items`` has location_name, hotel_id and item_logs. Items are laid out by the class and the importance they have on
    their own, so that a block holds items of one kind. ``gaps[c * classes + j]`` is the
    largest lead of class c over class j among the items.
    """
    alone = with_importance(items.select("location_name", "hotel_id", "item_logs"), class_probabilities(F.col("item_logs")))
    laid = alone.withColumns({"__class": -F.col("pred_action"), "__value": -F.col("important_value")})
    placed = number_rows(laid, ["location_name"], ["__class", "__value", "hotel_id"], "__place", max_rows=max_rows)
    number = F.floor((F.col("__place") - 1) / size).cast("string")
    leads = [
        F.max(F.col("item_logs")[c] - F.col("item_logs")[j]) for c in range(N_CLASSES) for j in range(N_CLASSES)
    ]
    return (
        placed.groupBy("location_name", F.concat_ws("#", "location_name", number).alias("block_id"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.collect_list(F.struct("hotel_id", "item_logs")).alias("entries"),
            F.array(*leads).alias("gaps"),
        )
    )


def block_bound(logs: str = "user_logs", gaps: str = "gaps") -> Column:
    """The largest importance that an item of the block can have for the user.

    The probability of class c is 1 / sum over j of exp(log_j - log_c), which is largest where c leads
    by its gaps. A class that stays behind another even then can't be the predicted one.
    """
    best = F.lit(0.0)
    for c in range(1, N_CLASSES):
        behind = [F.col(logs)[j] - F.col(logs)[c] - F.col(gaps)[c * N_CLASSES + j] for j in range(N_CLASSES) if j != c]
        total = F.lit(1.0)
        for b in behind:
            total = total + F.exp(b)
        wins = F.greatest(*behind) <= SLACK
        best = F.greatest(best, F.when(wins, F.lit(float(c)) / total).otherwise(0.0))
    return best + SLACK


def _opened(pairs: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """The best ``k`` items of every (user, block), scored inside the row of the pair.

    A pair is a short row and much work, so the pairs are dealt to all tasks, however few bytes they are.
    """
    pairs = pairs.repartition(shuffle_width(pairs.sparkSession), "user_id", "block_id")
    found = lookup_join(pairs, blocks.select("block_id", "entries"), "block_id")
    items = found.select("user_id", "user_logs", F.explode("entries").alias("e"))
    both = F.zip_with("user_logs", "e.item_logs", lambda a, b: a + b)
    scored = with_importance(items, class_probabilities(both))
    return scored.select("user_id", F.col("e.hotel_id").alias("target_hotel_id"), "pred_action", "prob", "important_value")


def _best(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("user_id").orderBy(F.desc(F.round("important_value", PLACES)), "target_hotel_id")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def best_alike(items: DataFrame, k: int) -> DataFrame:
    """The ``k`` smallest item ids of those that score the same for every user: equal values go by item id."""
    alike = Window.partitionBy("location_name", "item_logs").orderBy("hotel_id")
    return items.withColumn("__place", F.row_number().over(alike)).filter(F.col("__place") <= k).drop("__place")


def top_items(users: DataFrame, items: DataFrame, k: int = 10, size: int = BLOCK, max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """user_id, rank, target_hotel_id, pred_action, prob and important_value of every user's best ``k`` items.

    ``users`` has user_id (unique), location_name and user_logs, ``items`` location_name, hotel_id and item_logs.
    Of items that are alike to the score only ``k`` take part. First every user opens the blocks of highest bound that hold ``k`` items; the last of their best
    ``k`` is a value that further items have to reach. Then only the blocks whose bound reaches it are
    opened. What is shuffled is users times blocks, and the items of the opened blocks. The result is that of
    scoring all pairs; equal values go by item id.
    """
    blocks = materialise(item_blocks(best_alike(items, k), size, max_rows), "item-blocks")
    facts = users.select("user_id", "location_name", "user_logs")
    met = expanding_join(facts, blocks.select("location_name", "block_id", "n", "gaps"), "location_name", "user_id")
    bounded = met.select("user_id", "user_logs", "block_id", "n", block_bound().alias("bound"))
    by_bound = Window.partitionBy("user_id").orderBy(F.desc("bound"), "block_id").rowsBetween(Window.unboundedPreceding, -1)
    ranked = bounded.withColumn("first", F.coalesce(F.sum("n").over(by_bound), F.lit(0)) < k)
    ranked = materialise(ranked.drop("n"), "block-bounds")
    first = materialise(_best(_opened(ranked.filter("first"), blocks, k), k), "first-blocks")
    least = first.filter(F.col("rank") == k).select("user_id", F.col("important_value").alias("least"))
    rest = lookup_join(ranked.filter("NOT first"), least, "user_id", "left")
    # Without ``k`` items in its first blocks a user has no further ones.
    rest = rest.filter(F.col("bound") + SLACK >= F.col("least")).drop("least", "bound", "first")
    return _best(first.drop("rank").unionByName(_opened(rest, blocks, k)), k)

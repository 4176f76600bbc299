"""Decomposed scores with pruned top lists, context tree, successive halving."""

from __future__ import annotations

import random

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from wanderbeam.operators import bayes, context_tree, pruned, scoring, tuning
from wanderbeam.operators.scoring import N_CLASSES

LOGS = "array<double>"


@pytest.fixture(scope="module")
def parts(spark):
    rng = random.Random(1)
    logs = lambda spread: [rng.uniform(-spread, 0) for _ in range(N_CLASSES)]
    users = [(f"u{i}", rng.choice(["big", "big", "small", "tiny"]), logs(4)) for i in range(40)]
    items = [("big", f"h{i:03d}", logs(3)) for i in range(300)] + [("small", f"s{i}", logs(3)) for i in range(25)] + [("tiny", f"t{i}", logs(3)) for i in range(4)]
    items += [("big", f"copy{i}", items[0][2]) for i in range(20)]
    return (
        spark.createDataFrame(users, f"user_id string, location_name string, user_logs {LOGS}"),
        spark.createDataFrame(items, f"location_name string, hotel_id string, item_logs {LOGS}"),
    )


def everything(users, items, k):
    pairs = users.join(items.withColumnRenamed("hotel_id", "target_hotel_id"), "location_name").drop("location_name")
    return pruned._best(bayes.score_pairs(pairs), k)


@pytest.mark.parametrize("size, k", [(8, 10), (32, 3), (1, 10)])
def test_pruned_lists_equal_the_full_expansion(parts, size, k):
    users, items = parts
    columns = ("user_id", "rank", "target_hotel_id", "pred_action", "prob", "important_value")
    assert rows(pruned.top_items(users, items, k, size), *columns) == rows(everything(users, items, k), *columns)


def test_bounds_hold_for_every_item_and_spare_most_of_them(parts):
    users, items = parts
    blocks = pruned.item_blocks(items, 8, max_rows=50)
    assert blocks.agg(F.sum("n")).first()[0] == items.count()
    met = users.join(blocks, "location_name").withColumn("bound", pruned.block_bound())
    opened = met.select("user_id", "user_logs", "block_id", "bound", F.explode("entries").alias("e"))
    scored = bayes.score_pairs(opened.select("user_id", "bound", "user_logs", F.col("e.item_logs").alias("item_logs")))
    assert scored.filter("important_value > bound").count() == 0
    loose = met.filter((F.col("location_name") == "big") & (F.col("bound") < 4.0)).count()
    assert loose > 0


def test_parts_of_a_score_add_up_to_it(spark):
    spec = scoring.ModelSpec(length=3)
    history = spark.createDataFrame(
        [(f"u{i}", i, ["h1", "h2"], ["s1", None], f"h{i % 4}", f"s{i % 2}", i % 6, "f", None) for i in range(24)],
        "user_id string, win bigint, sequence_hotel_ids array<string>, style_name_sequence array<string>, target_hotel_id string,"
        " target_style string, target int, gender string, age_group string",
    )
    model = bayes.fit(history, spec)
    whole = bayes.score(history, model, ["user_id", "win", "target_hotel_id"], "style_name_sequence")
    users = bayes.user_logs(history.drop("target_hotel_id", "target_style"), model, "style_name_sequence")
    items = bayes.item_logs(spark.createDataFrame([(f"h{i}", f"s{i % 2}") for i in range(4)], "hotel_id string, style_name string"), model)
    pairs = history.select("user_id", F.col("target_hotel_id").alias("hotel_id")).join(users, "user_id").join(items, "hotel_id")
    scored = bayes.score_pairs(pairs.select("user_id", F.col("hotel_id").alias("target_hotel_id"), "user_logs", "item_logs"))
    columns = ("user_id", "target_hotel_id", "pred_action", "prob")
    close = lambda df: [(*r[:3], round(r[3], 8)) for r in rows(df, *columns)]
    assert close(scored) == close(whole)


def brute_tree(seen, symbols):
    p = [1 / N_CLASSES] * N_CLASSES
    for d in range(len(symbols) + 1):
        n = [sum(1 for s, t in seen if s[:d] == symbols[:d] and len(s) >= d and t == c) for c in range(N_CLASSES)]
        kinds, total = sum(x > 0 for x in n), sum(n)
        if total:
            p = [(x + kinds * y) / (total + kinds) for x, y in zip(n, p)]
    return p


def test_context_tree_matches_brute_force(spark):
    rng = random.Random(2)
    seen = [([rng.choice("xy"), *rng.choices("0125", k=rng.randrange(4))], rng.randrange(N_CLASSES)) for _ in range(80)]
    counts = context_tree.class_counts(spark.createDataFrame(seen, "symbols array<string>, target int"), [])
    asked = [s for s, _ in seen[:20]] + [["z", "1"], ["x", "9", "9"], []]
    got = context_tree.probabilities(spark.createDataFrame([(a,) for a in asked], "symbols array<string>"), counts, [])
    found = {tuple(r.symbols): r.probabilities for r in got.collect()}
    assert set(found) == {tuple(a) for a in asked}
    for symbols, p in found.items():
        assert p == pytest.approx(brute_tree(seen, list(symbols)), abs=1e-12)
        assert sum(p) == pytest.approx(1)


def test_context_tree_heeds_the_order(spark):
    """The next action is the one before the last: positions alone, taken apart, don't tell."""
    rng = random.Random(3)
    data = []
    for _ in range(600):
        past = [rng.choice([1, 2]) for _ in range(4)]
        data.append((past, "s", past[-2] if past[-1] == 1 else 3 - past[-2]))
    frame = spark.createDataFrame(data, "past array<int>, style string, target int").withColumn("symbols", context_tree.context("style", "past"))
    counts = context_tree.class_counts(frame, [])
    scored = context_tree.score(frame.select("target", "symbols"), counts)
    assert scored.filter("pred_action = target").count() == 600


SEARCHED = "user_id string, event_timestamp timestamp_ntz, event_id bigint, hotel_id string, style_name string, main_action string"


@pytest.fixture(scope="module")
def searched(spark):
    rng = random.Random(4)
    names = ["view", "click", "fav"]
    data, n = [], 0
    for u in range(40):
        for k in range(rng.randrange(2, 40)):
            n += 1
            data.append((f"user_{u}", at(k // 2), n, f"h{rng.randrange(9)}", f"s{k % 2}", names[(k + u) % 3]))
    return spark.createDataFrame(data, SEARCHED)


def test_contexts_of_cut_users_equal_those_of_whole_ones(searched):
    coded = searched.withColumn("main_action", F.length("main_action").cast("int"))
    whole = tuning.action_contexts(coded, 5, max_rows=None)
    cut = tuning.action_contexts(coded, 5, max_rows=10)
    assert rows(whole) == rows(cut)
    one = sorted((r for r in whole.filter("user_id = 'user_3'").collect()), key=lambda r: r.place)
    codes = [r.target for r in one]
    assert [r.past for r in one] == [codes[max(0, i - 5) : i][::-1] for i in range(len(one))]


def test_halving_keeps_a_third_and_ends_with_one(searched):
    number = F.replace("user_id", F.lit("user_"), F.lit("")).cast("bigint")
    candidates = tuning.drawn_candidates(9)
    found = tuning.halving_search(searched, candidates, number).collect()
    by_round = {n: [r for r in found if r["round"] == n] for n in (1, 2)}
    assert len(found) == 12 and len(by_round[1]) == 9 and len(by_round[2]) == 3
    assert {r.cand for r in by_round[1] if r.survived} == {r.cand for r in by_round[2]}
    assert sum(r.survived for r in by_round[2]) == 1
    for group in by_round.values():
        ranked = sorted(group, key=lambda r: r["rank"])
        assert [(-r.accuracy, r.cand) for r in ranked] == sorted((-r.accuracy, r.cand) for r in ranked)
    assert max(r.n for r in by_round[2]) > 0


def test_candidates_are_different_and_within_the_ranges():
    drawn = tuning.drawn_candidates()
    assert len(set(drawn)) == 27
    assert {c.seq_len for c in drawn} <= set(tuning.LENGTHS) and {c.min_seen for c in drawn} == set(tuning.LEAST_SEEN)

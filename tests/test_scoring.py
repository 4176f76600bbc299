from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wanderbeam.operators import bayes, scoring, tuning


def history(spark, n=120):
    rng = random.Random(3)
    data = []
    for i in range(n):
        items = [f"h{rng.randrange(4)}" for _ in range(3)]
        target = f"h{rng.randrange(4)}"
        data.append((f"u{i}", items, ["s"] * 3, target, "s", 1 if target in ("h0", "h1") else 5, "m", "g"))
    return spark.createDataFrame(
        data,
        "user_id string, sequence_hotel_ids array<string>, style_name_sequence array<string>,"
        " target_hotel_id string, target_style string, target int, gender string, age_group string",
    )


def test_model_learns_what_the_item_tells(spark):
    spec = scoring.ModelSpec(length=4, width=128, max_iter=15, include_user_id=True)
    assert "user_id" in spec.feature_names() and "h3" in spec.feature_names()
    frame = history(spark)
    model = scoring.fit_next_action(frame, spec)
    predicted = scoring.predict_classes(frame, model, spec)
    assert scoring.quality(predicted)["accuracy"] > 0.95
    assert {r[0] for r in rows(scoring.class_distribution(predicted))} == {"view", "purchase"}
    scored = scoring.score_candidates(
        frame.withColumnRenamed("style_name_sequence", "style_sequence"), model, spec
    )
    right = scored.filter(F.col("pred_action") == F.col("target")).count()
    assert right == frame.count()
    assert scored.filter("abs(important_value - pred_action * prob) > 1e-12").count() == 0
    assert "features" not in scored.columns and "h1" not in scored.columns


def test_perceptron(spark):
    spec = scoring.ModelSpec(
        length=4, width=32, max_iter=30, hidden_units=(8,), include_hotel_features=False
    )
    model = scoring.fit_next_action(history(spark), spec)
    found = scoring.quality(scoring.predict_classes(history(spark), model, spec))
    assert found["accuracy"] > 0.5 and 0 < found["f1"] <= 1


def test_search_ranks_every_combination(spark):
    events = spark.createDataFrame(
        [(f"u{u}", f"h{(u + i) % 5}", "s", "view" if (u + i) % 2 else "purchase", i, u * 100 + i) for u in range(20) for i in range(12)],
        "user_id string, hotel_id string, style_name string, main_action string, event_timestamp int, event_id long",
    )
    users = spark.createDataFrame(
        [("u1", "m", 1.0, "l", "g")],
        "user_id string, gender string, age double, age_group_label string, age_group string",
    )
    found = tuning.param_search(
        events,
        users,
        [tuning.DataSpec(4, 2, 3), tuning.DataSpec(5, 5, 3)],
        [scoring.ModelSpec(width=64, max_iter=3), scoring.ModelSpec(width=64, max_iter=3, regularisation=0.3)],
    )
    assert rows(found, "rank") == [(1,), (2,), (3,), (4,)]
    best = [r["accuracy"] for r in found.orderBy("rank").collect()]
    assert best == sorted(best, reverse=True)
    assert tuning.top_results(found).count() == 3


def test_closed_form_model_learns_what_the_item_tells(spark):
    spec = scoring.ModelSpec(length=4, include_user_id=False)
    frame = history(spark).withColumn("win", F.lit(0))
    model = bayes.fit(frame, spec)
    predicted = bayes.predicted(frame, model, ["user_id", "win"])
    found = bayes.quality(predicted).first()
    assert found["n"] == 120 and found["accuracy"] > 0.9 and 0.9 < found["f1"] <= 1
    scored = bayes.score(frame, model, ["user_id", "win"], "style_name_sequence")
    assert scored.filter("abs(important_value - pred_action * prob) > 1e-12 or prob > 1").count() == 0


def test_closed_form_counts_by_hand(spark):
    data = [("u1", 0, ["a"], "a", 1), ("u2", 0, ["a"], "b", 1), ("u3", 0, ["b"], "b", 5)]
    frame = spark.createDataFrame(
        data, "user_id string, win int, sequence_hotel_ids array<string>, target_hotel_id string, target int"
    )
    spec = scoring.ModelSpec(length=2, include_user_features=False, include_hotel_features=False)
    model = bayes.fit(frame, spec)
    got = bayes.probabilities(frame.filter("user_id = 'u1'"), model, ["user_id", "win"]).first()["probabilities"]
    n, one, five = {1: 2, 5: 1}, (2 + 1) / (2 + 2) * (1 + 1) / (2 + 2), (0 + 1) / (1 + 2) * (0 + 1) / (1 + 2)
    raw = [(n.get(c, 0) + 1) / 9 * {1: one, 5: five}.get(c, 1 / 2 * 1 / 2) for c in range(6)]
    assert all(abs(p - r / sum(raw)) < 1e-6 for p, r in zip(got, raw))


def test_unseen_and_missing_values_say_nothing(spark):
    spec = scoring.ModelSpec(length=4)
    frame = history(spark).withColumn("win", F.lit(0))
    model = bayes.fit(frame, spec)
    odd = frame.limit(1).withColumn("target_hotel_id", F.lit("new")).withColumn("gender", F.lit(None).cast("string"))
    assert bayes.score(odd, model, ["user_id", "win"], "style_name_sequence").count() == 1
    assert bayes.quality(bayes.predicted(frame.limit(0), model, ["user_id", "win"]), ["label"]).count() == 0


def test_a_perceptron_that_the_driver_can_not_hold_is_refused(spark):
    spec = scoring.ModelSpec(hidden_units=(32,))
    with pytest.raises(ValueError, match="smaller width"):
        scoring.fit_next_action(history(spark), spec)

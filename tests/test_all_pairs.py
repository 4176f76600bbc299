"""Queries that return all pairs: the pairs are spread over tasks, cost little each and pack well, and stay the same."""

from __future__ import annotations

import glob
import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wanderbeam.functions.numbers import nearest
from wanderbeam.operators import bayes, recommend, scoring, skew
from wanderbeam.plans.catalogue import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def above_the_pairs(name: str, spark) -> str:
    """What is done to every pair of a query."""
    return plan(QUERIES[name](spark, SF_DIR)).split("Join", 1)[0]


def test_nearest_is_round(spark):
    rng = random.Random(5)
    values = [rng.uniform(-40, 40) for _ in range(20000)] + [rng.randrange(-(10**7), 10**7) / 2e6 for _ in range(5000)]
    values += [k * 5e-10 for k in range(-2000, 2000)] + [0.0, -0.0, 1e-12, -1e-12, 999.9999999995, 1000.5, -123456.7890123455, 1e17, 1e300, float("nan"), float("inf"), -float("inf"), None]
    found = spark.createDataFrame([(v,) for v in values], "v double")
    for places in (6, 9):
        for r in found.select("v", nearest(F.col("v"), places).alias("a"), F.round("v", places).alias("b")).collect():
            assert repr(r.a) == repr(r.b), r


def test_scored_pairs_are_compiled_and_the_same(spark):
    rng = random.Random(6)

    def logs():
        return [rng.choice([-1.25, -2.5, rng.uniform(-9, 0)]) for _ in range(scoring.N_CLASSES)]

    some = [(f"u{i}", f"h{i}", 7, logs(), logs()) for i in range(500)]
    some += [("equal", "h", 7, [-1.0] * 6, [-2.0] * 6), ("none", "h", 7, None, [-1.0] * 6), ("part", "h", 7, [None, *[-1.0] * 5], [-1.0] * 6)]
    pairs = spark.createDataFrame(some, "user_id string, target_hotel_id string, kept int, user_logs array<double>, item_logs array<double>")
    got = bayes.score_pairs(pairs)
    both = F.zip_with("user_logs", "item_logs", lambda a, b: a + b)
    want = scoring.with_importance(pairs, bayes.class_probabilities(both)).drop("user_logs", "item_logs")
    assert got.schema == want.schema and rows(got) == rows(want)
    assert "lambda" in plan(want) and "lambda" not in plan(got)


@pytest.fixture(scope="module")
def offered(spark):
    """1.4 million pairs of three locations, their users mixed in one partition."""
    rng = random.Random(7)
    owners = [(f"user_{i}", rng.choice("abc")) for i in range(1600)] + [("nowhere", "d"), ("none", None)]
    members = [("abc"[i % 3], f"hotel_{i}", 1, 0.5, rng.randrange(999) / 8) for i in range(2703)] + [(None, "hotel_x", 1, 0.5, 0.5), ("e", "hotel_y", 1, 0.5, 0.5)]
    return recommend.Offered(
        spark.createDataFrame(owners, "user_id string, location_name string").coalesce(1),
        spark.createDataFrame(members, "location_name string, target_hotel_id string, pred_action int, prob double, important_value double"),
    )


def test_many_pairs_of_a_small_table_are_spread_over_tasks(offered):
    pairs = offered.pairs()
    assert pairs.count() == 1600 * 901
    assert pairs.select(F.spark_partition_id().alias("p")).distinct().count() > 1


@pytest.mark.parametrize("ranked", [False, True])
def test_written_pairs_pack(offered, ranked, tmp_path):
    path = str(tmp_path / "written")
    found = recommend.rank_per_user(offered).select("user_id", "target_hotel_id", "rank") if ranked else offered.pairs()
    found.coalesce(1).write.parquet(path)
    size = sum(os.path.getsize(f) for f in glob.glob(f"{path}/*.parquet"))
    assert size < 1.05 * 1600 * 901


@pytest.mark.parametrize("block", [3, 1024])
def test_blocked_pairs_are_the_pairs(spark, block, monkeypatch):
    monkeypatch.setattr(skew, "PAIR_BLOCK", block)
    facts = [("hot" if i % 3 else f"k{i % 7}", i % 50, [i]) for i in range(300)] + [(None, 1, [1]), ("alone", 2, None), ("hot", None, [2])] * 2
    members = [("hot" if i % 2 else f"k{i % 9}", i, {"a": i}) for i in range(90)] + [(None, 1, {}), ("hot", 5, None), ("hot", 5, None), ("other", 3, {})]
    left = spark.createDataFrame(facts, "k string, f int, x array<int>")
    right = spark.createDataFrame(members, "k string, m int, y map<string,int>")
    want = left.join(right, "k")
    for order in (None, [], ["m"]):
        got = skew.expanding_join(left, right, "k", "f", task_pairs=100, order=order)
        assert got.columns == want.columns and rows(got) == rows(want)
    none = skew.expanding_join(left, right.filter("k = 'other'"), "k", "f", task_pairs=0)
    assert none.count() == 0


@pytest.mark.parametrize(
    ("name", "work"),
    [("candidates", "array_join"), ("score_empirical", "round("), ("union_missing_cols", "round("), ("ml_score", "lambda")],
)
def test_what_depends_on_one_side_is_not_worked_out_for_pairs(spark, name, work):
    assert work not in above_the_pairs(name, spark)


def test_no_context_is_looked_up_for_a_pair(spark):
    assert "concat_ws" not in plan(QUERIES["ml_score_ordered"](spark, SF_DIR))

"""The ways around heavy keys must give what the plain ways give."""

from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wanderbeam.operators import ids, sequences, skew


@pytest.fixture(scope="module")
def lopsided(spark):
    """One key with a third of all rows, NULL values, runs of equal values."""
    rng = random.Random(7)
    data = []
    for i in range(600):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(40)}"
        value = rng.choice(["a", "a", "b", "c", None])
        data.append((key, rng.randrange(200), i, value))
    return spark.createDataFrame(data, "user_id string, t int, event_id long, v string").cache()


ORDER = ["t", "event_id"]


def test_number_rows(lopsided):
    plain = skew.number_rows(lopsided, ["user_id"], ORDER, "p", "n", max_rows=None)
    split = skew.number_rows(lopsided, ["user_id"], ORDER, "p", "n", max_rows=12)
    assert skew.split_heavy_groups(lopsided, ["user_id"], ORDER, 12).heavy is not None
    assert rows(split, "event_id", "p", "n") == rows(plain, "event_id", "p", "n")


def test_number_runs(lopsided):
    plain = skew.number_runs(lopsided, ["user_id"], ORDER, "v", "run", max_rows=None)
    for limit in (1, 5, 12, 50):
        split = skew.number_runs(lopsided, ["user_id"], ORDER, "v", "run", max_rows=limit)
        assert rows(split, "event_id", "run") == rows(plain, "event_id", "run")


@pytest.mark.parametrize("offset", [1, -1])
def test_with_neighbour(lopsided, offset):
    plain = skew.with_neighbour(lopsided, ["user_id"], ORDER, "v", "o", offset, max_rows=None)
    split = skew.with_neighbour(lopsided, ["user_id"], ORDER, "v", "o", offset, max_rows=12)
    assert rows(split, "event_id", "o") == rows(plain, "event_id", "o")


@pytest.mark.parametrize(("length", "step"), [(6, 5), (4, 1), (3, 3), (2, 5)])
def test_sliding_windows(lopsided, length, step):
    plain = sequences.sliding_windows(lopsided, ["v"], length, step, ORDER, max_rows=None)
    split = sequences.sliding_windows(lopsided, ["v"], length, step, ORDER, max_rows=12)
    assert plain.count() > 40
    assert rows(split, "user_id", "win", "v_sequence") == rows(plain, "user_id", "win", "v_sequence")


def test_training_sequences_of_heavy_users(lopsided):
    events = lopsided.select(
        "user_id",
        F.col("v").alias("hotel_id"),
        F.lit("view").alias("main_action"),
        F.col("t").alias("event_timestamp"),
        "event_id",
    )
    users = lopsided.select("user_id").distinct().filter("user_id < 'k3'").withColumns(
        {c: F.lit("x") for c in ("gender", "age", "age_group_label", "age_group")}
    )

    def build(limit):
        return sequences.training_sequences(
            events, users, 4, 2, 2, ("hotel_id", "main_action"), max_rows=limit
        )

    assert rows(build(12)) == rows(build(None))


def test_small_enough_measures_rows_and_bytes(spark):
    frame = spark.createDataFrame([("x" * 1000, ["y" * 500])] * 10, "a string, b array<string>")
    assert skew.small_enough(frame, 10, 20_000)
    assert not skew.small_enough(frame, 9, 20_000)
    assert not skew.small_enough(frame, 10, 14_000)
    assert skew.small_enough(frame.filter("false"), 0, 0)


def test_heavy_group_segments_are_bounded(lopsided):
    groups = skew.split_heavy_groups(lopsided, ["user_id"], ORDER, 25)
    sizes = groups.heavy.groupBy("user_id", skew.SEGMENT).count().agg(F.max("count")).first()[0]
    assert sizes <= 2 * 25
    assert groups.light.count() + groups.heavy.count() == lopsided.count()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_ways_agree(spark, lopsided, how):
    dim = lopsided.select("user_id").distinct().filter("user_id <> 'k1'").withColumn("x", F.length("user_id"))
    facts = lopsided.withColumn("user_id", F.when(F.col("t") != 3, F.col("user_id")))
    small = skew.lookup_join(facts, dim, "user_id", how)
    beyond = skew.lookup_join(facts, dim, "user_id", how, broadcast_rows=0, salts=3)
    plain = facts.join(dim, "user_id", how)
    assert skew.heavy_keys(facts, "user_id", 0.1) == ["hot"]
    assert rows(beyond) == rows(small) == rows(plain)


def test_a_chain_of_lookups_reads_the_facts_once(spark, lopsided, tmp_path):
    lopsided.write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    dim = spark.range(50)
    chained = facts
    for name in ("event_id", "t", "user_id"):
        side = dim.select(F.col("id").cast(dict(facts.dtypes)[name]).alias(name), F.lit(1).alias(f"x_{name}"))
        chained = skew.lookup_join(chained, side, name, "left", broadcast_rows=0)
    plan = chained._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_facts_without_a_key_are_spread(spark):
    facts = spark.range(3000).select("id", F.lit(None).cast("string").alias("k"))
    dim = spark.createDataFrame([("a", 1)], "k string, x int")
    joined = skew.lookup_join(facts, dim, "k", "left", broadcast_rows=0)
    assert joined.count() == 3000 and joined.columns == ["k", "id", "x"]
    salted = facts.withColumn("s", F.pmod(F.xxhash64("id", "k"), F.lit(skew.NULL_SALTS)))
    assert salted.select("s").distinct().count() > 200


def test_small_enough_reads_a_bounded_part(spark):
    assert skew.small_enough(spark.range(10), 10) and not skew.small_enough(spark.range(11), 10)
    assert not skew.small_enough(spark.range(10), 10, size=20)


def test_expanding_join_ways_agree(lopsided):
    members = lopsided.select("user_id", F.col("event_id").alias("m")).filter("m < 60")
    small = skew.expanding_join(lopsided, members, "user_id", "event_id")
    salted = skew.expanding_join(
        lopsided, members, "user_id", "event_id", salts=5, broadcast_rows=0, heavy_share=0.1
    )
    unsalted = skew.expanding_join(
        lopsided, members, "user_id", "event_id", broadcast_rows=0, heavy_share=0.9
    )
    assert rows(salted) == rows(unsalted) == rows(small)


def test_dense_ids_match_a_global_row_number(spark, lopsided):
    numbered = ids.dense_ids(lopsided, ["t", "event_id"], "id", start=100, partitions=6)
    got = [r["event_id"] for r in numbered.orderBy("id").collect()]
    want = [r["event_id"] for r in lopsided.orderBy("t", "event_id").collect()]
    assert got == want
    low, high, n = numbered.agg(F.min("id"), F.max("id"), F.count_distinct("id")).first()
    assert (low, high, n) == (101, 700, 600)
    assert numbered.schema["id"].dataType.simpleString() == "bigint"


def test_dense_ids_of_nothing(spark, lopsided):
    assert ids.dense_ids(lopsided.filter("false"), ["t", "event_id"], "id").count() == 0


def test_null_keys_are_cut_like_any_other(spark):
    data = [(None if i % 4 else "k", i // 2, i, "abc"[i % 3]) for i in range(60)]
    frame = spark.createDataFrame(data, "user_id string, t int, event_id long, v string")
    for build in (
        lambda limit: skew.number_rows(frame, ["user_id"], ORDER, "p", "n", limit),
        lambda limit: skew.number_runs(frame, ["user_id"], ORDER, "v", "run", limit),
        lambda limit: skew.with_neighbour(frame, ["user_id"], ORDER, "v", "o", 1, limit),
    ):
        assert rows(build(10)) == rows(build(None))
    assert skew.split_heavy_groups(frame, ["user_id"], ORDER, 20).heavy.filter("user_id IS NULL").count() == 45


def test_windows_settle_ties_alike_below_and_above_the_limit(spark):
    frame = spark.createDataFrame([("u", i // 5, "edcba"[i % 5]) for i in range(40)], "user_id string, t int, v string")
    build = lambda limit: sequences.sliding_windows(frame, ["v"], 4, 2, ["t"], max_rows=limit)
    assert rows(build(10)) == rows(build(None))

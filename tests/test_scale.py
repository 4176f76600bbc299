"""What must not grow as the square of the tables or go through the driver, and that the results stay the same."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wanderbeam.operators import bayes, evaluate, pruned, recommend, skew
from wanderbeam.plans.domain import Domain
from wanderbeam.sources import documents


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def sides(spark, tmp_path_factory):
    """Frames read from files, whose sizes Spark guesses to be small."""
    path = str(tmp_path_factory.mktemp("sides"))
    facts = spark.createDataFrame([("hot" if i % 3 else f"k{i % 7}", i) for i in range(300)], "k string, f long")
    members = spark.createDataFrame([("hot" if i % 2 else f"k{i % 9}", i) for i in range(90)], "k string, m long")
    facts.write.parquet(f"{path}/facts")
    members.write.parquet(f"{path}/members")
    return spark.read.parquet(f"{path}/facts"), spark.read.parquet(f"{path}/members")


def test_members_that_are_not_small_are_never_broadcast(sides):
    facts, members = sides
    for share in (0.1, 0.9):
        joined = skew.expanding_join(facts, members, "k", "f", broadcast_rows=0, heavy_share=share)
        assert "SortMergeJoin" in plan(joined) and "Broadcast" not in plan(joined)
        assert rows(joined) == rows(facts.join(members, "k"))


def test_a_dimension_that_is_not_small_is_never_broadcast(sides):
    facts, members = sides
    dim = members.groupBy("k").agg(F.max("m").alias("m"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        joined = skew.lookup_join(facts, dim, "k", how, broadcast_rows=0)
        assert "Broadcast" not in plan(joined)
        assert rows(joined) == rows(facts.join(dim, "k", how))


def test_a_key_is_spread_by_its_share(spark):
    spread = spark.range(1000).select(F.concat(F.lit("k"), F.col("id") % 10).alias("k"), "id")
    assert skew._heavy_shares(spread, "k", 0.05) == {f"k{i}": 0.1 for i in range(10)}
    members = spread.withColumnRenamed("id", "m").filter("m < 100")
    joined = skew.expanding_join(spread, members, "k", "id", broadcast_rows=0)
    assert joined.count() == 1000 * 10


@pytest.fixture(scope="module")
def offered(spark):
    owners = spark.createDataFrame(
        [("u1", "a"), ("u2", "a"), ("u2", "b"), (None, "b"), ("u3", "b"), ("u4", "nowhere"), ("u5", None), ("u6", "a"), ("u6", "a")],
        "user_id string, location_name string",
    )
    members = spark.createDataFrame(
        [("a" if i % 3 else "b", f"hotel_{i}", [1, 2, 5, 0, None][i % 5], [0.5, 0.25, 0.75][i % 3], [0.5, 2.0, None, 0.0][i % 4]) for i in range(20)]
        + [("a", "hotel_1", 2, 0.25, 2.0), (None, "hotel_90", 1, 0.5, 1.0), ("b", "hotel_91", 1, None, float("nan"))],
        "location_name string, target_hotel_id string, pred_action int, prob double, important_value double",
    )
    return recommend.Offered(owners, members)


def test_offered_rows_give_what_their_pairs_give(offered):
    pairs = offered.pairs()
    keep = ("user_id", "target_hotel_id", "rank")
    assert rows(recommend.rank_per_user(offered), *keep) == rows(recommend.rank_per_user(pairs), *keep)
    assert rows(recommend.rank_per_user(offered, 3), *keep) == rows(recommend.rank_per_user(pairs, 3), *keep)
    assert recommend.rank_per_user(offered).schema["rank"].dataType == recommend.rank_per_user(pairs).schema["rank"].dataType
    named, spelled = recommend.decoded_predictions(offered), recommend.decoded_predictions(pairs)
    assert isinstance(named, recommend.Offered)
    assert rows(recommend.playlist_from_probs(named, 4)) == rows(recommend.playlist_from_probs(spelled, 4))
    assert rows(evaluate.action_counts(named)) == rows(evaluate.action_counts(spelled))
    assert rows(evaluate.segment_users(named)) == rows(evaluate.segment_users(spelled))
    want = spelled.groupBy("user_id", "main_action").agg(F.count(F.lit(1)).alias("n"))
    got = named.per_user("main_action").groupBy("user_id", "main_action").agg(F.sum("n").alias("n"))
    assert rows(got) == rows(want)


def test_users_of_one_row_are_ranked_without_a_window_of_their_own(offered):
    once = recommend.Offered(offered.owners.filter("user_id IN ('u1', 'u3')"), offered.members)
    windows = [line for line in plan(recommend.rank_per_user(once)).splitlines() if "Window" in line]
    assert windows and not any("user_id" in line for line in windows)


def test_items_that_score_alike_are_cut_to_the_best(spark):
    items = spark.createDataFrame(
        [("a", f"h{i:03d}", [-1.0 - i % 4, -2.0, -1.5, -3.0, -2.5, -1.0 - (i % 2)]) for i in range(200)],
        "location_name string, hotel_id string, item_logs array<double>",
    )
    users = spark.createDataFrame(
        [(f"u{j}", "a", [-0.1 * j, -0.2, -0.3 * (j % 3), -1.0, -0.7, -0.5]) for j in range(6)],
        "user_id string, location_name string, user_logs array<double>",
    )
    assert pruned.best_alike(items, 5).groupBy("item_logs").count().agg(F.max("count")).first()[0] == 5
    assert pruned.item_blocks(pruned.best_alike(items, 5), 4).agg(F.sum("n")).first()[0] == 20
    pairs = users.join(items.withColumnRenamed("hotel_id", "target_hotel_id"), "location_name")
    scored = bayes.score_pairs(pairs.select("user_id", "target_hotel_id", "user_logs", "item_logs"))
    keep = ("user_id", "rank", "target_hotel_id", "pred_action", "prob")
    assert rows(pruned.top_items(users, items, 5, 4), *keep) == rows(pruned._best(scored, 5), *keep)


class Unstored(Domain):
    def _stored(self, name, build, partition=None):
        return build()


def test_bookings_are_read_and_made_once(spark):
    text = plan(Unstored(spark, "/root/testdata/sf0.001").booking_documents())
    assert text.count("FileScan") == 2
    lines = text.splitlines()
    laid = next(i for i, line in enumerate(lines) if "rangepartitioning" in line)
    made = [i for i, line in enumerate(lines) if "to_json" in line.lower() or "StructsToJson" in line]
    assert made and max(made) < laid


def test_bookings_keep_their_rows(spark, tmp_path):
    orders = [(i, i % 3 if i else None, "FOP"[i % 3], f"1996-01-0{1 + i % 9} 00:00:00") for i in range(0, 200)] + [(None, 1, "F", None)]
    orders = spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate string")
    orders.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(i // 2, i % 5 if i % 7 else None, 1, 2.0, 3.5 if i % 6 else None, 0.1, 0.2, "R", "O") for i in range(400)]
    lines += [(97, 1, 1, 2.0, 3.5, 0.1, 0.2, "R", "O")] * 2
    names = "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    spark.createDataFrame(lines, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    domain = Unstored(spark, str(tmp_path))
    made = domain.build_bookings()
    request = F.when(F.col("booking_id") % 2 == 0, "none").otherwise(F.col("request"))
    cut = made.filter("booking_id % 97 = 0").withColumns({"details": F.substring("details", 1, 20), "request": request})
    want = documents.parsed(made.unionByName(cut), ("customer_info", "request", "details"))
    texts = ["booking_id", *[F.col(c).cast("string").alias(c) for c in ("customer_info", "request", "details")], "status", "updated_at", "reason", "broken", "original"]
    got = domain.booking_documents()
    assert got.schema == want.schema and cut.count() > 4
    assert rows(got.select(*texts)) == rows(want.select(*texts))


def test_a_document_is_parsed_once(spark):
    frame = spark.createDataFrame([(1, "{}", "[1"), (2, None, "1")], "id long, a string, b string")
    frame = frame.repartition(2)
    text = plan(documents.parsed(frame, ("a", "b")))
    assert text.count("parseJson(") == 2


def test_predictions_are_stored_as_users_and_items(spark):
    domain = Domain(spark, "/root/testdata/sf0.001")
    parts = domain.prediction_parts()
    assert "target_hotel_id" not in parts.owners.columns and "user_id" not in parts.members.columns
    assert rows(parts.pairs(), "user_id", "target_hotel_id") == rows(domain.build_predictions(), "user_id", "target_hotel_id")


def test_a_small_file_of_events_is_dealt_to_all_tasks(spark, tmp_path):
    events = spark.range(300).selectExpr(
        "id AS event_id",
        "timestamp_seconds(1704067200 + id) AS ts",
        "id % 7 AS user_id",
        "element_at(array('view', 'click', 'purchase', NULL), cast(id % 4 + 1 AS int)) AS event_type",
        "if(id % 5 = 0, NULL, cast(id % 50 AS double)) AS value",
        "if(id % 3 = 0, NULL, '{\"k\": 4}') AS props",
    )
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    domain = Domain(spark, str(tmp_path))
    loaded = documents.whole(domain.event_documents())
    assert loaded.count() == 300 + sum(i % 89 == 0 and i % 3 == 0 for i in range(300))
    assert sum("broken=false" in f for f in loaded.inputFiles()) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = {(r[0], tuple(r[1])) for r in domain.raw_events().select("event_name", "event_params.key").collect()}
    always = ("hotel_name", "content_group", "first_touch_source")
    assert keys == {
        ("view", ("hotel_id", *always)),
        ("click", ("hotel_id", *always, "carousel_id", "carousel_name")),
        ("purchase", ("hotel_id", *always, "booking_id")),
        ("purchase", (*always, "booking_id")),
        (None, always),
        (None, ("hotel_id", *always)),
    }


def test_booked_items_are_stored_before_they_are_measured(spark):
    domain = Domain(spark, "/root/testdata/sf0.001")
    assert "lineitem" not in plan(domain.booked_items()) and "Aggregate" not in plan(domain.booked_items())

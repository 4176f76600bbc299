from __future__ import annotations

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from wanderbeam.operators import recommend, scoring, serving


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(
        [(i, f"hotel_{i}", "loc_a" if i < 5 else "loc_b", f"s{i}") for i in range(8)],
        "hotel_code long, hotel_id string, location_name string, style_name string",
    )


@pytest.fixture(scope="module")
def eligible(spark):
    return spark.createDataFrame(
        [("u1", ["hotel_7", "hotel_1"], [1, 2]), ("u2", ["hotel_0", "hotel_6"], [1, 5]), ("u3", ["x"], [1])],
        "user_id string, hotel_id_sequence array<string>, main_action_sequence array<int>",
    )


def test_candidates_are_the_anchor_locations_trained_items(items, eligible):
    trained = items.filter("hotel_code <> 4").select("hotel_id")
    got = recommend.candidates(eligible, items, trained, length=2, item_columns=("style_name",))
    assert rows(got, "user_id", "target_hotel_id", "style_name") == [
        *[("u1", f"hotel_{i}", f"s{i}") for i in range(4)],
        *[("u2", f"hotel_{i}", f"s{i}") for i in (5, 6, 7)],
    ]
    assert rows(got.select("hotel_id_sequence").distinct()) == [(["hotel_0"],), (["hotel_7"],)]
    spread = recommend.candidates(eligible, items, trained, 2, ("style_name",), broadcast_rows=0)
    assert rows(spread) == rows(got)


def test_empirical_scores(spark):
    actions = [("h1", a) for a in ("view", "view", "purchase", "purchase", "click")]
    actions += [("h2", "unfav"), ("h3", "fav"), ("h3", "unknown")]
    events = spark.createDataFrame(actions, "hotel_id string, main_action string")
    # Equal shares go to the lower class; class 0 is never important.
    assert rows(scoring.empirical_scores(events)) == [
        ("h1", 1, 0.4, 0.4),
        ("h2", 0, 1.0, 0.0),
        ("h3", 3, 1.0, 3.0),
    ]


def bookings(spark, *booked):
    data = [(f'{{"customerId": "{u}"}}', f'{{"hotelId": "{h}"}}', t) for u, h, t in booked]
    return spark.createDataFrame(data, "customer_info string, request string, updated_at timestamp_ntz")


def test_trending_counts_users_in_the_window_and_skips_unknown_items(spark, items):
    booked = bookings(
        spark,
        ("a", 1, at(0)),
        ("a", 1, at(5)),
        ("b", 2, at(0)),
        ("c", 2, at(1)),
        ("a", 3, at(0)),
        *[(u, 999, at(0)) for u in "abcd"],
        *[(u, 4, at(60 * 24 * 9)) for u in "abcd"],
    )
    top = recommend.trending(booked, items, "2024-01-03")
    assert rows(top, "rank", "hotel_id", "n_users") == [(1, "hotel_2", 2), (2, "hotel_1", 1), (3, "hotel_3", 1)]
    predictions = spark.createDataFrame(
        [("u1", "hotel_5", 1, 0.5, 0.5)],
        "user_id string, target_hotel_id string, pred_action int, prob double, important_value double",
    )
    both = recommend.with_default_user(predictions, top)
    assert rows(both.filter("user_id = 'default'")) == [
        ("default", "hotel_1", None, None, 9.0),
        ("default", "hotel_2", None, None, 10.0),
        ("default", "hotel_3", None, None, 8.0),
    ]
    assert both.columns == predictions.columns


def predictions(spark):
    return spark.createDataFrame(
        [("user_1", f"hotel_{i}", v, v) for i, v in enumerate((0.1, 0.9, 0.9, 0.5, 0.7))]
        + [("default", "hotel_6", 9.0, None), ("default", "hotel_5", 10.0, None), ("user_9", "hotel_1", 1.0, 1.0)],
        "user_id string, target_hotel_id string, important_value double, prob double",
    )


def users(spark):
    return spark.createDataFrame([(11, "user_1")], "raw_user_id long, user_id string")


def test_playlist_order_ties_default_and_display(spark, items):
    lists = recommend.playlist(predictions(spark), users(spark), items, 3)
    assert rows(lists) == [("11", ["1", "2", "4"]), ("default", ["5", "6"])]
    shown = items.filter("hotel_code <> 2").select("hotel_id")
    lists = recommend.playlist(predictions(spark), users(spark), items, 3, shown)
    assert rows(lists)[0] == ("11", ["1", "4", "3"])


def test_best_of_location_is_enough_for_a_top_k(spark, items, eligible):
    scored = items.withColumn("important_value", (F.col("hotel_code") * 7 % 5).cast("double"))
    full = recommend.candidates(eligible, scored, items, 2, ("important_value",))
    short = recommend.candidates(
        eligible, items, items, 2, ("important_value",), recommend.best_of_location(scored, 2)
    )
    keep = ("user_id", "target_hotel_id", "rank")
    assert rows(recommend.rank_per_user(short, 2), *keep) == rows(recommend.rank_per_user(full, 2), *keep)


def test_playlist_from_probs(spark):
    rated = predictions(spark).withColumnRenamed("target_hotel_id", "hotel_id").filter("prob IS NOT NULL")
    assert rows(recommend.playlist_from_probs(rated, 2)) == [
        ("user_1", ["hotel_1", "hotel_2"]),
        ("user_9", ["hotel_1"]),
    ]


def test_predictable_pairs(spark):
    pairs = spark.createDataFrame([("a", "h1"), ("a", "h9"), ("z", "h1")], "user_id string, target_hotel_id string")
    training = spark.createDataFrame([("a", "h2"), ("b", "h1")], "user_id string, hotel_id string")
    assert rows(recommend.predictable_pairs(pairs, training)) == [("a", "h1")]


# --- serving --------------------------------------------------------------


@pytest.fixture(scope="module")
def profile(spark):
    texts = "a1", "a2", "a3", "zip", " Loc ", "Name", "City", "Land"
    thai = tuple(t.upper() for t in texts)
    base = ("l", "c", "f", "img", 4)
    return spark.createDataFrame(
        [(1, "en", *texts, *base), (1, "th", *thai, *base), (2, "en", *texts, *base), (3, "fr", *texts, *base)],
        "hotel_code long, language string, address1 string, address2 string, address3 string,"
        " zipcode string, location_name string, hotel_name string, city_name string,"
        " country_name string, location_code string, city_code string, country_code string,"
        " image_url string, rating int",
    )


def test_bilingual_profile(profile):
    got = serving.bilingual_profile(profile)
    assert rows(got, "hotel_code", "en_address", "th_hotel_name", "en_location_name") == [
        (1, "a1 a2 a3 zip", "NAME", "Loc"),
        (2, "a1 a2 a3 zip", None, "Loc"),
        (3, None, None, None),
    ]


def test_serve(spark, profile):
    lists = spark.createDataFrame(
        [("11", ["2", "1", "77"]), ("default", ["1"])], "user_id string, sv_playlist array<string>"
    )
    requests = spark.createDataFrame([("11",), ("11",), ("unknown",)], "user_id string")
    served = serving.serve(requests, lists, serving.bilingual_profile(profile), k=3)
    answers = sorted(served.collect(), key=lambda r: r["user_id"])
    assert [r["user_id"] for r in answers] == ["11", "11", "unknown"]
    assert [i["hotelId"] for i in answers[0]["recommended_items"]] == ["2", "1", "77"]
    assert [i["hotelId"] for i in answers[2]["recommended_items"]] == ["1"]
    bare = answers[0]["recommended_items"][2].asDict(recursive=True)
    assert bare["rating"] == 0 and bare["image"] == "" and bare["address"]["cityId"] == ""
    assert bare["review"] == {"score": 5.0, "numReview": 100, "description": ""}
    known = answers[0]["recommended_items"][1].asDict(recursive=True)
    assert known["hotelNameTh"] == "NAME" and known["rating"] == 4.0
    assert known["capsulePromotion"] == []
    named = serving.serve(requests, lists, serving.bilingual_profile(profile), promotions={"deals": "none_here"})
    assert named.first()["recommended_items"][0]["deals"] == []
    assert len(known["address"]) == 11
    capped = serving.serve(requests, lists, serving.bilingual_profile(profile), k=1)
    assert capped.agg(F.max(F.size("recommended_items"))).first()[0] == 1


def test_serve_without_a_default_gives_an_empty_list(spark, profile):
    lists = spark.createDataFrame([("11", ["1"])], "user_id string, sv_playlist array<string>")
    requests = spark.createDataFrame([("unknown",)], "user_id string")
    served = serving.serve(requests, lists, serving.bilingual_profile(profile))
    assert served.first()["recommended_items"] == []
    fallback = serving.playlists_for(requests, lists)
    assert fallback.first()["sv_playlist"] is None


def test_optional_profile_columns(spark, profile):
    rich = serving.bilingual_profile(profile).withColumns(
        {"review_score": F.lit(3.5), "capsule_promotion": F.array(F.lit("x"))}
    )
    item = serving.item_responses(rich).filter("hotel_code = 1").first()["item"]
    assert item["review"]["score"] == 3.5 and item["capsulePromotion"] == ["x"]

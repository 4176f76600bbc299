"""Serving tables and batch lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wanderbeam.functions.text import full_address
from wanderbeam.operators.recommend import DEFAULT_USER, only_displayed, rank_per_user
from wanderbeam.operators.skew import lookup_join
from wanderbeam.session import materialise

LANGUAGES = ("en", "th")
CODES = ("hotel_code", "location_code", "city_code", "country_code", "image_url", "rating")


def bilingual_profile(profile: DataFrame, languages: Sequence[str] = LANGUAGES) -> DataFrame:
    """One row per item with one column per language and text attribute.

    Items without a row in a listed language keep NULLs there.
    """
    texts = profile.select(
        *CODES,
        "language",
        full_address(*[F.col(c) for c in ("address1", "address2", "address3", "zipcode")]).alias(
            "address"
        ),
        *[F.trim(c).alias(c) for c in ("location_name", "hotel_name", "city_name", "country_name")],
    )
    columns = []
    for language in languages:
        here = F.col("language") == language
        for name in ("address", "location_name", "hotel_name", "city_name", "country_name"):
            columns.append(F.max(F.when(here, F.col(name))).alias(f"{language}_{name}"))
    return texts.groupBy(*CODES).agg(*columns)


def serving_profile(
    predictions: DataFrame, items: DataFrame, profile: DataFrame, displayed: DataFrame | None = None, k: int = 10
) -> DataFrame:
    """Profiles of the displayed items that are in anybody's top ``k``.

    The ranked rows are reduced to distinct items before the profile is looked up. Without ``displayed`` the
    predictions are taken to be of displayed items only.
    """
    top = rank_per_user(predictions if displayed is None else only_displayed(predictions, displayed), k)
    wanted = top.select(F.col("target_hotel_id").alias("hotel_id")).distinct()
    codes = items.join(wanted, "hotel_id", "left_semi").select("hotel_code")
    return bilingual_profile(profile.join(codes, "hotel_code", "left_semi"))


def _text(name: str) -> Column:
    return F.coalesce(F.col(f"p.{name}"), F.lit(""))


def _optional(profile: DataFrame, name: str, default: Column, kind: str) -> Column:
    """A profile column that may not exist (reviews and promotions are optional)."""
    if name in profile.columns:
        return F.coalesce(F.col(f"p.{name}").cast(kind), default)
    return default


# The response field of each optional list of promotions, and its profile column.
PROMOTIONS = {"capsulePromotion": "capsule_promotion"}


def item_responses(profile: DataFrame, promotions: Mapping[str, str] = PROMOTIONS) -> DataFrame:
    """(hotel_code, item): the nested response of one item with defaults for what is missing.

    The names of the response fields are fixed values. ``promotions`` names the fields with lists of promotions.
    """
    none = F.array().cast("array<string>")
    empty = F.lit("")
    address = F.struct(
        _text("en_address").alias("addressEn"),
        _text("th_address").alias("addressTh"),
        _text("location_code").alias("locationId"),
        _text("en_location_name").alias("locationNameEn"),
        _text("th_location_name").alias("locationNameTh"),
        _text("city_code").alias("cityId"),
        _text("en_city_name").alias("cityNameEn"),
        _text("th_city_name").alias("cityNameTh"),
        _text("country_code").alias("countryId"),
        _text("en_country_name").alias("countryNameEn"),
        _text("th_country_name").alias("countryNameTh"),
    )
    review = F.struct(
        _optional(profile, "review_score", F.lit(5.0), "double").alias("score"),
        _optional(profile, "review_count", F.lit(100), "int").alias("numReview"),
        _optional(profile, "review_description", empty, "string").alias("description"),
    )
    lines = [
        _optional(profile, f"admin_promotion_line{n}_{lang}", empty, "string").alias(
            f"adminPromotionLine{n}{lang.capitalize()}"
        )
        for lang in ("th", "en")
        for n in (1, 2)
    ]
    return profile.alias("p").select(
        "p.hotel_code",
        F.struct(
            F.col("p.hotel_code").cast("string").alias("hotelId"),
            _text("th_hotel_name").alias("hotelNameTh"),
            _text("en_hotel_name").alias("hotelNameEn"),
            address.alias("address"),
            F.coalesce(F.col("p.rating").cast("double"), F.lit(0.0)).alias("rating"),
            review.alias("review"),
            *lines,
            *[_optional(profile, c, none, "array<string>").alias(f) for f, c in promotions.items()],
            _text("image_url").alias("image"),
        ).alias("item"),
    )


def with_fallback(found: DataFrame, lists: DataFrame, column: str) -> DataFrame:
    """Fill a missing ``column`` with the default user's value.

    That is one row, so its broadcast has a fixed bound.
    """
    fallback = lists.filter(F.col("user_id") == DEFAULT_USER).limit(1).select(
        F.col("user_id").alias("__owner"), F.col(column).alias("__default")
    )
    return (
        found.withColumn("__owner", F.when(F.col(column).isNull(), F.lit(DEFAULT_USER)))
        .join(F.broadcast(fallback), "__owner", "left")
        .withColumn(column, F.coalesce(column, "__default"))
        .drop("__owner", "__default")
    )


def playlists_for(requests: DataFrame, playlists: DataFrame) -> DataFrame:
    """Every request with its own list, or the default one for an unknown user."""
    return with_fallback(
        lookup_join(requests, playlists, "user_id", "left"), playlists, "sv_playlist"
    )


def serve(
    requests: DataFrame,
    playlists: DataFrame,
    profile: DataFrame,
    k: int = 10,
    promotions: Mapping[str, str] = PROMOTIONS,
) -> DataFrame:
    """(user_id, recommended_items): at most ``k`` nested items in list order.

    Lists of users who are not asked for leave before anything is put together. Responses are put together once per distinct list owner (a user with a list, or the
    default), not once per request; the profile lookup then meets each list once and a burst of
    requests for one user only repeats the finished response.
    """
    default = requests.sparkSession.createDataFrame([(DEFAULT_USER,)], "user_id string")
    asked = requests.select("user_id").union(default).distinct()
    wanted = lookup_join(playlists, asked, "user_id", "left_semi")
    short = wanted.select("user_id", F.slice("sv_playlist", 1, k).alias("codes"))
    entries = short.select("user_id", F.posexplode("codes").alias("pos", "code")).withColumn(
        "hotel_code", F.col("code").try_cast("bigint")
    )
    answers = lookup_join(entries, item_responses(profile, promotions), "hotel_code", "left")
    bare = item_without_profile(profile, F.col("code"), promotions)
    filled = answers.withColumn("item", F.coalesce("item", bare))
    lists = (
        filled.groupBy("user_id")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "item"))).alias("e"))
        .select("user_id", F.col("e.item").alias("recommended_items"))
    )
    # Read three times below (size check, lookup, default), so computed once.
    lists = materialise(lists, "responses")
    nothing = F.array().cast(lists.schema["recommended_items"].dataType)
    known = lookup_join(requests, lists, "user_id", "left")
    return with_fallback(known, lists, "recommended_items").withColumn(
        "recommended_items", F.coalesce("recommended_items", nothing)
    )


def item_without_profile(
    profile: DataFrame, code: Column, promotions: Mapping[str, str] = PROMOTIONS
) -> Column:
    """The response of an item the profile does not know: its code and the defaults."""
    shape = item_responses(profile, promotions).schema["item"].dataType
    defaults = {"rating": F.lit(0.0), "hotelId": code.cast("string")}
    defaults["review"] = F.struct(
        F.lit(5.0).alias("score"), F.lit(100).alias("numReview"), F.lit("").alias("description")
    )
    fields = []
    for field in shape.fields:
        if field.name in defaults:
            value = defaults[field.name]
        elif field.name == "address":
            value = F.struct(*[F.lit("").alias(f.name) for f in field.dataType.fields])
        elif field.dataType.simpleString().startswith("array"):
            value = F.array().cast(field.dataType)
        else:
            value = F.lit("")
        fields.append(value.alias(field.name))
    return F.struct(*fields).cast(shape)


def flatten_responses(responses: DataFrame) -> DataFrame:
    """(user_id, pos, item fields) for reports and checks."""
    return responses.select("user_id", F.posexplode("recommended_items").alias("pos", "item"))

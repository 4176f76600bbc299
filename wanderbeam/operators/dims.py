"""User and item dimensions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wanderbeam.functions import dates, text
from wanderbeam.operators.ids import dense_ids
from wanderbeam.operators.skew import BROADCAST_ROWS, lookup_join, small_enough
from wanderbeam.session import materialise

USER_SCHEMA = (
    "raw_user_id bigint, int_user_id bigint, user_id string, gender string, age double,"
    " register_date date, busi_dt date, age_group_label string, age_group string"
)


# --- users -----------------------------------------------------------------


def latest_profile(profile: DataFrame) -> DataFrame:
    """One row per user: the latest registration, its birth date and lower-case gender.

    Equal registration dates are settled by the larger birth date, then gender.
    """
    newest = F.max(F.struct("register_date", "birth_date", F.lower("gender").alias("gender")))
    return (
        profile.filter(F.col("raw_user_id").isNotNull())
        .groupBy("raw_user_id")
        .agg(newest.alias("p"))
        .select("raw_user_id", "p.register_date", "p.birth_date", "p.gender")
    )


def new_users(profile: DataFrame, existing: DataFrame) -> DataFrame:
    """Latest profile of the users that are not in ``existing`` yet.

    Profiles are reduced to one row per user first, so no user is heavy in the anti join.
    """
    return latest_profile(profile).join(existing.select("raw_user_id"), "raw_user_id", "left_anti")


def median_age_by_gender(users: DataFrame) -> DataFrame:
    """Exact median. Counting ages first keeps the state to one entry per distinct age."""
    counted = users.filter(F.col("age").isNotNull()).groupBy("gender", "age").count()
    return counted.groupBy("gender").agg(F.percentile("age", 0.5, F.col("count")).alias("median_age"))


def impute_age(users: DataFrame, medians: DataFrame) -> DataFrame:
    """Missing ages become the median of the user's gender; no match leaves NULL."""
    return (
        lookup_join(users, medians, "gender", "left")
        .withColumn("age", F.coalesce(F.col("age").cast("double"), "median_age"))
        .select(*users.columns)
    )


def add_age_group(users: DataFrame) -> DataFrame:
    return users.withColumns(
        {
            "age_group_label": dates.age_bin(F.col("age"), "label"),
            "age_group": dates.age_bin(F.col("age"), "group"),
        }
    )


def add_user_ids(users: DataFrame, start: int = 0) -> DataFrame:
    """Ids in registration order, continuing after ``start``."""
    numbered = dense_ids(users, ["register_date", "raw_user_id"], "int_user_id", start)
    return numbered.withColumn("user_id", text.prefixed_id("user_", F.col("int_user_id")))


def max_user_id(existing: DataFrame) -> int:
    return existing.agg(F.coalesce(F.max("int_user_id"), F.lit(0))).first()[0]


def user_dim_batch(
    profile: DataFrame,
    existing: DataFrame | None,
    as_of: str | dt.date,
    literal_adjust: bool = False,
) -> DataFrame:
    """The dimension rows of users that ``existing`` lacks; ``existing`` may be empty or None."""
    if existing is None:
        existing = profile.sparkSession.createDataFrame([], USER_SCHEMA)
    today = dates.as_date(as_of)
    numbered = add_user_ids(new_users(profile, existing), max_user_id(existing))
    aged = numbered.withColumn(
        "age", dates.completed_years(F.col("birth_date"), today, literal_adjust).cast("double")
    )
    grouped = add_age_group(impute_age(aged, median_age_by_gender(existing)))
    return grouped.withColumn("busi_dt", F.lit(today)).select(
        "raw_user_id",
        "int_user_id",
        "user_id",
        "gender",
        "age",
        "register_date",
        "busi_dt",
        "age_group_label",
        "age_group",
    )


def build_user_dim(
    profile: DataFrame,
    existing: DataFrame | None,
    as_of: str | dt.date,
    literal_adjust: bool = False,
) -> DataFrame:
    """``existing`` followed by the batch of new users."""
    batch = user_dim_batch(profile, existing, as_of, literal_adjust)
    return batch if existing is None else existing.unionByName(batch, allowMissingColumns=True)


# --- items -----------------------------------------------------------------


def smallest_style(styles: DataFrame) -> DataFrame:
    """One style per item, so that several tags cannot split an item into several ids."""
    return styles.groupBy("hotel_code").agg(
        F.min(text.snake(F.col("style_name"))).alias("style_name")
    )


def normalised_items(
    profile: DataFrame,
    styles: DataFrame,
    location_overrides: Mapping[str, str] | None = None,
    language: str = "en",
) -> DataFrame:
    """Item attributes before ids: location key and style, ``unspecified`` where missing."""
    located = profile.filter(F.col("language") == language).select(
        "hotel_code",
        text.override(
            text.location_key(F.col("location_name"), F.col("city_name")),
            dict(location_overrides or {}),
        ).alias("location_name"),
        F.col("latitude").cast("float").alias("latitude"),
        F.col("longitude").cast("float").alias("longitude"),
    )
    return located.join(smallest_style(styles), "hotel_code", "left").fillna(
        text.UNSPECIFIED, ["location_name", "style_name"]
    )


def vocabulary(df: DataFrame, column: str, small_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(value, index, size): sorted distinct values, 0-based; always holds ``unspecified``.

    A vocabulary proven small is numbered in one task, a larger one by ``dense_ids``.
    """
    spark = df.sparkSession
    null_label = spark.createDataFrame([(text.UNSPECIFIED,)], f"{column} string")
    values = df.select(column).filter(F.col(column).isNotNull()).union(null_label).distinct()
    if small_enough(values, small_rows):
        everything = Window.partitionBy(F.lit(0))
        return values.select(
            column,
            (F.row_number().over(everything.orderBy(column)) - 1).cast("long").alias("index"),
            F.count(F.lit(1)).over(everything).cast("long").alias("size"),
        )
    numbered = dense_ids(values, [column], "index", start=-1)
    return numbered.withColumn("size", F.lit(numbered.count()).cast("long"))


def one_hot_index(
    df: DataFrame, column: str, vocab: DataFrame, strict: bool = False
) -> DataFrame:
    """Sparse one-hot: the position of the 1 (``<column>_index``) and the width (``_size``).

    A value outside the vocabulary has no index; ``strict`` fails on it instead.
    """
    index = f"{column}_index"
    renamed = vocab.withColumnsRenamed({"index": index, "size": f"{column}_size"})
    coded = lookup_join(df, renamed, column, "left")
    if not strict:
        return coded
    message = F.concat(F.lit(f"{column} not in vocabulary: "), F.coalesce(column, F.lit("NULL")))
    checked = F.when(F.col(index).isNull(), F.raise_error(message)).otherwise(F.col(index))
    return coded.withColumn(index, checked)


def dense_one_hot(column: str) -> Column:
    """Array of 0/1 built from the sparse form, for vocabularies small enough to spell out."""
    slots = F.sequence(F.lit(0), F.col(f"{column}_size") - 1)
    return F.transform(slots, lambda i: (i == F.col(f"{column}_index")).cast("int"))


def widen_one_hot(df: DataFrame, column: str, values: list[str], prefix: str = "") -> DataFrame:
    """One 0/1 column per vocabulary value."""
    flags = {f"{prefix}{v}": F.when(F.col(column) == v, 1).otherwise(0) for v in values}
    return df.withColumns(flags)


MAX_WIDE = 10_000
SPARSE = ("style_name_index", "style_name_size", "location_name_index", "location_name_size")


def build_item_dim(
    profile: DataFrame,
    styles: DataFrame,
    run_date: str | dt.date,
    location_overrides: Mapping[str, str] | None = None,
    wide: bool = False,
) -> DataFrame:
    """Item dimension with ids in item-code order and one-hot style and location.

    One-hot values are stored sparse, as ``<column>_index`` and ``<column>_size``; see ``spelled_out``.
    ``wide`` adds one column per style (``style_<value>``) and per location (``location_<value>``);
    the vocabularies become column names then, so they may have ``MAX_WIDE`` values at most.
    """
    items = dense_ids(
        normalised_items(profile, styles, location_overrides), ["hotel_code"], "int_hotel_id"
    )
    if wide:
        # Read back for two vocabularies and the result: compute it once.
        items = materialise(items, "items")
    items = items.withColumn("hotel_id", text.prefixed_id("hotel_", F.col("int_hotel_id")))
    styles_vocab = vocabulary(items, "style_name")
    locations_vocab = vocabulary(items, "location_name")
    items = one_hot_index(items, "style_name", styles_vocab)
    items = one_hot_index(items, "location_name", locations_vocab)
    built = items.select(
        "hotel_code",
        "int_hotel_id",
        "hotel_id",
        "location_name",
        "style_name",
        "latitude",
        "longitude",
        "style_name_index",
        "style_name_size",
        "location_name_index",
        "location_name_size",
        F.lit(dates.as_date(run_date)).alias("run_date"),
    )
    if not wide:
        return built
    for column, vocab, prefix in (
        ("style_name", styles_vocab, "style_"),
        ("location_name", locations_vocab, ""),
    ):
        # Column names are a driver-side matter; a wider vocabulary cannot be a table.
        found = vocab.select("index", column).limit(MAX_WIDE + 1).collect()
        if len(found) > MAX_WIDE:
            raise ValueError(f"{column} has too many values for one column each")
        names = [r[1] for r in sorted(found)]
        if prefix == "":
            names = [n for n in names if n != text.UNSPECIFIED]
            built = built.withColumn(
                "location_unspecified", (F.col(column) == text.UNSPECIFIED).cast("int")
            )
        built = widen_one_hot(built, column, names, prefix)
    return built


def spelled_out(items: DataFrame) -> DataFrame:
    """The stored sparse one-hots as 0/1 arrays ``style_onehot`` and ``location_onehot``."""
    return items.withColumns(
        {
            "style_onehot": dense_one_hot("style_name"),
            "location_onehot": dense_one_hot("location_name"),
        }
    )


def feature_columns(df: DataFrame, contains: str, exclude: tuple[str, ...] = ()) -> list[str]:
    """Sorted names of the columns whose name holds ``contains``, without ``exclude``."""
    return sorted(c for c in df.columns if contains in c and c not in exclude)

"""The given tables seen as bookings, app events, profiles and items.

FIXTURES.md lists the definitions; ``oracle.py`` holds the same ones as SQL. The user and
item dimensions, the bookings, the unified and training events, the recent behaviour and the
predictions are tables in their own right: daily jobs store them for the next job. They are
built once per session and written to the scratch folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wanderbeam.functions import actions, json
from wanderbeam.operators import behaviour, dims, event_log, recommend, scoring
from wanderbeam.operators.skew import lookup_join
from wanderbeam.session import scratch_age, scratch_path, shuffle_width
from wanderbeam.sources import documents

APP_ID = "shop.app"
BOOKING_DOCUMENTS = ("customer_info", "request", "details")
EVENTS_AS_OF = "2024-01-31"
EXISTING_AS_OF = "2024-01-01"
BOOKINGS_AS_OF = "2001-08-01"
EXISTING_BEFORE = "1996-01-01"
HOLDOUT_AFTER = "2024-01-10"
OVERRIDES = {"location_oldtown_porttown": "location_historic_porttown"}
LENGTH, STEP, MIN_ITEMS, TOP_K = 6, 5, 5, 10
# Order of a user's training events: total up to equal rows.
TRAINING_ORDER = ("event_timestamp", "hotel_id", "action_code", "complete_flag", "duration")

# Event name, action, class code, upstream tag.
EVENT_MAP = [
    ("view", "view", 1, "search"),
    ("click", "click", 2, "carousel"),
    ("signup", "fav", 3, "favorite_list"),
    ("purchase", "purchase", 5, "banner"),
    ("error", None, None, "N"),
]
# Type of the parameters of a raw event.
PARAMS = "array<struct<key:string,value:struct<string_value:string,int_value:bigint,float_value:float,double_value:double>>>"
# What a booking is made of.
BOOKING_COLUMNS = (
    "o_orderkey",
    "o_custkey",
    "o_orderstatus",
    "o_orderdate",
    "l_partkey",
    "l_discount",
    "l_returnflag",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_linestatus",
    "l_tax",
)
# (application, age of its scratch, folder, table) -> where it was written and with which columns.
_STORED: dict[tuple[str, int, str, str], tuple[str, StructType]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def booking_texts(lines: DataFrame, *kept: str) -> DataFrame:
    """The bookings with their documents as texts, made of the rows of ``booking_lines``, and the columns ``kept``."""
    details = F.struct(
        F.col("l_partkey").cast("string").alias("hotelId"),
        F.col("l_discount").alias("discount"),
        F.struct(
            F.struct(
                F.array(
                    F.struct(
                        F.col("l_returnflag").alias("cancellationStatus"),
                        F.col("l_linenumber").alias("days"),
                    )
                ).alias("en")
            ).alias("cancellationPolicy"),
            F.array(
                F.struct(
                    F.col("l_quantity").cast("int").alias("noOfRooms"),
                    F.col("l_extendedprice").alias("price"),
                    F.col("l_linestatus").alias("roomType"),
                )
            ).alias("roomCategories"),
            F.col("l_extendedprice").alias("totalPrice"),
        ).alias("roomDetails"),
        F.col("l_tax").alias("taxes"),
    )
    return lines.select(
        F.col("o_orderkey").alias("booking_id"),
        F.to_json(F.struct(F.col("o_custkey").cast("string").alias("customerId"))).alias(
            "customer_info"
        ),
        F.to_json(
            F.struct(
                F.col("l_partkey").cast("string").alias("hotelId"),
                F.col("l_extendedprice").alias("price"),
            )
        ).alias("request"),
        F.to_json(details).alias("details"),
        F.when(F.col("o_orderstatus") == "F", "CONFIRMED")
        .otherwise(F.col("o_orderstatus"))
        .alias("status"),
        F.col("o_orderdate").alias("updated_at"),
        *kept,
    )


class Domain:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    # --- views ---

    def events(self) -> DataFrame:
        events = documents.whole(self.event_documents())
        return events.select(
            "event_id",
            "user_id",
            json.field(events, "props", "k", "bigint").alias("hotel_code"),
            F.col("event_type").alias("event_name"),
            F.col("ts").alias("event_timestamp"),
            F.col("value").alias("duration"),
        )

    def event_map(self) -> DataFrame:
        schema = "event_name string, main_action string, encoded_main_action int, upstream_event_tag string"
        return self.spark.createDataFrame(EVENT_MAP, schema)

    def booking_lines(self) -> DataFrame:
        orders = self.table("orders").select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"
        )
        lines = self.table("lineitem")
        return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))

    def event_documents(self) -> DataFrame:
        """The events as they were loaded: the document parsed, some rows with a text that breaks off.

        The rows are dealt to all tasks first: a small file of many rows is read by few tasks, which then would parse
        all of them and leave as few files to the next step.
        """
        events = self.table("events").repartition(shuffle_width(self.spark), "event_id", "ts", "user_id")
        odd = F.col("event_id") % 89 == 0
        copies = F.when(odd, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
        rows = events.withColumn("cut", F.explode(copies))
        rows = rows.withColumn("props", F.when(F.col("cut"), F.substring("props", 1, 3)).otherwise(F.col("props"))).drop("cut")
        return self._stored("event-documents", lambda: documents.parsed(rows, ["props"]), documents.BROKEN)

    def bookings(self) -> DataFrame:
        """The booking table: documents parsed once, laid out by time so that day filters prune."""
        return documents.whole(self.booking_documents())

    def booking_documents(self) -> DataFrame:
        """The bookings as they were loaded, some rows with documents that are none."""

        def build() -> DataFrame:
            # The plain columns are laid out; documents are made of them afterwards, so that no text is shuffled or made twice.
            laid = self.booking_lines().select(*BOOKING_COLUMNS).repartitionByRange(shuffle_width(self.spark), "o_orderdate", "o_orderkey")
            odd = F.col("o_orderkey") % 97 == 0
            copies = F.when(odd, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
            rows = booking_texts(laid.withColumn("cut", F.explode(copies)), "cut")
            broken = F.col("cut") & (F.col("booking_id") % 2 == 0)
            texts = {
                "details": F.when(F.col("cut"), F.substring("details", 1, 20)).otherwise(F.col("details")),
                "request": F.when(broken, "none").otherwise(F.col("request")),
            }
            return documents.parsed(rows.withColumns(texts).drop("cut"), BOOKING_DOCUMENTS)

        return self._stored("booking-documents", build, documents.BROKEN)

    def build_bookings(self) -> DataFrame:
        return booking_texts(self.booking_lines())

    def booked_items(self) -> DataFrame:
        """One item per booking, as text like the event parameters; stored, since lookups read it twice: to measure it and to join it."""

        def build() -> DataFrame:
            return self.table("lineitem").groupBy("l_orderkey").agg(F.min("l_partkey").alias("p")).select(
                F.col("l_orderkey").cast("string").alias("booking_id"),
                F.col("p").cast("string").alias("booking_hotel_id"),
            )

        return self._stored("booked-items", build)

    def customer_profile(self) -> DataFrame:
        """One snapshot per order: a user has many, some without a birth date."""
        gender = (
            F.when(F.col("c_mktsegment") == "AUTOMOBILE", "male")
            .when(F.col("c_mktsegment") == "BUILDING", "FEMALE")
            .when(F.col("c_mktsegment") == "FURNITURE", "other")
            .when(F.col("c_mktsegment") == "HOUSEHOLD", "none")
        )
        born = F.date_add(F.lit("1950-01-01").cast("date"), F.floor(F.col("c_acctbal") * 2.4).cast("int"))
        orders = self.table("orders").select("o_custkey", "o_orderdate", "o_orderpriority")
        customers = self.table("customer").select("c_custkey", "c_mktsegment", "c_acctbal")
        return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
            F.col("c_custkey").alias("raw_user_id"),
            F.to_date("o_orderdate").alias("register_date"),
            gender.alias("gender"),
            F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", born).alias("birth_date"),
        )

    def hotel_profile(self) -> DataFrame:
        """Every item in English, most in Thai too."""
        thai = F.col("p_size") > 8
        languages = F.when(thai, F.array(F.lit("en"), F.lit("th"))).otherwise(F.array(F.lit("en")))
        rows = self.table("part").withColumn("language", F.explode(languages))
        return rows.select(
            F.col("p_partkey").alias("hotel_code"),
            "language",
            F.when(F.col("language") == "th", F.upper("p_name")).otherwise(F.col("p_name")).alias("hotel_name"),
            F.col("p_brand").alias("address1"),
            F.col("p_type").alias("address2"),
            F.when(F.col("p_size") != 17, F.col("p_name")).alias("address3"),
            F.col("p_size").cast("string").alias("zipcode"),
            F.when(F.col("p_size") == 23, None)
            .when(F.col("p_size").between(20, 22), "")
            .when(F.col("p_size") == 24, " Old, Town ")
            .when(F.col("p_size") == 45, "Old Town")
            .otherwise(F.col("p_type"))
            .alias("location_name"),
            F.concat(F.lit("L"), "p_brand").alias("location_code"),
            F.when(F.col("p_size") <= 40, "Central City").otherwise("Port Town").alias("city_name"),
            F.when(F.col("p_size") <= 40, "C1").otherwise("C2").alias("city_code"),
            F.lit("Freeland").alias("country_name"),
            F.lit("FL").alias("country_code"),
            F.concat(F.lit("img/"), F.col("p_partkey").cast("string")).alias("image_url"),
            (F.col("p_size") % 5 + 1).alias("rating"),
            F.when(F.col("p_size") <= 45, "Y").otherwise("N").alias("display"),
            F.col("p_size").alias("latitude"),
            F.col("p_retailprice").alias("longitude"),
        )

    def styles(self) -> DataFrame:
        """Brand as style; large items have a second tag, one brand has no first one."""
        part = self.table("part")
        first = part.filter(F.col("p_brand") != "Brand#7").select(
            F.col("p_partkey").alias("hotel_code"), F.col("p_brand").alias("style_name")
        )
        second = part.filter(F.col("p_size") > 25).select(
            F.col("p_partkey").alias("hotel_code"),
            F.concat(F.lit("Grand "), "p_brand").alias("style_name"),
        )
        return first.unionByName(second)

    def raw_events(self) -> DataFrame:
        return self._stored("raw-events", self.build_raw_events)

    def build_raw_events(self) -> DataFrame:
        """App events with a session (the day) and key-value parameters.

        Some events come from a second session of the user at the same time, some from a second user.
        """
        name, value = F.col("event_type"), F.col("value")
        loaded = documents.whole(self.event_documents())
        # Once per event, before its copies are made.
        loaded = loaded.withColumns({"item": json.field(loaded, "props", "k"), "day": F.date_format("ts", "yyyyMMdd")})
        item = F.col("item")

        def param(key: str, text: Column | None = None, number: Column | None = None) -> Column:
            return F.struct(
                F.lit(key).alias("key"),
                F.struct(
                    (F.lit(None).cast("string") if text is None else text).alias("string_value"),
                    (F.lit(None).cast("bigint") if number is None else number).alias("int_value"),
                    F.lit(None).cast("float").alias("float_value"),
                    F.lit(None).cast("double").alias("double_value"),
                ).alias("value"),
            )

        def given(condition: Column, *some: Column) -> Column:
            return F.when(condition, F.array(*some)).otherwise(F.array().cast(PARAMS))

        params = F.concat(
            given((name != "purchase") | (value >= 5), param("hotel_id", item)),
            F.array(
                param("hotel_name", F.concat(F.lit("Hotel "), item)),
                param(
                    "content_group",
                    F.when(value >= 20, "OTA Flight")
                    .when(name == "error", "Other")
                    .when(name == "signup", "ota")
                    .otherwise("OTA Hotel"),
                ),
                param("first_touch_source", F.when(value < 10, "organic").otherwise("ads")),
            ),
            given(name == "purchase", param("booking_id", None, F.col("event_id"))),
            given(name == "click", param("carousel_id", F.lit("c1")), param("carousel_name", F.lit("Top picks"))),
        )
        again = F.concat(
            F.array(F.lit(0)),
            F.when(F.col("event_id") % 11 == 0, F.array(F.lit(1))).otherwise(F.array().cast("array<int>")),
            F.when(F.col("event_id") % 13 == 0, F.array(F.lit(2))).otherwise(F.array().cast("array<int>")),
        )
        events = loaded.withColumn("copy", F.explode(again))
        user = F.col("user_id") + F.when(F.col("copy") == 2, 1).otherwise(0)
        session = F.col("day").cast("bigint") + F.when(F.col("copy") == 1, 1).otherwise(0)
        return events.select(
            F.col("day").alias("event_date"),
            F.col("ts").alias("event_timestamp"),
            name.alias("event_name"),
            F.when((name == "error") & (value < 2), " ")
            .otherwise(user.cast("string"))
            .alias("user_id"),
            session.alias("ga_session_id"),
            F.struct(F.when(value > 45, "Other.App").otherwise("Shop.App").alias("id")).alias("app_info"),
            params.alias("event_params"),
        )

    # --- stored tables ---

    def _stored(self, name: str, build: Callable[[], DataFrame], partition: str | None = None) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, scratch_age(self.spark), self.sf_dir, name)
        if key not in _STORED:
            built, path = build(), scratch_path(self.spark, name)
            (built.write.partitionBy(partition) if partition else built.write).parquet(path)
            _STORED[key] = (path, built.schema)
        path, schema = _STORED[key]
        return self.spark.read.schema(schema).parquet(path)

    def existing_users(self) -> DataFrame:
        """The user dimension after the first load."""
        early = F.col("register_date") < F.lit(EXISTING_BEFORE).cast("date")
        return self._stored(
            "existing-users",
            lambda: dims.build_user_dim(
                self.customer_profile().filter(early), None, EXISTING_AS_OF
            ),
        )

    def users(self) -> DataFrame:
        """The user dimension after the second load."""
        return self._stored(
            "users",
            lambda: dims.build_user_dim(
                self.customer_profile(), self.existing_users(), EVENTS_AS_OF
            ),
        )

    def items(self) -> DataFrame:
        return self._stored(
            "items",
            lambda: dims.build_item_dim(
                self.hotel_profile(), self.styles(), EVENTS_AS_OF, OVERRIDES
            ),
        )

    def training(self) -> DataFrame:
        """The training table: runs of mapped events of known users and items, with class codes."""
        return self._stored("training", self.build_training)

    def build_training(self) -> DataFrame:
        rows = event_log.training_events(self.event_runs(), self.booked_items(), self.event_map(), self.users(), self.items())
        return rows.withColumn("action_code", actions.encode(F.col("main_action")))

    def app_events(self) -> DataFrame:
        """The unified events as behaviour: one row per event key, ids as numbers."""
        return self.unified_events().select(
            F.col("user_id").try_cast("bigint").alias("user_id"),
            F.col("hotel_id").try_cast("bigint").alias("hotel_code"),
            "event_name",
            "event_timestamp",
        )

    def run_events(self) -> DataFrame:
        """The event runs as events, each at its last time."""
        return self.event_runs().select(
            F.col("user_id").try_cast("bigint").alias("user_id"),
            F.col("hotel_id").try_cast("bigint").alias("hotel_code"),
            "event_name",
            F.col("max_event_timestamp").alias("event_timestamp"),
        )

    def unified_events(self) -> DataFrame:
        """The table of app events with their parameters as columns."""
        return self._stored(
            "unified-events",
            lambda: event_log.unified_events(self.raw_events(), APP_ID, self.event_map()),
        )

    def event_runs(self) -> DataFrame:
        return self._stored("event-runs", lambda: event_log.event_runs(self.unified_events()))

    def trained_items(self) -> DataFrame:
        return self.training().select("hotel_id").distinct()

    def trained_users(self) -> DataFrame:
        return self.training().select("user_id").distinct()

    def behaviour(self, keep: str = "last") -> DataFrame:
        """Recent behaviour of every user."""
        return self._stored(f"behaviour-{keep}", lambda: self.build_behaviour(keep))

    def build_behaviour(self, keep: str = "last") -> DataFrame:
        return behaviour.recent_behaviour(
            self.bookings(),
            self.app_events(),
            self.event_map(),
            self.users(),
            self.items(),
            self.trained_items(),
            LENGTH,
            keep,
        )

    def eligible(self) -> DataFrame:
        return behaviour.split_eligible(self.behaviour(), self.trained_users(), LENGTH)[0]

    def scored_items(self) -> DataFrame:
        return self.items().join(scoring.empirical_scores(self.training()), "hotel_id")

    def predictions(self) -> DataFrame:
        """Every candidate of every eligible user with its score."""
        return self.prediction_parts().pairs()

    def build_predictions(self) -> DataFrame:
        return self.build_prediction_parts().pairs()

    def prediction_parts(self) -> recommend.Offered:
        """The predictions as they are stored: users and scored items, not users times items."""
        parts: list[recommend.Offered] = []

        def built() -> recommend.Offered:
            if not parts:
                parts.append(self.build_prediction_parts())
            return parts[0]

        return recommend.Offered(
            self._stored("prediction-owners", lambda: built().owners),
            self._stored("prediction-members", lambda: built().members),
        )

    def build_prediction_parts(self) -> recommend.Offered:
        return recommend.offered(
            self.eligible(),
            self.scored_items(),
            self.trained_items(),
            LENGTH,
            ("pred_action", "prob", "important_value"),
        )

    def default_items(self) -> DataFrame:
        """What a user without a list gets: the most booked items among those on display."""
        shown = recommend.displayed_items(self.items(), self.hotel_profile())
        offered = self.items().join(shown, "hotel_id", "left_semi")
        return recommend.trending(self.bookings(), offered, BOOKINGS_AS_OF, k=TOP_K)

    def playlists(self) -> DataFrame:
        return self._stored("playlists", self.build_playlists)

    def top_offers(self, displayed_only: bool) -> DataFrame:
        """Candidates that can be in a top list, instead of users times items.

        The empirical score depends on the item alone, so only the best items of a location are
        offered to its users.
        """
        scored = recommend.trained_only(self.scored_items(), self.trained_items())
        if displayed_only:
            displayed = recommend.displayed_items(self.items(), self.hotel_profile())
            scored = scored.join(displayed, "hotel_id", "left_semi")
        best = recommend.best_of_location(scored, TOP_K)
        return recommend.candidates(
            self.eligible(),
            self.items(),
            self.trained_items(),
            LENGTH,
            ("pred_action", "prob", "important_value"),
            targets=best,
        )

    def offers(self) -> DataFrame:
        """The best displayed items of every user, and of the default user: what is served is made from these."""
        return self._stored("offers", self.build_offers)

    def build_offers(self) -> DataFrame:
        offered = recommend.with_default_user(self.top_offers(True), self.default_items(), TOP_K)
        return recommend.rank_per_user(offered.select("user_id", "target_hotel_id", "important_value"), TOP_K).drop("rank")

    def build_playlists(self) -> DataFrame:
        """Top items per user straight from the behaviour, plus the trending default."""
        return recommend.playlist(self.offers(), self.users(), self.items(), TOP_K)

"""Typed access to JSON documents: texts, or VARIANT columns that were parsed at load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The documents' schemas.
REQUEST_SCHEMA = (
    "hotelId STRING, cityId STRING, checkInDate STRING, checkOutDate STRING,"
    " room ARRAY<STRUCT<roomType:STRING, adults:INT, children:INT, childAge1:INT, childAge2:INT>>,"
    " currency STRING, countryId STRING, roomCode STRING, roomCategory STRING, price DOUBLE,"
    " supplierId STRING, supplierName STRING, checkPrice INT, mealCode STRING"
)
CUSTOMER_SCHEMA = "customerId STRING, firstName STRING, lastName STRING, membershipId STRING"


def parse(document: Column, schema: str) -> Column:
    """A malformed document gives a struct of NULLs. Unused fields are pruned by Spark."""
    return F.from_json(document, schema)


def path_text(document: Column, path: str) -> Column:
    return F.get_json_object(document, f"$.{path}")


def path_long(document: Column, path: str) -> Column:
    return path_text(document, path).try_cast("bigint")


def field(df: DataFrame, column: str, path: str, kind: str = "string") -> Column:
    """A value inside the document in ``column`` of ``df``, NULL if it is absent or not of the kind.

    A VARIANT is read in place; a text is parsed for this one value.
    """
    if isinstance(df.schema[column].dataType, T.VariantType):
        return F.try_variant_get(F.col(column), f"$.{path}", kind)
    found = path_text(F.col(column), path)
    return found if kind == "string" else found.try_cast(kind)


# Schema of the booking-details document.
_POLICY = (
    "ARRAY<STRUCT<cancellationChargeDescription:STRING, cancellationDaysDescription:STRING,"
    " cancellationStatus:STRING, days:INT>>"
)
_BOTH_LANGUAGES = "STRUCT<en:ARRAY<STRING>, th:ARRAY<STRING>>"
_ROOM_CATEGORIES = (
    "ARRAY<STRUCT<childAge1:INT, childAge2:INT, mealTypeId:STRING, noOfAdults:INT, noOfRooms:INT,"
    " noOfRoomsAndName:STRING, price:DOUBLE, priceOfRoomWithChildMeal:DOUBLE, rateKey:STRING,"
    " rateKeyRa:STRING, roomId:STRING, roomName:STRING, roomType:STRING>>"
)
_ROOM_DETAILS = (
    f"STRUCT<cancellationPolicy:STRUCT<en:{_POLICY}, th:{_POLICY}>,"
    " facilities:ARRAY<STRUCT<key:STRING, value:STRING>>,"
    f" hotelBenefits:{_BOTH_LANGUAGES}, mealTypeEn:STRING, mealTypeTh:STRING,"
    f" numberOfNights:STRING, perNightPrice:DOUBLE, promotion:{_BOTH_LANGUAGES},"
    f" roomCategories:{_ROOM_CATEGORIES}, roomInfo:STRUCT<roomFacilities:{_BOTH_LANGUAGES}>,"
    " supplier:STRING, supplierId:STRING, supplierName:STRING, totalPrice:DOUBLE>"
)
DETAILS_SCHEMA = (
    "addOnServices ARRAY<STRING>, additionalNeedsTxt STRING, addressEn STRING, addressTh STRING,"
    " checkInDate STRING, checkInTime STRING, checkOutDate STRING, checkOutTime STRING,"
    " cityId STRING, contactNumber STRING, countryId STRING, discount DOUBLE, fees DOUBLE,"
    " hotelId STRING, hotelImage STRING, hotelNameEn STRING, hotelNameTh STRING,"
    " isAddOnServicesAvailable BOOLEAN, latitude DOUBLE, longitude DOUBLE, rating STRING,"
    " ratingCount STRING, ratingTextEn STRING, ratingTextTh STRING,"
    f" roomDetails {_ROOM_DETAILS}, taxes DOUBLE"
)

"""Distinct counts over any days from one exact bitmap per day and group.

An id is a dense number, so a set of ids is a row of 4096-byte bitmaps, one for each 32,768 ids in
which the set has a member. Days are united by OR, and a count over any days never reads the events again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wanderbeam.sources.tables import partition_values

DAY, BUCKET, MEMBERS = "day", "id_bucket", "members"


def day_bitmaps(rows: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """One row per ``day``, ``keys`` and bucket of ids, with the bitmap of the ids ``number`` seen.

    Partial bitmaps are formed before the shuffle, so a hot group sends a row per task and bucket.
    Rows without a day or an id take no part.
    """
    dated = rows.select(DAY, *keys, F.col(number).cast("long").alias("__id"))
    dated = dated.filter(F.col(DAY).isNotNull() & F.col("__id").isNotNull())
    return dated.groupBy(DAY, *keys, F.bitmap_bucket_number("__id").alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("__id")).alias(MEMBERS)
    )


def stored_days(spark: SparkSession, path: str) -> list[dt.date]:
    """Days in the store, from a listing of its folders."""
    return [dt.date.fromisoformat(v) for v in partition_values(spark, path, DAY)]


def add_days(
    spark: SparkSession,
    path: str,
    rows_between: Callable[[dt.date | None, dt.date], DataFrame],
    keys: Sequence[str],
    number: str,
    upto: dt.date,
) -> None:
    """Store the days after the last one in the store, up to and with ``upto``.

    ``rows_between(after, upto)`` gives the rows of those days with a ``day`` (``after`` is None for an empty
    store), so their day filter can reach the scan and no other day is read. A stored day is complete and is
    not changed again; a load that failed is repeated as a whole.
    """
    after = max(stored_days(spark, path), default=None)
    if after is not None and after >= upto:
        return
    bitmaps = day_bitmaps(rows_between(after, upto), keys, number)
    bitmaps.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def distinct_over(spark: SparkSession, path: str, first: dt.date, last: dt.date, keys: Sequence[str], out: str) -> DataFrame:
    """Distinct ids per ``keys`` from ``first`` to ``last``: only those days are read, and only bitmaps."""
    days = spark.read.parquet(path).filter(F.col(DAY).between(F.lit(first), F.lit(last)))
    united = days.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(MEMBERS).alias(MEMBERS))
    return united.groupBy(*keys).agg(F.sum(F.bitmap_count(MEMBERS)).alias(out))


def trailing_distinct(spark: SparkSession, path: str, days: int, keys: Sequence[str], out: str) -> DataFrame:
    """For every stored day the distinct ids per ``keys`` of the ``days`` days that end with it."""
    held = spark.read.parquet(path)
    last = held.agg(F.max(DAY).alias("last")).first()["last"]
    ends = F.explode(F.transform(F.sequence(F.lit(0), F.lit(days - 1)), lambda i: F.date_add(F.col(DAY), i)))
    spread = held.select(ends.alias("until"), *keys, BUCKET, MEMBERS).filter(F.col("until") <= F.lit(last))
    united = spread.groupBy("until", *keys, BUCKET).agg(F.bitmap_or_agg(MEMBERS).alias(MEMBERS))
    return united.groupBy("until", *keys).agg(F.sum(F.bitmap_count(MEMBERS)).alias(out))

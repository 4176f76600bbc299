"""Contiguous shards of equal byte size from global prefix sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wanderbeam.session import materialise, shuffle_width

PART, LOCAL = "__part", "__local"


def prefix_sums(
    df: DataFrame, order: Sequence[str], values: dict[str, str], partitions: int | None = None
) -> DataFrame:
    """Adds exclusive running totals over the whole frame in ``order``.

    ``values`` maps a numeric column to the name of its running total. The rows are
    range-partitioned on ``order`` and written with their partition number, so a lost
    executor can't move a row to another partition. Each partition sums its own rows;
    the totals of the earlier partitions, one row per partition, are broadcast. Rows that
    agree in all of ``order`` get their totals in any order. An empty frame gives none.
    """
    placed = df.repartitionByRange(partitions or shuffle_width(df.sparkSession), *order)
    stored = materialise(placed.withColumn(PART, F.spark_partition_id()), "prefix-sums")
    totals = stored.groupBy(PART).agg(*[F.sum(v).alias(f"{LOCAL}_{out}") for v, out in values.items()])
    before = W.orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        PART,
        *[F.coalesce(F.sum(f"{LOCAL}_{o}").over(before), F.lit(0)).alias(f"__offset_{o}") for o in values.values()],
    )
    within = W.partitionBy(PART).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    running = stored.select(
        "*", *[F.coalesce(F.sum(v).over(within), F.lit(0)).alias(f"{LOCAL}_{o}") for v, o in values.items()]
    )
    return running.join(F.broadcast(offsets), PART).select(
        *df.columns,
        *[(F.col(f"{LOCAL}_{o}") + F.col(f"__offset_{o}")).cast("long").alias(o) for o in values.values()],
    )


def byte_shards(
    df: DataFrame,
    size: str,
    order: Sequence[str],
    shards: int = 16,
    partitions: int | None = None,
) -> DataFrame:
    """Adds ``shard`` and ``slot``: contiguous runs of ``order`` with equal sums of ``size``.

    A row goes to the shard in which its first byte falls when the whole is cut at
    multiples of total / ``shards``; shards so differ by less than the largest row. ``slot``
    counts a shard's rows from 0 without gaps. A group larger than a shard is cut like any other run
    of rows. ``size`` must be positive; NULL counts as 1. An empty frame gives no rows.
    """
    sized = df.withColumn("__size", F.greatest(F.coalesce(F.col(size), F.lit(1)), F.lit(1)).cast("long")).withColumn(
        "__one", F.lit(1).cast("long")
    )
    summed = prefix_sums(sized, order, {"__size": "__start", "__one": "__row"}, partitions)
    # prefix_sums reads what it has stored: a second pass over it is a scan of narrow rows.
    whole = summed.agg(F.max(F.col("__start") + F.col("__size"))).first()[0] or 1
    placed = summed.withColumn(
        "shard", F.expr(f"cast((cast(__start as decimal(38,0)) * {int(shards)}) div {int(whole)} as int)")
    )
    first = placed.groupBy("shard").agg(F.min("__row").alias("__first"))
    return placed.join(F.broadcast(first), "shard").select(
        *df.columns, "shard", (F.col("__row") - F.col("__first")).cast("long").alias("slot")
    )


def document_shards(docs: DataFrame, shards: int = 16, partitions: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document.

    Documents are ordered by (MD5 of the text, doc_id): equal texts are neighbours and share
    a shard unless a cut falls between them, and the order has nothing to do with sources. Only
    narrow rows are shuffled, no text. NULL texts count as empty (size 1, checksum 0).
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        F.unhex(F.md5(text)).alias("__text_key"),
    )
    placed = byte_shards(narrow, "size", ["__text_key", "doc_id"], shards, partitions)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

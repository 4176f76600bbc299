"""Dense surrogate ids without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wanderbeam.session import materialise, shuffle_width

# monotonically_increasing_id() keeps the partition number above this bit.
_ROW_BITS = 33


def dense_ids(
    df: DataFrame,
    order: Sequence[str],
    out: str,
    start: int = 0,
    partitions: int | None = None,
) -> DataFrame:
    """``row_number()`` over the whole frame, plus ``start``, as a bigint.

    Range-partitions on ``order`` (which must be total), numbers the sorted rows inside each
    partition, writes that once, and adds the row counts of the earlier partitions. Those
    are one number per partition, which is all that reaches the driver and is broadcast.
    """
    partitions = partitions or shuffle_width(df.sparkSession)
    numbered = (
        df.repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn("__row", F.monotonically_increasing_id())
    )
    written = materialise(numbered, "dense-ids").withColumn(
        "__part", F.shiftright("__row", _ROW_BITS).cast("int")
    )
    sizes = dict(written.groupBy("__part").count().collect())
    earlier = accumulate([sizes.get(p, 0) for p in range(partitions)], initial=0)
    offsets = df.sparkSession.createDataFrame(
        [(p, n) for p, n in zip(range(partitions), earlier)], "__part int, __offset long"
    )
    local = F.col("__row").bitwiseAND((1 << _ROW_BITS) - 1)
    return written.join(F.broadcast(offsets), "__part").select(
        *df.columns, (local + F.col("__offset") + 1 + start).cast("long").alias(out)
    )

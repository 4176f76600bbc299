"""Values of few classes brought back to many rows, whatever the size of a class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wanderbeam.operators.skew import lookup_join


def back_to_rows(rows: DataFrame, classes: DataFrame, key: str, value: str, total: int, share: float = 0.001) -> DataFrame:
    """``rows`` with the ``value`` of their class (NULL where there is none).

    ``classes`` has one row per ``key`` with ``value`` and ``n``, its number of rows, out of ``total``. Classes of more than ``share`` of
    all rows, at most 1 / ``share`` of them, are broadcast; only the rows of other classes are shuffled, so no key is hot.
    """
    big = F.col("n") > share * total
    found = rows.join(F.broadcast(classes.where(big).select(key, F.col(value).alias("__heavy"))), key, "left")
    light = classes.where(~big).select(key, F.col(value).alias(value))
    settled = F.col("__heavy").isNotNull()
    others = lookup_join(found.where(~settled).drop("__heavy"), light, key, "left")
    return found.where(settled).withColumnRenamed("__heavy", value).unionByName(others)

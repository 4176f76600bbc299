"""Table checks, each a single aggregation pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def profile_metrics(columns: Sequence[str], ranges: Sequence[str] = ()) -> dict[str, Column]:
    """Row count, NULLs per column (``<column>_nulls``), and least and greatest value of the ``ranges``."""
    metrics = {"n_rows": F.count(F.lit(1))}
    metrics |= {f"{c}_nulls": F.count_if(F.col(c).isNull()) for c in columns}
    for c in ranges:
        metrics |= {f"first_{c}": F.min(c), f"last_{c}": F.max(c)}
    return metrics


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Row count and NULLs per column (``<column>_nulls``)."""
    return df.agg(*[c.alias(n) for n, c in profile_metrics(columns or df.columns).items()])


def time_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("first"), F.max(column).alias("last"))


def distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def largest_groups(df: DataFrame, column: str, k: int = 3) -> DataFrame:
    return distribution(df, column).orderBy(F.desc("n"), column).limit(k)


def shared_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Number of keys of ``left`` that are in ``right`` too; 0 for a proper split."""
    return left.join(right.select(key), key, "left_semi").agg(F.count(F.lit(1)).alias("n_shared"))

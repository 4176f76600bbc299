"""Parquet and catalogue tables: scan, overwrite, append, keyed upsert, keyed snapshot."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wanderbeam.operators.skew import row_bytes

BUCKET_BYTES = 128 << 20
# Feature tables: partition columns, and hidden names beside them, which no reader lists.
BUCKETS, BUCKET = "buckets", "bucket"
PENDING, LOCK = "_pending", "_lock"
FEATURE_BUCKETS = 64


def scan(spark: SparkSession, source: str, merge_schema: bool = False) -> DataFrame:
    """A parquet folder (anything with a slash) or a catalogue table."""
    if "/" in source:
        return spark.read.option("mergeSchema", merge_schema).parquet(source)
    return spark.table(source)


def parameterised(
    spark: SparkSession, query: str, values: Mapping[str, object], **frames: DataFrame
) -> DataFrame:
    """SQL over ``{frame}`` with ``:value`` parameters, which are bound, never pasted in."""
    return spark.sql(query, args=dict(values), **frames)


def overwrite(df: DataFrame, target: str) -> None:
    """Replace a table together with its schema."""
    if "/" in target:
        df.write.mode("overwrite").parquet(target)
    else:
        df.write.mode("overwrite").saveAsTable(target)


def append_evolving(df: DataFrame, path: str) -> None:
    """Append rows that may bring new columns; read back with ``merge_schema=True``."""
    df.write.mode("append").parquet(path)


def upserted(base: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``base`` merged with ``delta``, one row per key of ``delta``.

    A matched row takes the delta's values and keeps its own in the columns that the delta doesn't
    have; columns new in the delta are NULL in the other rows. Two delta rows for one key are refused.
    """
    keys = list(keys)
    if delta.groupBy(*keys).count().where("count > 1").limit(1).count():
        raise ValueError(f"the delta has several rows for one key of {keys}")
    values = [c for c in delta.columns if c not in keys]
    renamed = delta.select(*[F.col(f"`{k}`").alias(f"__key_{i}") for i, k in enumerate(keys)], *[F.col(f"`{c}`").alias(f"__new_{c}") for c in values], F.lit(True).alias("__new"))
    same = reduce(and_, [base[k].eqNullSafe(renamed[f"__key_{i}"]) for i, k in enumerate(keys)])
    both = base.withColumn("__old", F.lit(True)).join(renamed, same, "full")
    is_new = F.col("__new").isNotNull()
    out = []
    for column in [*base.columns, *[c for c in values if c not in base.columns]]:
        if column in keys:
            known = F.when(F.col("__old").isNotNull(), base[column])
            out.append(known.otherwise(F.col(f"__key_{keys.index(column)}")).alias(column))
        elif column not in values:
            out.append(base[column])
        elif column in base.columns:
            out.append(F.when(is_new, F.col(f"`__new_{column}`")).otherwise(base[column]).alias(column))
        else:
            out.append(F.col(f"`__new_{column}`").alias(column))
    return both.select(*out)


def _files(spark: SparkSession, path: str):
    """The file system of ``path`` and the path in its own terms."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def _bucketed(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """``df`` with the bucket of its key; a NULL in a key is a value like any other."""
    number = F.pmod(F.xxhash64(*[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("\\N")) for k in keys]), F.lit(buckets))
    return df.withColumns({BUCKETS: F.lit(buckets), BUCKET: number.cast("int")})


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the first partition column of a table, from a listing of its folder; none if there is no table."""
    files, folder = _files(spark, path)
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(n.removeprefix(f"{column}=") for n in names if n.startswith(f"{column}="))


def bucket_count(spark: SparkSession, root: str) -> int | None:
    """Buckets of a feature table, from the name of its folder; None if there is no table yet."""
    found = partition_values(spark, root, BUCKETS)
    return int(found[0]) if found else None


def _replace_buckets(spark: SparkSession, root: str) -> None:
    """Put the buckets that lie ready in the pending folder in the place of those of the table."""
    ready = spark.read.parquet(f"{root}/{PENDING}")
    dealt = ready.repartition(BUCKET)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKETS, BUCKET).parquet(root)
    files, folder = _files(spark, f"{root}/{PENDING}")
    files.delete(folder, True)


def read_features(spark: SparkSession, root: str) -> DataFrame:
    """The whole feature table; columns that a bucket doesn't have are NULL in its rows."""
    return spark.read.option("mergeSchema", True).parquet(root).drop(BUCKETS, BUCKET)


def feature_upsert(
    spark: SparkSession, root: str, delta: DataFrame, keys: Sequence[str], buckets: int = FEATURE_BUCKETS
) -> DataFrame:
    """Merge ``delta`` into the table at ``root``; create the table, with ``buckets`` buckets, if missing.

    The table lies in buckets by a hash of its key. Only the buckets that hold a key of the delta are read, merged and written, so
    a merge costs what it touches. The merged buckets are first written whole to a pending folder and then
    replace the old ones; a merge that was broken off in between is finished by the next one before it
    starts. One merge runs at a time: a second one finds the lock and is refused.
    """
    keys = list(keys)
    files, lock = _files(spark, f"{root}/{LOCK}")
    if not files.createNewFile(lock):
        raise RuntimeError(f"another merge holds {root}/{LOCK}")
    try:
        finished, pending = _files(spark, f"{root}/{PENDING}/_SUCCESS")
        if finished.exists(pending):
            _replace_buckets(spark, root)
        known = bucket_count(spark, root)
        dealt = _bucketed(delta, keys, known or buckets)
        if known is None:
            merged = upserted(dealt.limit(0), dealt, keys)
        else:
            # At most as many numbers as the table has buckets.
            touched = [row[0] for row in dealt.select(BUCKET).distinct().collect()]
            base = spark.read.option("mergeSchema", True).parquet(root).filter(F.col(BUCKET).isin(touched))
            merged = upserted(base, dealt, keys)
        merged.write.mode("overwrite").parquet(f"{root}/{PENDING}")
        _replace_buckets(spark, root)
    finally:
        files.delete(lock, False)
    return read_features(spark, root)


def publish_snapshot(
    df: DataFrame,
    table: str,
    key: str,
    path: str | None = None,
    buckets: int | None = None,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """A keyed snapshot as a bucketed, sorted table: joins on ``key`` need no shuffle of it.

    The number of buckets follows from the measured bytes. Rows are dealt by ``key`` before they are written,
    so each bucket is one file. ``path`` puts the files elsewhere than the warehouse.
    """
    if buckets is None:
        size = df.agg(F.sum(row_bytes(df.schema))).first()[0] or 0
        buckets = max(1, -(-size // bucket_bytes))
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


class RefusedLoad(ValueError):
    """A load that broke a rule; ``profile`` says what was seen and ``staged`` where the rows are."""

    def __init__(self, broken: Sequence[str], profile: Mapping[str, object], staged: str) -> None:
        super().__init__(f"refused: {', '.join(broken)}")
        self.broken, self.profile, self.staged = list(broken), dict(profile), staged


def load_observed(
    df: DataFrame,
    path: str,
    metrics: Mapping[str, Column],
    rules: Mapping[str, Column] | None = None,
) -> dict[str, object]:
    """Write ``df`` to the new table ``path`` and give the ``metrics``, which are taken while it is written.

    Metrics and rules are aggregates that ride along in the writing pass, so the rows are neither read again nor
    computed twice. A rule is a boolean aggregate; where one is not true, nothing appears at ``path``: the rows stay in a folder
    beside it for inspection and the load is refused.
    """
    rules = dict(rules or {})
    spark = df.sparkSession
    staged = f"{path}.staged-{uuid.uuid4().hex}"
    seen = Observation(f"load-{uuid.uuid4().hex}")
    df.observe(seen, *[c.alias(n) for n, c in metrics.items()], *[c.alias(f"rule {n}") for n, c in rules.items()]).write.parquet(staged)
    found = seen.get
    profile = {n: found[n] for n in metrics}
    broken = [n for n in rules if found[f"rule {n}"] is not True]
    if broken:
        raise RefusedLoad(broken, profile, staged)
    files, source = _files(spark, staged)
    if not files.rename(source, spark._jvm.org.apache.hadoop.fs.Path(path)):
        raise FileExistsError(path)
    return profile

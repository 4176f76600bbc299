"""Export as delimited files in chunks, with a manifest: resumable, and checked when it is read.

``data/__chunk=n`` holds the files of chunk n, ``manifest`` one row per whole chunk with its
lines and a checksum of them. A chunk without a row in the manifest was never finished.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wanderbeam.sources.delimited import CHUNK_ROWS, SEPARATOR, joined_sequences, read_delimited
from wanderbeam.sources.tables import partition_values

CHUNK = "__chunk"
MANIFEST = f"{CHUNK} int, n_lines long, checksum decimal(38,0)"


class DamagedExport(ValueError):
    """Chunks that are missing, unfinished or not as they were written."""


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Whole chunks, each with its lines and their checksum."""
    written = partition_values(spark, f"{path}/manifest", "wave")
    if not written:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.parquet(f"{path}/manifest").drop("wave")


def _measured(spark: SparkSession, path: str, chunks: Sequence[int]) -> DataFrame:
    """Lines and checksum of chunks as they lie there; a chunk without files has no lines.

    The checksum is a sum of hashes of lines, so it does not depend on the order of files.
    """
    all_chunks = spark.createDataFrame([(c,) for c in chunks], f"{CHUNK} int")
    if not partition_values(spark, f"{path}/data", CHUNK):
        return all_chunks.select(CHUNK, F.lit(0).cast("long").alias("n_lines"), F.lit(0).cast("decimal(38,0)").alias("checksum"))
    lines = spark.read.schema(f"value string, {CHUNK} int").text(f"{path}/data").filter(F.col(CHUNK).isin(list(chunks)))
    found = lines.groupBy(CHUNK).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.xxhash64("value").cast("decimal(20,0)")).cast("decimal(38,0)").alias("checksum")
    )
    return all_chunks.join(found, CHUNK, "left").na.fill(0, ["n_lines"]).withColumn(
        "checksum", F.coalesce("checksum", F.lit(0).cast("decimal(38,0)"))
    )


def export_chunks(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    chunks: int = 64,
    waves: int = 4,
    rows_per_file: int = CHUNK_ROWS,
    stop_after: int | None = None,
) -> int:
    """Write the chunks that the manifest doesn't have yet; gives the number of chunks written.

    Rows go to chunks by a hash of ``keys``, so a second run of the same frame deals them alike. Chunks are written in ``waves``, a
    read of ``df`` each (hand over a stored table); a wave enters the manifest after its files are there. What a killed run
    left of a wave is replaced by the next run, so no row is there twice. ``stop_after`` ends after so many waves.
    """
    spark = df.sparkSession
    number = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(chunks)).cast("int")
    dealt = joined_sequences(df).withColumn(CHUNK, number)
    done = {row[0] for row in manifest(spark, path).select(CHUNK).collect()}
    todo = [c for c in range(chunks) if c not in done]
    size = max(1, -(-chunks // waves))
    written = 0
    for start in range(0, len(todo), size):
        if stop_after is not None and start // size >= stop_after:
            break
        wave = todo[start : start + size]
        (
            dealt.filter(F.col(CHUNK).isin(wave))
            .repartition(len(wave), CHUNK)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("sep", SEPARATOR)
            .option("header", True)
            .option("maxRecordsPerFile", rows_per_file)
            .partitionBy(CHUNK)
            .csv(f"{path}/data")
        )
        entry = _measured(spark, path, wave).withColumn("wave", F.lit(min(wave)))
        entry.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("wave").parquet(f"{path}/manifest")
        written += len(wave)
    return written


def damaged_chunks(spark: SparkSession, path: str, chunks: int) -> list[int]:
    """Chunks whose lines are not those of the manifest, and chunks that are not in it."""
    known = manifest(spark, path)
    now = _measured(spark, path, range(chunks)).select(CHUNK, F.col("n_lines").alias("lines"), F.col("checksum").alias("found"))
    both = now.join(known, CHUNK, "left")
    same = (F.col("lines") == F.col("n_lines")) & (F.col("found") == F.col("checksum"))
    return sorted(row[0] for row in both.filter(~F.coalesce(same, F.lit(False))).select(CHUNK).collect())


def read_export(spark: SparkSession, path: str, schema: T.StructType, chunks: int = 64) -> DataFrame:
    """The exported rows, if every chunk is as it was written."""
    damaged = damaged_chunks(spark, path, chunks)
    if damaged:
        raise DamagedExport(f"chunks {damaged} of {path}")
    return read_delimited(spark, f"{path}/data", schema).drop(CHUNK)

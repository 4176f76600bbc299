"""Pipe-delimited exchange files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wanderbeam.functions import arrays

SEPARATOR = "|"
CHUNK_ROWS = 1_000_000


def joined_sequences(df: DataFrame) -> DataFrame:
    """Array columns as comma-joined text, for sinks that have no arrays."""
    flat = {
        f.name: arrays.to_delimited(F.col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, T.ArrayType)
    }
    return df.withColumns(flat) if flat else df


def write_delimited(df: DataFrame, path: str, rows_per_file: int = CHUNK_ROWS) -> None:
    """One writer per partition, files of at most ``rows_per_file`` rows."""
    (
        joined_sequences(df)
        .write.option("sep", SEPARATOR)
        .option("header", True)
        .option("maxRecordsPerFile", rows_per_file)
        .mode("overwrite")
        .csv(path)
    )


def read_delimited(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read with a given schema: nothing is inferred; array columns are split again."""
    flat = T.StructType(
        [
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.ArrayType) else f.dataType)
            for f in schema.fields
        ]
    )
    rows = (
        spark.read.schema(flat)
        .option("sep", SEPARATOR)
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
    )
    parsed = {
        f.name: arrays.from_delimited(F.col(f.name), f.dataType.elementType.simpleString())
        for f in schema.fields
        if isinstance(f.dataType, T.ArrayType)
    }
    return rows.withColumns(parsed) if parsed else rows

"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}
# Application -> what it has written, and how often that was dropped.
_WRITTEN: dict[str, list[str]] = {}
_DROPS: dict[str, int] = {}


def local_session(name: str = "wanderbeam", cpus: int | str = "*", **conf: str) -> SparkSession:
    """A single-node session for tests and benchmarks; clusters bring their own."""
    width = "8" if cpus == "*" else str(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", width)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Folder for written intermediates.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    every task sees the same disk, may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[context.applicationId] = tempfile.mkdtemp(prefix="run-")
    return _LOCAL_SCRATCH[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_age(spark: SparkSession) -> int:
    """How often this application has dropped its scratch tables; what was stored before is gone."""
    return _DROPS.get(spark.sparkContext.applicationId, 0)


def drop_scratch(spark: SparkSession) -> int:
    """Remove all intermediate tables this application has written; gives their number.

    The job that owns the session calls it when its results are written: frames that were handed out
    before read these tables and can't be used any more.
    """
    name = spark.sparkContext.applicationId
    paths = _WRITTEN.pop(name, [])
    for path in paths:
        found = spark._jvm.org.apache.hadoop.fs.Path(path)
        found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)
    _DROPS[name] = _DROPS.get(name, 0) + 1
    return len(paths)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Cuts the lineage with data that outlives any executor, and pins values that
    would change on a recomputation, such as partition numbers.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

"""New event files to the unified event table.

The batch form of this load is ``event_log.unified_events(..., after=high_water_mark(...))``.
As a stream, the checkpoint remembers which files were loaded, and the events that may still
change are kept by their key: one event whose parameters or copies come in several files is one row.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wanderbeam.operators import event_log

LATENESS = "2 days"


@dataclass(frozen=True)
class EventStore:
    """A loaded event table: folders with one sub-folder per micro-batch, each written as a whole.

    ``held``: the events that were open before the batch, merged with the batch, by key. ``closed``: those of them that
    the watermark has passed; they are final. ``late``: rows that came after their event was closed, and rows
    without a time. ``marks``: the watermark after the batch in microseconds, written last: a batch with a mark is whole.
    """

    spark: SparkSession
    root: str

    def path(self, part: str, batch: int) -> str:
        return f"{self.root}/{part}/batch={batch}"

    def _hadoop(self, path: str):
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.spark._jsc.hadoopConfiguration()), found

    def batches(self) -> list[int]:
        """Numbers of the finished batches, in order."""
        files, folder = self._hadoop(f"{self.root}/marks")
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        numbers = sorted(int(n.removeprefix("batch=")) for n in names if re.fullmatch(r"batch=\d+", n))
        return [n for n in numbers if files.exists(self._hadoop(f"{self.path('marks', n)}/_SUCCESS")[1])]

    def read(self, part: str, batches: list[int]) -> DataFrame:
        return self.spark.read.parquet(*[self.path(part, b) for b in batches])

    def watermark(self, batch: int) -> int | None:
        return self.read("marks", [batch]).first()["watermark"]

    def open(self, batch: int) -> DataFrame:
        """Events that files after ``batch`` may still change."""
        return self.read("held", [batch]).filter(~_passed(self.watermark(batch)))

    def forget(self, batch: int) -> None:
        files, folder = self._hadoop(self.path("held", batch))
        files.delete(folder, True)


def _passed(watermark: int | None) -> Column:
    if watermark is None:
        return F.lit(False)
    return F.col("event_timestamp").cast("timestamp") < F.timestamp_micros(F.lit(watermark))


def _write_batch(store: EventStore, batch: DataFrame, number: int, app_id: str, names: DataFrame, lateness: str) -> None:
    """Merge one micro-batch into the store.

    What is written follows from the rows of the batch and from what the batches before it left, so a
    batch that is run again after a failure leaves the same store.
    """
    before = [b for b in store.batches() if b < number][-1:]
    mark = store.watermark(before[0]) if before else None
    late = F.col("event_timestamp").isNull() | _passed(mark)
    event_log.app_events(batch, app_id).filter(late).write.mode("overwrite").parquet(store.path("late", number))
    fresh = batch.filter(~late)
    flat = event_log.known_events(fresh, app_id, names)
    if before:
        flat = store.open(before[0]).unionByName(flat)
    event_log.merged_events(flat).write.mode("overwrite").parquet(store.path("held", number))
    allowed = F.max("event_timestamp") - F.expr(f"INTERVAL {lateness}")
    latest = fresh.agg(F.unix_micros(allowed.cast("timestamp")).alias("t")).first()["t"]
    watermark = max((t for t in (mark, latest) if t is not None), default=None)
    closed = store.read("held", [number]).filter(_passed(watermark))
    closed.write.mode("overwrite").parquet(store.path("closed", number))
    marks = store.spark.createDataFrame([(watermark,)], "watermark long").coalesce(1)
    marks.write.mode("overwrite").parquet(store.path("marks", number))
    # The batch before is still needed if this one is run again; those before it are not.
    for old in [b for b in store.batches() if b < number][:-1]:
        store.forget(old)


def load_new_events(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: T.StructType,
    app_id: str,
    event_names: DataFrame,
    lateness: str = LATENESS,
) -> EventStore:
    """Merge the files of ``source`` that were not loaded yet into the store at ``target``.

    An event may change until an event more than ``lateness`` newer has been loaded; then it is closed. So the
    state that a batch reads and writes is bounded by the events of ``lateness`` time, and each closed event is written once.
    """
    store = EventStore(spark, target)
    stream = (
        spark.readStream.schema(schema)
        .parquet(source)
        .writeStream.foreachBatch(lambda batch, number: _write_batch(store, batch, number, app_id, event_names, lateness))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
    return store


def loaded_events(store: EventStore, content: Sequence[str] = event_log.EVENT_CONTENT) -> DataFrame:
    """The event table as it stands: closed events and the newest form of the open ones."""
    done = store.batches()
    everything = store.read("closed", done).unionByName(store.open(done[-1]))
    return event_log.in_content(everything, content)


def late_rows(store: EventStore) -> DataFrame:
    """Raw rows that came too late for their event, for whoever has to settle them."""
    return store.read("late", store.batches())

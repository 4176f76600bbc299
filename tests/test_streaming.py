from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_event_log import RAW, event

from wanderbeam.operators import event_log
from wanderbeam.streaming import incremental


@pytest.fixture
def load(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("raw", "table", "state"))
    names = spark.createDataFrame([("open",)], "event_name string")

    def run(*deliveries, lateness="10 minutes"):
        for events in deliveries:
            frame = spark.createDataFrame(events, RAW)
            frame.coalesce(1).write.mode("append").parquet(source)
        return incremental.load_new_events(spark, source, target, checkpoint, spark.createDataFrame([], RAW).schema, "my.app", names, lateness)

    def batch(*deliveries):
        frame = spark.createDataFrame([e for d in deliveries for e in d], RAW)
        return event_log.unified_events(frame, "my.app", names)

    run.batch = batch
    return run


def flat(df):
    return rows(df.select(*event_log.EVENT_KEY, *event_log.EVENT_PARAMS))


def test_only_new_files_are_loaded(load):
    first = [event(1, "open", content_group="ota"), event(2, "noise", content_group="ota")]
    second = [event(0, "open", content_group="ota", hotel_id="9")]
    assert incremental.loaded_events(load(first)).count() == 1
    assert incremental.loaded_events(load()).count() == 1
    assert flat(incremental.loaded_events(load(second))) == flat(load.batch(first, second))


def test_parts_and_copies_in_several_files_are_one_event(load):
    parts = [
        [event(1, "open", content_group="ota"), event(2, "open", hotel_id="7")],
        [event(1, "open", hotel_id="5"), event(1, "open", content_group="ota"), event(8, "open", content_group="ota")],
        [event(2, "open", content_group="ota"), event(1, "open", booking_id="b"), event(8, "open", content_group="ota")],
    ]
    for part in parts:
        store = load(part)
    assert flat(incremental.loaded_events(store)) == flat(load.batch(*parts))
    assert incremental.loaded_events(store).count() == 3
    assert incremental.late_rows(store).count() == 0


def test_closed_events_are_final_and_late_rows_are_kept_apart(load):
    load([event(1, "open", content_group="ota"), event(30, "open", content_group="ota")])
    store = load([event(1, "open", hotel_id="5"), event(25, "open", content_group="ota"), event(60, "open", content_group="ota")])
    assert [r.event_timestamp.minute for r in incremental.late_rows(store).collect()] == [1]
    kept = {r.event_timestamp.minute: r.hotel_id for r in incremental.loaded_events(store).filter(F.col("event_timestamp") < dt.datetime(2024, 1, 1, 0, 59)).collect()}
    assert kept == {1: None, 25: None, 30: None}
    assert store.open(store.batches()[-1]).count() == 1


def test_a_batch_run_again_leaves_the_same_store(load, spark, monkeypatch):
    load([event(1, "open", content_group="ota"), event(30, "open", content_group="ota")])
    write = incremental._write_batch

    def broken(*args):
        write(*args)
        raise RuntimeError("lost after the batch was written")

    monkeypatch.setattr(incremental, "_write_batch", broken)
    more = [event(28, "open", content_group="ota", hotel_id="5"), event(90, "open", content_group="ota")]
    with pytest.raises(Exception, match="lost after"):
        load(more)
    monkeypatch.setattr(incremental, "_write_batch", write)
    store = load()
    assert store.batches() == [0, 1]
    assert sorted(r.event_timestamp.minute for r in incremental.loaded_events(store).collect()) == [1, 28, 30, 30]


def test_rows_without_a_time_go_to_the_late_rows(load):
    untimed = list(event(1, "open", content_group="ota"))
    untimed[1] = None
    store = load([tuple(untimed), event(2, "open", content_group="ota")])
    assert incremental.late_rows(store).count() == 1 and incremental.loaded_events(store).count() == 1

"""Every query against its SQL counterpart, and what the physical plans must (not) hold."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as driver
import compare

from wanderbeam.plans.catalogue import QUERIES
from wanderbeam.plans.oracle import ORACLES
from wanderbeam.operators import behaviour, evaluate, event_log, ids, recommend, sequences, serving
from wanderbeam.plans.domain import Domain

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.database(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert compare.difference(spark, con, name, SF_DIR) is None


def test_all_queries_have_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(QUERIES) <= set(driver.oracle_sql())


def test_entry(spark):
    flagship = driver.entry(spark)
    assert flagship.columns == ["user_id", "sv_playlist"] and flagship.count() > 1


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def domain(spark):
    return Domain(spark, SF_DIR)


def test_top_k_is_cut_before_the_shuffle(domain):
    text = plan(recommend.rank_per_user(domain.predictions(), 10))
    assert "Partial" in text and text.count("WindowGroupLimit") == 2


def test_recent_behaviour_is_cut_before_the_shuffle(domain):
    assert plan(domain.build_behaviour()).count("WindowGroupLimit") == 2


def test_no_task_sees_all_rows(domain):
    events = domain.training()
    for df in (
        sequences.sliding_windows(events, ("hotel_id",)),
        sequences.training_sequences(events, domain.users()),
        ids.dense_ids(domain.events().select("event_id"), ["event_id"], "id").select("id"),
        behaviour.union_events(domain.bookings(), domain.app_events(), domain.event_map()),
        evaluate.holdout(
            domain.run_events(), domain.event_map(), domain.users(), domain.items(), "2024-01-10"
        ),
    ):
        text = plan(df)
        for step in ("SinglePartition", "CartesianProduct", "NestedLoop"):
            assert step not in text


def test_filters_and_columns_reach_the_scan(domain):
    text = recommend.trending(domain.bookings(), domain.items(), "2001-08-01")
    shown = text._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(updated_at" in shown
    narrow = domain.bookings().select(F.col("status"))
    assert "ReadSchema: struct<status:string>" in plan(narrow)


def test_windows_need_one_shuffle(domain):
    assert plan(sequences.sliding_windows(domain.training(), ("hotel_id",))).count("Exchange ") == 1


def test_default_list_is_a_hash_join(domain):
    requests = domain.table("customer").select(F.col("c_custkey").cast("string").alias("user_id"))
    text = plan(serving.playlists_for(requests, domain.playlists()))
    assert text.count("BroadcastHashJoin") == 2 and "NestedLoop" not in text


def test_event_runs_and_holdout_sort_once_per_key(domain):
    runs = plan(event_log.event_runs(domain.unified_events()))
    assert runs.count("Exchange hashpartitioning(uid") == 1
    held = evaluate.holdout(
        domain.run_events(), domain.event_map(), domain.users(), domain.items(), "2024-01-10"
    )
    assert plan(held).count("Exchange hashpartitioning(user_id") == 1

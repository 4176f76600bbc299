"""Seconds per query on one node. Prints one JSON line.

The stored tables (bookings, events, dimensions, training events) are built first; their seconds
count in the total and stand by table in ``setup``. Every query then runs in full.
"""

from __future__ import annotations

import json
import os
import sys
import time

from wanderbeam.plans.catalogue import QUERIES
from wanderbeam.plans.domain import Domain
from wanderbeam.session import drop_scratch, local_session

HEADLINE = [
    "user_dim",
    "item_dim",
    "event_runs",
    "training_events",
    "upstream_report",
    "recent_behaviour",
    "training_sequences",
    "hash_split",
    "candidates",
    "score_empirical",
    "trending",
    "playlist",
    "serving_profile",
    "serve_requests",
    "holdout",
    "hits_at_n",
    "ml_score",
]


def consume(df) -> None:
    """Run the whole plan and keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cpus)
    domain = Domain(spark, sf_dir)
    setup = {}
    for stored in (
        domain.booking_documents,
        domain.event_documents,
        domain.raw_events,
        domain.unified_events,
        domain.existing_users,
        domain.users,
        domain.items,
        domain.event_runs,
        domain.training,
        domain.behaviour,
        domain.predictions,
        domain.offers,
        domain.playlists,
    ):
        start = time.perf_counter()
        stored()
        setup[stored.__name__] = round(time.perf_counter() - start, 3)
    seconds = {}
    for name in names:
        start = time.perf_counter()
        consume(QUERIES[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - start, 3)
    drop_scratch(spark)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()) + sum(setup.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "setup": setup,
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()

from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wanderbeam.session import drop_scratch, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8, spark__sql__shuffle__partitions="3")
    yield session
    drop_scratch(session)
    session.stop()


def at(minute: int) -> dt.datetime:
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


def rows(df, *columns):
    """Rows as plain tuples, sorted."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)

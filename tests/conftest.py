from __future__ import annotations

import os
import sys
import tempfile
import uuid

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fleetlens.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
TABLES = ["events"]


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(scope="session")
def spark(scratch):
    s = build_session(
        "local[4]",
        app_name="fleetlens-tests",
        shuffle_partitions=8,
        checkpoint_dir=os.path.join(scratch, "checkpoints"),  # only used when unset
    )
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


@pytest.fixture(autouse=True)
def few_state_stores(monkeypatch):
    from fleetlens.streaming import replay

    monkeypatch.setattr(replay, "STATE_PARTITIONS", 2)


@pytest.fixture
def run_id():
    return "t" + uuid.uuid4().hex[:10]

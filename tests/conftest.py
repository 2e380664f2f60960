from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

from orderloom.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        app="orderloom-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return SF_DIR


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def put(key: str, value: str) -> None:
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="session")
def plan_text():
    return plan_of


@pytest.fixture
def events(spark):
    """A small event log with every fault a real one has."""
    rows = [
        # order A: complete, its first event twice
        ("A-0", "order_created", "2024-01-06T10:00:00", 1, "A", 0, '{"brand_id": 1, "total": 10.5}'),
        ("A-0", "order_created", "2024-01-06T10:00:05", 1, "A", 0, '{"brand_id": 1, "total": 10.5}'),
        ("A-1", "kitchen_started", "2024-01-06T10:02:00", 1, "A", 1, '{"kitchen_id": 7}'),
        ("A-2", "kitchen_finished", "2024-01-06T10:12:30", 1, "A", 2, "{}"),
        ("A-3", "order_ready", "2024-01-06T10:13:00", 1, "A", 3, "{}"),
        ("A-4", "driver_arrived", "2024-01-06T10:15:00", 1, "A", 4, '{"driver_id": "D1"}'),
        ("A-5", "driver_picked_up", "2024-01-06T10:16:00", 1, "A", 5, "{}"),
        ("A-6", "driver_ping", "2024-01-06T10:20:00", 1, "A", 6, '{"lat": 1.5, "lon": 2.5}'),
        ("A-7", "delivered", "2024-01-06T10:31:00", 1, "A", 7, "{}"),
        # order B: its location is lost on the last event, so it falls in two
        ("B-0", "order_created", "2024-01-08T11:00:00", 2, "B", 0, '{"brand_id": 2, "total": 20.0}'),
        ("B-1", "delivered", "2024-01-08T11:40:00", None, "B", 1, "{}"),
        # order C: body cut off; order D: body without its closing brace; order E: bad field only
        ("C-0", "order_created", "2024-01-08T11:30:00", 2, "C", 0, '{"brand_id": 2, "tot'),
        ("D-0", "order_created", "2024-01-08T11:31:00", 9, "D", 0, '{"brand_id": 2, "total": 5.0'),
        ("E-0", "order_created", "2024-01-08T11:32:00", 2, "E", 0, '{"brand_id": 2, "total": "x"}'),
        # no order id, no event id
        ("F-0", "order_created", "2024-01-08T11:33:00", 2, None, 0, '{"brand_id": 2, "total": 7.0}'),
        (None, "order_created", "2024-01-08T11:34:00", 2, "G", 0, '{"brand_id": 2, "total": 8.0}'),
    ]
    schema = (
        "event_id string, event_type string, ts string, location_id int, order_id string, "
        "sequence int, body string"
    )
    log = spark.createDataFrame(rows, schema)
    return log.selectExpr("*", "unix_timestamp(to_timestamp(ts)) AS ts_seconds")


@pytest.fixture
def places(spark, tmp_path):
    """Stored, so that its size is known."""
    path = str(tmp_path / "places")
    spark.createDataFrame([(1, "Lyon"), (2, "Turin")], "id long, city string").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def brands(spark):
    return spark.createDataFrame([(1, "Noodles"), (2, "Pies"), (3, "Unused")], "id long, name string")

from __future__ import annotations

import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tripgauge.schema import TELEMETRY  # noqa: E402
from tripgauge.session import build_session  # noqa: E402

START = datetime(2026, 5, 6, 14, 0, 0)


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def telemetry(spark):
    """Build telemetry from ``(trip_id, seconds, speed)`` or with ``lat, lon`` added;
    ``seq`` counts from 1 unless given as a sixth value."""

    def build(rows, start=START):
        full = []
        for i, row in enumerate(rows, 1):
            trip, seconds, speed, lat, lon, seq = (*row, *(-12.0, -77.0, i)[len(row) - 3:])
            when = None if seconds is None else start + timedelta(seconds=seconds)
            full.append((trip, when, lat, lon, speed, when, seq))
        return spark.createDataFrame(full, TELEMETRY)

    return build


@pytest.fixture(scope="session")
def golden(telemetry):
    return telemetry([
        ("T1", 0.0, 80.0, -12.0464, -77.0428),
        ("T1", 1.0, 95.0, -12.0470, -77.0431),
        ("T1", 1.5, 200.0, 91.0, -77.0433),
        ("T1", 2.0, 70.0, -12.0475, -77.0436),
        ("T1", 2.5, 90.0, -12.0479, -77.0440),
        ("T1", 3.5, 78.0, -12.0483, -77.0445),
        ("T2", 0.0, 60.0, -12.1, -77.1),
        ("T2", 10.0, 60.0, -12.1, -77.2),
    ])


def by_key(df, key="trip_id"):
    return {row[key]: row for row in df.collect()}

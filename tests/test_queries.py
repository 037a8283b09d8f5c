"""Every registered query against its SQL, and reads that SQL does not cover."""

from __future__ import annotations

import json

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry
from tripgauge.plans import serving
from tripgauge.plans.trip_report import trip_reports

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 15 and "risk_score" in df.columns


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql().get(name)
    assert (compare(df, duck, sql) if sql else [] if df.count() else ["no rows"]) == []


def test_json_document(golden):
    reports = trip_reports(golden)
    documents = {r.trip_id: json.loads(r.document) for r in serving.report_json(reports).collect()}
    assert list(documents["T1"]) == reports.columns
    assert documents["T1"]["risk"]["weights"] == {"speeding": 0.35, "variance": 0.4, "braking": 0.25}
    assert documents["T1"]["analyzed_at"].startswith("20") and "T" in documents["T1"]["analyzed_at"]
    assert documents["T2"]["points"][1] == {"speed": 60.0, "accel": 0.0, "time": "2026-05-06 14:00:10"}


def test_series_and_logs(golden):
    reports = serving.for_trip(trip_reports(golden), "T1")
    series = serving.speed_series(reports).orderBy("idx").collect()
    assert [(r.name, r.speed, r.accel) for r in series][:3] == [
        ("14:00:00", 80.0, 0.0), ("14:00:01", 95.0, 4.17), ("14:00:02", 70.0, -6.94),
    ]
    lines = [r.text for r in serving.sample_log(reports).orderBy("line").collect()]
    assert lines[0] == "[2026-05-06 14:00:03.5] [OK] VEL: 78.0 km/h | ACEL: -3.33 m/s²"
    lineage = [r.text for r in serving.lineage_log(reports).orderBy("line").collect()]
    assert len(lineage) == 5 and "[INFO] MOTOR_PROCESAMIENTO: Spark" in lineage[0]

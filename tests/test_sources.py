"""Reading and writing telemetry, audit rows and reports."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripgauge.operators.quality import EmptyInputError
from tripgauge.plans.fleet_report import build_fleet_report
from tripgauge.plans.runs import run_fleet, run_trips
from tripgauge.plans.trip_report import scored_trips
from tripgauge.sources.sinks import append_audit, append_report, read_audit, read_reports
from tripgauge.operators.quality import dedup_lww
from tripgauge.sources.telemetry import append_telemetry, normalize, read_csv, read_telemetry, write_clustered

CSV = """id_viaje,tiempo,velocidad_kmh
T1,2026-05-06 14:00:39.165+0000,80.5
T1,2026-05-06 14:00:40.165+0000,
T2,2026-05-06 09:00:39.000-0500,60
"""


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "telemetry.csv"
    path.write_text(CSV)
    return str(path)


@pytest.mark.parametrize("infer", [False, True])
def test_csv(spark, csv_file, infer):
    rows = read_csv(spark, csv_file, infer=infer).orderBy("seq").collect()
    assert [(r.trip_id, r.event_time, r.speed_kmh) for r in rows] == [
        ("T1", datetime(2026, 5, 6, 14, 0, 39, 165000), 80.5),
        ("T1", datetime(2026, 5, 6, 14, 0, 40, 165000), None),
        ("T2", datetime(2026, 5, 6, 14, 0, 39), 60.0),
    ]
    assert rows[0].lat is None


def test_csv_goes_by_the_names_in_the_header(spark, tmp_path):
    path = tmp_path / "other.csv"
    path.write_text("velocidad_kmh,latitud,id_viaje,tiempo,note\n80.5,-12.5,T1,2026-05-06 14:00:00.000+0000,x\n")
    row = read_csv(spark, str(path)).head()
    assert (row.trip_id, row.speed_kmh, row.lat, row.note, row.event_time.hour) == ("T1", 80.5, -12.5, "x", 14)
    path.write_text("velocidad_kmh,tiempo\n80.5,2026-05-06 14:00:00\n")
    with pytest.raises(ValueError, match="id_viaje"):
        read_csv(spark, str(path))


def test_two_appends_keep_the_later_write(spark, telemetry, tmp_path):
    for speed in (50.0, 99.0):
        rows = telemetry([("A", 0, speed)]).drop("seq", "ingested_at")
        append_telemetry(normalize(rows), str(tmp_path / "t"))
    assert dedup_lww(read_telemetry(spark, "parquet", str(tmp_path / "t"))).head().speed_kmh == 99.0


def test_csv_missing(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nowhere.csv"):
        read_csv(spark, str(tmp_path / "nowhere.csv"))


def test_csv_feeds_the_fleet_report(spark, csv_file):
    report = build_fleet_report(read_csv(spark, csv_file)).head()
    assert (report.basic.samples, report.basic.avg_speed_kmh) == (3, 70.25)


def test_normalize(spark):
    external = spark.createDataFrame([("A", 1.0, 2.0, 3.0)], "id_viaje string, latitud double, longitud double, velocidad double")
    row = normalize(external).head()
    assert (row.trip_id, row.lat, row.lon, row.speed_kmh, row.event_time) == ("A", 1.0, 2.0, 3.0, None)


def test_store_round_trip(spark, golden, tmp_path):
    path = str(tmp_path / "store")
    append_telemetry(golden, path)
    append_telemetry(golden.withColumn("seq", F.col("seq") + 100), path)
    stored = read_telemetry(spark, "parquet", path)
    assert stored.count() == 16
    assert stored.filter("ingested_at IS NULL OR ingested_at < timestamp'2026-06-01'").count() == 0


def test_clustered_layout(spark, golden, tmp_path):
    path = str(tmp_path / "clustered")
    write_clustered(golden.repartition(5), path, partitions=3)
    stored = spark.read.parquet(path)
    assert stored.exceptAll(golden.select(*stored.columns)).isEmpty() and stored.count() == 8
    # Files hold consecutive ranges, also of a single trip.
    spans = stored.groupBy(F.input_file_name().alias("f")).agg(
        F.min(F.struct("trip_id", "event_time", "seq")).alias("lo"), F.max(F.struct("trip_id", "event_time", "seq")).alias("hi")
    ).orderBy("lo").collect()
    assert len(spans) > 1 and all(tuple(a.hi) < tuple(b.lo) for a, b in zip(spans, spans[1:]))


def test_audit_grows_by_one_row_per_trip_and_run(spark, golden, tmp_path):
    path = str(tmp_path / "audit")
    for run in ("r1", "r2"):
        append_audit(scored_trips(golden), path, run)
    append_audit(scored_trips(golden), path, "r2")
    rows = read_audit(spark, path)
    assert rows.count() == 4
    assert {(r.trip_id, r.run_id) for r in rows.collect()} == {(t, r) for t in ("T1", "T2") for r in ("r1", "r2")}
    assert rows.filter("run_at IS NULL").isEmpty()


def test_fleet_reports_append(spark, golden, tmp_path):
    path = str(tmp_path / "fleet")
    ids = [append_report(build_fleet_report(golden), path) for _ in range(2)]
    assert {r.report_id for r in spark.read.parquet(path).collect()} == set(ids) and len(set(ids)) == 2


def test_run_trips(spark, golden, tmp_path):
    audit, reports = str(tmp_path / "audit"), str(tmp_path / "reports")
    assert run_trips(golden.filter("seq <= 4"), audit, reports, 1)
    again = golden.unionByName(golden.filter("seq = 8"))
    assert run_trips(again, audit, reports, 2)
    assert not run_trips(golden.limit(0), audit, reports, 3)
    stored = {r.trip_id: (r.basic.samples, r.risk.score, r.created_seq, r.batch_id) for r in read_reports(spark, reports).collect()}
    assert stored == {"T1": (5, 35.47, 1, 2), "T2": (2, 0.0, 2, 2)}
    assert spark.read.parquet(audit).count() == 3


def test_run_fleet(spark, csv_file, tmp_path):
    target = str(tmp_path / "fleet")
    report_id = run_fleet(spark, csv_file, target)
    assert spark.read.parquet(target).head().report_id == report_id
    empty = tmp_path / "empty.csv"
    empty.write_text("id_viaje,tiempo,velocidad_kmh\n")
    with pytest.raises(EmptyInputError):
        run_fleet(spark, str(empty), target)

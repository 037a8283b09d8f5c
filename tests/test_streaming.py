"""Streams give what batches give, also when batches repeat or cycles fail."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta, timezone

import pytest
from conftest import by_key
from pyspark.sql import functions as F

from tripgauge.plans.trip_report import scored_trips
from tripgauge.schema import TELEMETRY
from tripgauge.streaming.cycle import Cycle, run_cycle, start_cycle
from tripgauge.streaming.feed import report_feed, start_feed
from tripgauge.streaming.incremental import incremental_metrics, start_incremental, state_log, state_metrics

COLUMNS = ["samples", "speeding_alerts", "hard_brakes", "score"]


def files(df, path, order):
    """Each of ``order``'s seq lists as one file, in that order of arrival."""
    for i, seqs in enumerate(order):
        df.filter(F.col("seq").isin(seqs)).coalesce(1).write.parquet(f"{path}/{i:03d}")


def stream(spark, path):
    return (spark.readStream.schema(TELEMETRY).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", True).parquet(str(path)))


def summary(reports):
    return {r.trip_id: (r.basic.samples, r.basic.speeding_alerts, r.risk.hard_brakes, r.risk.score)
            for r in reports.collect()}


def expected(df):
    return {r.trip_id: (r.samples, r.speeding_alerts, r.hard_brakes, r.risk_score) for r in scored_trips(df).collect()}


def test_shuffled_stream_equals_batch(spark, golden, tmp_path):
    seqs = list(range(1, 9))
    random.Random(5).shuffle(seqs)
    files(golden, tmp_path / "in", [seqs[i:i + 2] for i in range(0, 8, 2)])
    cycle = Cycle(str(tmp_path / "out"), ttl_seconds=None, on_error="raise")
    checkpoint = str(tmp_path / "checkpoint")
    start_cycle(stream(spark, tmp_path / "in"), cycle, checkpoint, None).awaitTermination()
    assert summary(cycle.reports(spark).latest()) == expected(golden)
    audits = cycle.audit(spark).count()
    assert audits >= 5
    # A restart with nothing new adds nothing.
    start_cycle(stream(spark, tmp_path / "in"), cycle, checkpoint, None).awaitTermination()
    assert cycle.audit(spark).count() == audits
    # A repeated batch replaces its own rows.
    last = cycle.reports(spark).history().agg(F.max("batch_id")).head()[0]
    run_cycle(golden.filter(F.col("seq").isin(seqs[6:])), cycle, last)
    assert cycle.audit(spark).count() == audits
    assert summary(cycle.reports(spark).latest()) == expected(golden)


def test_retention(spark, telemetry, tmp_path):
    df = telemetry([("A", 0, 100.0), ("A", 300, 95.0), ("A", 700, 20.0), ("B", 10, 20.0)])
    cycle = Cycle(str(tmp_path), clock="data", on_error="raise")
    run_cycle(df.filter("seq != 3"), cycle, 0)
    assert summary(cycle.reports(spark).latest())["A"][0] == 2
    run_cycle(df.filter("seq = 3"), cycle, 1)
    reports = {r.trip_id: (r.basic.samples, r.batch_id) for r in cycle.reports(spark).latest().collect()}
    # The first sample of A and all of B have expired; B's last report stays.
    assert reports == {"A": (2, 1), "B": (1, 0)}


def test_wall_clock_drops_old_arrivals(spark, telemetry, tmp_path):
    cycle = Cycle(str(tmp_path), on_error="raise")
    run_cycle(telemetry([("A", 0, 1.0)]), cycle, 0)
    assert cycle.reports(spark).latest().count() == 0
    run_cycle(telemetry([("A", 0, 1.0)], datetime.now(timezone.utc).replace(tzinfo=None) - timedelta(seconds=5)), cycle, 1)
    assert cycle.reports(spark).latest().count() == 1


def test_maintenance_keeps_results(spark, telemetry, tmp_path):
    cycle = Cycle(str(tmp_path), clock="data", maintain_every=2, on_error="raise")
    for i in range(5):
        run_cycle(telemetry([("A", 600 * i, 50.0, -12.0, -77.0, i), (f"B{i}", 600 * i, 50.0, -12.0, -77.0, i)]), cycle, i)
    reports = {r.trip_id: (r.basic.samples, r.batch_id, r.created_seq) for r in cycle.reports(spark).latest().collect()}
    assert reports == {"A": (1, 4, 0), **{f"B{i}": (1, i, i) for i in range(5)}}
    # Folded up to batch 2 after batch 4; samples older than ten minutes are gone.
    assert sorted({r.batch_id for r in cycle.reports(spark).history().collect()}) == [3, 4]
    assert sorted({r.batch_id for r in cycle.samples(spark).all().collect()}) == [3, 4]


def test_batch_scope(spark, telemetry, tmp_path):
    cycle = Cycle(str(tmp_path), ttl_seconds=None, scope="batch", on_error="raise")
    run_cycle(telemetry([("A", 0, 1.0), ("B", 0, 1.0)]), cycle, 0)
    run_cycle(telemetry([("A", 1, 1.0, -12.0, -77.0, 9)]), cycle, 1)
    got = {(r.trip_id, r.run_id) for r in cycle.audit(spark).collect()}
    assert got == {("A", "0"), ("B", "0"), ("A", "1")}


def test_failed_cycle_is_caught_up(spark, golden, tmp_path, monkeypatch):
    cycle = Cycle(str(tmp_path), ttl_seconds=None)
    with monkeypatch.context() as broken:
        broken.setattr("tripgauge.streaming.cycle.scored_trips", lambda *a, **k: 1 / 0)
        run_cycle(golden.filter("seq <= 4"), cycle, 0)
        with pytest.raises(ZeroDivisionError):
            run_cycle(golden.filter("seq <= 4"), Cycle(str(tmp_path), ttl_seconds=None, on_error="raise"), 0)
    assert cycle.reports(spark).latest().count() == 0
    run_cycle(golden.filter("seq > 4"), cycle, 1)
    assert summary(cycle.reports(spark).latest()) == expected(golden)


def test_empty_cycle_writes_nothing(spark, telemetry, tmp_path):
    cycle = Cycle(str(tmp_path), ttl_seconds=None, on_error="raise")
    run_cycle(telemetry([]), cycle, 0)
    assert cycle.reports(spark).history().count() == 0


def test_incremental_equals_batch_in_order(spark, golden, tmp_path):
    files(golden, tmp_path / "in", [[1, 2], [3, 4, 7], [5], [6, 8]])
    log = state_log(spark, str(tmp_path / "state"))
    start_incremental(stream(spark, tmp_path / "in"), log, str(tmp_path / "checkpoint")).awaitTermination()
    got = by_key(state_metrics(log.latest()))
    want = by_key(scored_trips(golden))
    for trip, row in want.items():
        for field, value in row.asDict().items():
            assert got[trip][field] == pytest.approx(value), (trip, field)
    out = incremental_metrics(log).writeStream.format("memory").queryName("metrics_out").trigger(availableNow=True).start()
    out.awaitTermination()
    assert spark.table("metrics_out").count() == log.history().count()


def test_feed(spark, golden, tmp_path):
    cycle = Cycle(str(tmp_path), ttl_seconds=None, on_error="raise")
    run_cycle(golden.filter("seq <= 4"), cycle, 0)
    run_cycle(golden.filter("seq > 4"), cycle, 1)
    log = cycle.reports(spark)
    out = report_feed(log).writeStream.format("memory").queryName("feed_out").trigger(availableNow=True).start()
    out.awaitTermination()
    rows = spark.table("feed_out").collect()
    assert {r.event for r in rows} == {"pipeline_update"} and len(rows) == log.history().count()
    assert {json.loads(r.data)["trip_id"] for r in rows} == {"T1", "T2"}


def test_polled_feed(spark, golden, tmp_path):
    cycle = Cycle(str(tmp_path / "out"), ttl_seconds=None, on_error="raise")
    run_cycle(golden, cycle, 0)
    for trip, event in (("T1", "pipeline_update"), ("T9", "ping")):
        target = str(tmp_path / trip)
        query = start_feed(spark, cycle.reports(spark), trip, target, f"{target}-checkpoint")
        try:
            for _ in range(60):
                query.awaitTermination(1)
                if query.lastProgress and query.lastProgress["batchId"] >= 1:
                    break
        finally:
            query.stop()
        emitted = spark.read.option("basePath", target).json(f"{target}/batch_id=0").collect()
        assert [r.event for r in emitted] == [event]

"""Keyed state gives what batches give, and tells of silence by timer."""

from __future__ import annotations

import math
import time
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from conftest import by_key
from pyspark.sql import functions as F

from tripgauge.operators.quality import dedup_lww
from tripgauge.plans.trip_report import scored_trips
from tripgauge.profiles import CURRENT
from tripgauge.schema import TELEMETRY
from tripgauge.streaming.cycle import Cycle, run_cycle
from tripgauge.streaming.incremental import state_metrics
from tripgauge.streaming.keyed_state import (
    accelerations,
    metric_log,
    start_carried,
    start_events,
    start_live,
    start_summaries,
)

START = datetime(2026, 5, 6, 14, 0, 0)
COLUMNS = ["samples", "avg_speed_kmh", "max_speed_kmh", "speeding_alerts", "accel_variance", "hard_brakes", "risk_score"]


def same(got, want):
    got, want = by_key(got), by_key(want)
    assert set(got) == set(want)
    for trip, row in want.items():
        for c in COLUMNS:
            a, b = got[trip][c], row[c]
            close = a == b or None not in (a, b) and (math.isnan(a) and math.isnan(b) or math.isclose(a, b, abs_tol=1e-6))
            # A null and a NaN mean or maximum are told apart by the batch operators only.
            assert close or c.endswith("kmh") and {a, b} <= {None, b} and math.isnan(b or math.nan), (trip, c, a, b)


def rows():
    """Two trips over several slots, late and rewritten samples, odd speeds and positions."""
    r = np.random.default_rng(2)
    found = []
    for trip in ("A", "B", None):
        for i in range(120):
            when = START + timedelta(seconds=float(i * 2.5))
            speed = None if i % 31 == 5 else float(r.uniform(40, 110))
            lat = 91.0 if i % 17 == 3 else -12.0
            found.append((trip, when, lat, -77.0, speed, when, i))
            if i % 13 == 0:  # the same moment, written again later
                found.append((trip, when, -12.0, -77.0, 55.0, when + timedelta(seconds=400), 1000 + i))
    return found


def landed(spark, path, parts):
    for part in parts:
        spark.createDataFrame(part, TELEMETRY).write.mode("append").parquet(str(path))
        yield spark.readStream.schema(TELEMETRY).parquet(str(path))


def test_late_and_rewritten_samples_in_state(spark, tmp_path):
    given = rows()
    order = np.random.default_rng(7).permutation(len(given))
    parts = [[given[i] for i in order[k::3]] for k in range(3)]
    log = metric_log(spark, str(tmp_path / "log"))
    for samples in landed(spark, tmp_path / "in", parts):
        start_live(samples, log, str(tmp_path / "checkpoint"), ttl_seconds=None).awaitTermination()
    want = scored_trips(dedup_lww(spark.createDataFrame(given, TELEMETRY)))
    same(state_metrics(log.latest()), want)
    # A batch of one late sample reads the slot it falls into, and changes its trip alone.
    late = [("A", START + timedelta(seconds=31), -12.0, -77.0, 70.0, START + timedelta(seconds=999), 5000)]
    for samples in landed(spark, tmp_path / "in", [late]):
        start_live(samples, log, str(tmp_path / "checkpoint"), ttl_seconds=None).awaitTermination()
    last = log.history().filter(F.col("batch_id") == 3).collect()
    assert [r["trip_id"] for r in last] == ["A"] and 0 < last[0]["rows_read"] <= 24
    same(state_metrics(log.latest()), scored_trips(dedup_lww(spark.createDataFrame(given + late, TELEMETRY))))


def test_samples_expire_from_state(spark, tmp_path):
    given = [r for r in rows() if r[6] < 1000]
    parts = [given[:150], given[150:], [("C", START + timedelta(seconds=350), -12.0, -77.0, 60.0, START + timedelta(seconds=350), 1)]]
    log = metric_log(spark, str(tmp_path / "log"))
    for samples in landed(spark, tmp_path / "in", parts):
        start_live(samples, log, str(tmp_path / "checkpoint"), ttl_seconds=200).awaitTermination()
    live = [r for part in parts for r in part if r[5] > START + timedelta(seconds=150)]
    same(state_metrics(log.latest()).filter("samples > 0"), scored_trips(spark.createDataFrame(live, TELEMETRY)))


def test_carried_sums_equal_the_batch(spark, tmp_path):
    given = [r for r in rows() if r[6] < 1000]
    parts = [[r for r in given if r[6] // 40 == k] for k in range(3)]
    log = metric_log(spark, str(tmp_path / "log"))
    for samples in landed(spark, tmp_path / "in", parts):
        start_summaries(samples, str(tmp_path), str(tmp_path / "one")).awaitTermination()
        start_carried(spark, str(tmp_path), log, str(tmp_path / "two")).awaitTermination()
    same(state_metrics(log.latest()), scored_trips(spark.createDataFrame(given, TELEMETRY)))
    # A batch without a trip leaves it alone.
    more = [("A", START + timedelta(seconds=900), -12.0, -77.0, 70.0, START, 9000)]
    for samples in landed(spark, tmp_path / "in", [more]):
        start_summaries(samples, str(tmp_path), str(tmp_path / "one")).awaitTermination()
        start_carried(spark, str(tmp_path), log, str(tmp_path / "two")).awaitTermination()
    newest = log.history().agg(F.max("batch_id")).head()[0]
    assert [r["trip_id"] for r in log.history().filter(F.col("batch_id") == newest).collect()] == ["A"]
    same(state_metrics(log.latest()), scored_trips(spark.createDataFrame(given + more, TELEMETRY)))


def test_changes_are_told_and_silence_by_timer(spark, golden, tmp_path):
    cycle = Cycle(str(tmp_path / "cycle"), ttl_seconds=None, on_error="raise")
    for i in range(2):  # the second run changes nothing
        run_cycle(golden, cycle, i)
    target, checkpoint = str(tmp_path / "events"), str(tmp_path / "checkpoint")
    start_events(cycle.reports(spark), target, checkpoint, seconds=2).awaitTermination()

    def emitted():
        return spark.read.schema("trip_id string, event string, data string").json(target).collect()

    assert sorted((r["trip_id"], r["event"]) for r in emitted()) == [("T1", "pipeline_update"), ("T2", "pipeline_update")]
    query = start_events(cycle.reports(spark), target, checkpoint, seconds=2, interval="1 second")
    run_cycle(golden, cycle, 2)
    try:
        end = time.time() + 60
        while time.time() < end and sum(r["event"] == "ping" for r in emitted()) < 2:
            time.sleep(1)
    finally:
        query.stop()
    assert sum(r["event"] == "pipeline_update" for r in emitted()) == 2
    assert {(r["trip_id"], r["data"]) for r in emitted() if r["event"] == "ping"} == {("T1", None), ("T2", None)}


@pytest.mark.parametrize("speeds", [(80.0, 63.8), (90.0, 9.0), (50.0, math.nan), (math.nan, 50.0)])
def test_acceleration_is_that_of_the_columns(spark, speeds):
    one, two = START, START + timedelta(seconds=1)
    found = accelerations(
        np.array([1_000_000, 5, -(2**63)]), np.array([speeds[1]] * 3), np.array([0, 5, 0]), np.array([speeds[0]] * 3), CURRENT
    )
    data = [("T", one, 0.0, 0.0, speeds[0], one, 1), ("T", two, 0.0, 0.0, speeds[1], two, 2)]
    from tripgauge.plans.trip_report import enriched_samples

    want = enriched_samples(spark.createDataFrame(data, TELEMETRY), CURRENT).filter("seq = 2").head()["accel"]
    assert found.tolist() == [want, 0.0, 0.0]


class Kept:
    """State in a dictionary, counting how often it is asked."""

    def __init__(self):
        self.values, self.calls = {}, 0

    def getValue(self, key):
        self.calls += 1
        return self.values.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self.values[key] = value

    def removeKey(self, key):
        del self.values[key]

    def exists(self):
        return () in self.values

    def get(self):
        return self.values[()]

    def update(self, value):
        self.values[()] = value

    def clear(self):
        self.values.clear()


class Kind:
    def __init__(self):
        self.kept = {}

    def getMapState(self, name, *_):
        return self.kept.setdefault(name, Kept())

    getValueState = getMapState


def test_trips_of_a_cell_share_the_calls_for_a_slot():
    from tripgauge.streaming.keyed_state import LiveTrips

    trips, times = 200, 30
    r = np.random.default_rng(3)
    given = pd.DataFrame({
        "trip_id": np.repeat([f"T{i}" for i in range(trips - 1)] + [None], times),
        "t": np.tile(np.arange(times) * 20_000_000, trips), "seq": np.arange(trips * times), "at": 0,
        "v": r.uniform(40, 110, trips * times), "known": True, "inside": r.random(trips * times) > 0.1,
    })
    together, states = LiveTrips(CURRENT, False), Kind()
    together.init(states)
    late = r.random(len(given)) > 0.5
    for part in (given[late], given[~late]):
        (got,) = together.handleInputRows((1,), iter([part]), None)
    # Ten minutes, put twice and read once; each trip's own value is read and put twice.
    assert states.kept["samples"].calls == 30 and states.kept["heads"].calls == 4 * trips
    for i, (trip, own) in enumerate(given.groupby("trip_id", dropna=False, sort=False)):
        if i % 20 and i != trips - 1:
            continue
        alone = LiveTrips(CURRENT, False)
        alone.init(Kind())
        (want,) = alone.handleInputRows((1,), iter([own]), None)
        row = got[got["trip_id"].isna()] if own["trip_id"].isna().all() else got[got["trip_id"] == trip]
        for c in want.columns.difference(["trip_id", "rows_read", "version"]):
            assert math.isclose(row[c].iloc[0], want[c].iloc[0], abs_tol=1e-6), (trip, c)

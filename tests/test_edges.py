"""Boundaries, missing values and empty input."""

from __future__ import annotations

import dataclasses
import math
import random

import pytest
from conftest import by_key
from pyspark.sql import functions as F

from tripgauge.functions.columns import accel_band, gauge_angle, percent_share, risk_band
from tripgauge.operators.kinematics import kinematics
from tripgauge.operators.metrics import last_points
from tripgauge.operators.quality import (
    EmptyInputError,
    dedup_lww,
    dedup_whole_trips,
    filter_coordinates,
    require_rows,
    retain,
)
from tripgauge.operators.scoring import risk_score
from tripgauge.plans.trip_report import enriched_samples, scored_trips, trip_reports
from tripgauge.profiles import CURRENT, LEGACY


def test_weights_must_sum_to_one():
    with pytest.raises(ValueError):
        dataclasses.replace(CURRENT, weight_speeding=0.36)
    dataclasses.replace(CURRENT, weight_speeding=0.35 + 5e-10)


def test_one_sample_trip(telemetry):
    trip = scored_trips(telemetry([("A", 0, 50.0)])).head()
    assert (trip.samples, trip.accel_variance, trip.risk_score) == (1, 0.0, 0.0)


def test_duplicate_keys(telemetry):
    df = telemetry([("A", 0, 50.0), ("A", 1, 60.0), ("A", 1, 70.0)])
    kept = dedup_lww(df).orderBy("seq").collect()
    assert [(r.seq, r.speed_kmh) for r in kept] == [(1, 50.0), (3, 70.0)]
    # Without removal the second of the pair follows in no time at all.
    assert [r.accel for r in kinematics(df, LEGACY).orderBy("seq").collect()] == [0.0, 10.0, 0.0]


def test_the_later_write_wins_whatever_its_sequence(telemetry):
    from pyspark.sql import functions as F

    df = telemetry([("A", 0, 50.0, -12.0, -77.0, 9)])
    later = telemetry([("A", 0, 99.0, -12.0, -77.0, 1)]).withColumn(
        "ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 SECOND"))
    assert dedup_lww(df.unionByName(later)).head().speed_kmh == 99.0
    batches = df.withColumn("batch_id", F.lit(1)).unionByName(
        later.withColumns({"batch_id": F.lit(2), "ingested_at": F.col("ingested_at") - F.expr("INTERVAL 1 SECOND")}))
    assert dedup_lww(batches).head().speed_kmh == 99.0
    for column in ("seq", "ingested_at"):
        bare = df.withColumn(column, F.lit(None).cast(df.schema[column].dataType))
        kept = dedup_lww(bare).head()
        assert (kept.speed_kmh, kept.lat, kept[column]) == (50.0, -12.0, None)


def test_dedup_keeps_nulls_of_the_winner(telemetry):
    df = telemetry([("A", 0, 50.0), ("A", 0, None)])
    assert dedup_lww(df).head().speed_kmh is None


def test_whole_trips_lose_the_same_copies(telemetry):
    r = random.Random(3)
    rows = []
    for i in range(400):
        trip, second = r.choice(["A", "B", None]), r.choice([None, *range(12)])
        rows.append((trip, second, float(i), -12.0, -77.0, r.choice([None, i, i % 7])))
    df = telemetry(rows).withColumns({
        "batch_id": F.col("speed_kmh").cast("long") % 5,
        "ingested_at": F.when(F.col("speed_kmh") % 3 != 0, F.col("ingested_at")),
    }).dropDuplicates(["trip_id", "event_time", "ingested_at", "batch_id", "seq"]).cache()
    for given in (df, df.drop("batch_id").dropDuplicates(["trip_id", "event_time", "ingested_at", "seq"]).cache()):
        want = sorted(map(repr, dedup_lww(given).collect()))
        assert len(want) < given.count() * 0.7
        assert sorted(map(repr, dedup_whole_trips(given).collect())) == want
        twice = given.unionByName(given).unionByName(given)
        assert sorted(map(repr, dedup_whole_trips(twice).collect())) == want


def test_null_speed(telemetry):
    df = telemetry([("A", 0, 50.0), ("A", 1, None), ("A", 2, 70.0)])
    assert [r.accel for r in kinematics(df, CURRENT).orderBy("seq").collect()] == [0.0, 0.0, 0.0]
    trip = scored_trips(df).head()
    assert (trip.samples, trip.avg_speed_kmh) == (3, 60.0)


def test_nan_speed_counts_as_speeding(telemetry):
    trip = scored_trips(telemetry([("A", 0, 50.0), ("A", 1, float("nan"))])).head()
    assert (trip.speeding_alerts, trip.accel_variance) == (1, 0.0)
    assert math.isnan(trip.max_speed_kmh)


def test_coordinate_bounds(telemetry):
    nan = float("nan")
    places = [(90.0, 180.0), (-90.0, -180.0), (90.0001, 0.0), (0.0, -180.0001), (None, 0.0), (0.0, None),
              (nan, 0.0), (0.0, nan)]
    df = telemetry([("A", i, 1.0, lat, lon) for i, (lat, lon) in enumerate(places)])
    assert sorted(r.seq for r in filter_coordinates(df).collect()) == [1, 2]


def test_thresholds(telemetry):
    # 90 km/h is not speeding; 90 to 9 over 5 s is exactly -4.5 m/s², not a hard brake.
    trip = scored_trips(telemetry([("A", 0, 90.0), ("A", 5, 9.0)])).head()
    assert (trip.speeding_alerts, trip.hard_brakes) == (0, 0)
    # 80 to 63.8 over 1 s comes out a hair below -4.5.
    assert scored_trips(telemetry([("A", 0, 80.0), ("A", 1, 63.8)])).head().hard_brakes == 1
    assert scored_trips(telemetry([("A", 0, 90.01)])).head().speeding_alerts == 1


@pytest.mark.parametrize("keep", [100, 20])
def test_last_points(spark, telemetry, keep):
    sizes = {"n1": 1, "n19": 19, "n20": 20, "n21": 21, "n99": 99, "n100": 100, "n101": 101, "n250": 250}
    rows = [(trip, float(i), float(i % 50)) for trip, n in sizes.items() for i in range(1, n + 1)]
    df = telemetry(rows).repartition(5)
    reports = by_key(trip_reports(df, keep_points=keep))
    enriched = kinematics(df, CURRENT)
    want = {(r.trip_id, r.event_time): r.accel for r in enriched.collect()}
    for trip, n in sizes.items():
        points = reports[trip].points
        assert len(points) == min(n, keep)
        assert points[0].speed == float(max(1, n - keep + 1) % 50)
        assert points[-1].speed == float(n % 50)
    ranked = last_points(df, CURRENT, keep).collect()
    assert len(ranked) == sum(min(n, keep) for n in sizes.values())
    assert all(want[r.trip_id, r.event_time] == r.accel for r in ranked)
    assert {r.trip_id: r.position for r in sorted(ranked, key=lambda r: r.position)} == {
        t: min(n, keep) for t, n in sizes.items()
    }


def test_empty_input(spark, telemetry):
    empty = telemetry([])
    assert require_rows(empty) is False
    with pytest.raises(EmptyInputError):
        require_rows(empty, LEGACY.on_empty)
    assert scored_trips(empty).count() == 0
    assert require_rows(telemetry([("A", 0, 1.0)])) is True


def test_all_coordinates_invalid(telemetry):
    df = telemetry([("A", 0, 1.0, 91.0, 0.0), ("A", 1, 1.0, None, 0.0)])
    assert require_rows(df) is True
    assert trip_reports(df).count() == 0


def test_legacy_fills_deltas(telemetry):
    first = enriched_samples(telemetry([("A", 0, 50.0)]), LEGACY).head()
    assert (first.delta_v, first.delta_t, first.prev_speed) == (0.0, 0.0, None)
    assert enriched_samples(telemetry([("A", 0, 50.0)]), CURRENT).head().delta_v is None


def score(spark, alerts, variance, brakes, profile=CURRENT):
    row = [(alerts, float(variance), brakes)]
    df = spark.createDataFrame(row, "speeding_alerts long, accel_variance double, hard_brakes long")
    return risk_score(df, profile).head().risk_score


def test_parts_saturate(spark):
    assert score(spark, 20, 0, 0) == score(spark, 21, 0, 0) == 35.0
    assert score(spark, 0, 50, 0) == score(spark, 0, 51, 0) == 40.0
    assert score(spark, 0, 0, 10) == score(spark, 0, 0, 11) == 25.0
    assert score(spark, 19, 49, 9) < score(spark, 99, 99, 99) == 100.0


def test_score_is_monotone_and_bounded(spark):
    grid = [(a, float(v), b) for a in range(0, 25, 3) for v in (0, 1, 10, 49.9, 60) for b in range(0, 13, 2)]
    df = spark.createDataFrame(grid, "speeding_alerts long, accel_variance double, hard_brakes long")
    for profile in (CURRENT, LEGACY):
        scores = {tuple(r)[:3]: r.risk_score for r in risk_score(df, profile).collect()}
        assert all(0 <= s <= 100 for s in scores.values())
        for (a, v, b), s in scores.items():
            bigger = [t for (x, y, z), t in scores.items() if x >= a and y >= v and z >= b]
            assert min(bigger) >= s - 1e-9


def test_variance_agrees_with_var_pop(spark):
    from tripgauge.operators.metrics import accel_variance
    from tripgauge.sources.adapters import telemetry_from_events

    samples = enriched_samples(telemetry_from_events(spark, "/root/testdata/sf0.001"), CURRENT)
    rows = samples.groupBy("trip_id").agg(accel_variance().alias("a"), F.var_pop("accel").alias("b")).collect()
    assert rows and all(r.a >= 0 and math.isclose(r.a, r.b, rel_tol=1e-9, abs_tol=1e-9) for r in rows)


def test_retention_counts_from_write_time(telemetry):
    df = telemetry([("A", 0, 1.0), ("A", 1, 1.0), ("A", 600, 1.0)])
    as_of = F.lit("2026-05-06 14:10:00").cast("timestamp")
    assert sorted(r.seq for r in retain(df, as_of).collect()) == [2, 3]


def test_bands(spark):
    df = spark.createDataFrame([(30.0,), (30.01,), (70.0,), (70.01,), (None,)], "s double")
    got = [r.b for r in df.select(risk_band(F.col("s")).alias("b")).collect()]
    assert got == ["LOW", "MODERATE", "MODERATE", "HIGH", "LOW"]
    df = spark.createDataFrame([(2.0,), (1.99,), (-4.5,), (-4.51,), (None,)], "a double")
    got = [r.b for r in df.select(accel_band(F.col("a")).alias("b")).collect()]
    assert got == ["STRONG_ACCEL", "NORMAL", "NORMAL", "HARD_BRAKE", "NORMAL"]


def test_gauge_and_shares(spark):
    df = spark.createDataFrame([(0.0,), (60.0,), (120.0,), (300.0,)], "v double")
    assert [r[0] for r in df.select(gauge_angle(F.col("v"))).collect()] == [-90.0, 0.0, 90.0, 90.0]
    df = spark.createDataFrame([(0.4,), (1.0,), (40.0,), (250.0,), (0.0,), (None,)], "w double")
    assert [r[0] for r in df.select(percent_share(F.col("w"))).collect()] == [40.0, 100.0, 40.0, 100.0, 0.0, 0.0]

"""Slices never change a result, whatever the trips look like."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tripgauge.operators.kinematics import kinematics, rolling_stats
from tripgauge.operators.quality import dedup_lww
from tripgauge.operators.slicing import WHOLE_TRIPS, plan_slices, trip_ordinal
from tripgauge.plans.trip_report import enriched_samples, scored_trips
from tripgauge.profiles import CURRENT


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and a.count() == b.count()


@pytest.fixture(scope="module")
def uneven(telemetry):
    """A trip with most rows, among them a burst of equal times and null speeds, a
    middling one and many short ones."""
    rng = random.Random(3)
    rows = []
    for i in range(1500):
        seconds = 500.0 if i % 3 == 0 else rng.uniform(0, 1000)
        rows.append(("HOT", round(seconds, 3), None if i % 40 == 0 else round(rng.uniform(0, 150), 2)))
    rows += [("MID", float(i), round(rng.uniform(0, 150), 2)) for i in range(300)]
    rows += [(f"S{i % 60}", float(i), round(rng.uniform(0, 150), 2)) for i in range(600)]
    return telemetry(rows).repartition(6).cache()


@pytest.mark.parametrize("slice_rows", [3, 40, 1499])
def test_sliced_equals_whole(uneven, slice_rows):
    slices = plan_slices(uneven, slice_rows=slice_rows)
    assert slices.needed
    whole = kinematics(uneven, CURRENT, slices=WHOLE_TRIPS)
    sliced = kinematics(uneven, CURRENT, slices=slices)
    assert same_rows(whole, sliced)
    columns = ["trip_id", "seq", "rolling_max_speed", F.round("rolling_avg_speed", 6), F.round("rolling_avg_accel", 6)]
    rolled = rolling_stats(whole, slices=WHOLE_TRIPS).select(*columns)
    assert same_rows(rolled, rolling_stats(sliced, slices=slices).select(*columns))
    numbered = trip_ordinal(uneven, WHOLE_TRIPS).withColumn("ordinal", F.col("ordinal").cast("long"))
    assert same_rows(numbered, trip_ordinal(uneven, slices).select(*numbered.columns))


def test_sliced_reports_equal_whole(uneven):
    columns = ["trip_id", "samples", "speeding_alerts", "hard_brakes", "points", "last_lat", "risk_score"]
    whole = scored_trips(uneven, keep_points=30, slices=WHOLE_TRIPS).select(*columns)
    for slice_rows in (7, 100):
        slices = plan_slices(uneven, slice_rows=slice_rows)
        assert same_rows(whole, scored_trips(uneven, keep_points=30, slices=slices).select(*columns))


def test_slices_are_even_also_inside_one_instant(uneven):
    slices = plan_slices(uneven, slice_rows=100)
    counts = slices.assign(uneven, long_trips_only=True).groupBy("trip_id", "slice").count().collect()
    assert {r.trip_id for r in counts} == {"HOT", "MID"}
    assert max(r["count"] for r in counts) <= 200


def test_many_equally_long_trips_are_all_cut(telemetry):
    df = telemetry([(f"T{k}", float(i), float(i % 90)) for k in range(20) for i in range(300)])
    slices = plan_slices(df, slice_rows=30)
    counts = slices.assign(df, long_trips_only=True).groupBy("trip_id", "slice").count().collect()
    assert len({r.trip_id for r in counts}) == 20 and max(r["count"] for r in counts) <= 60
    assert same_rows(kinematics(df, CURRENT, slices=WHOLE_TRIPS), kinematics(df, CURRENT, slices=slices))


def test_rows_without_trip_or_sequence_are_cut_too(telemetry):
    df = telemetry([(None, float(i), float(i % 90)) for i in range(400)])
    df = df.unionByName(telemetry([("N", float(i), float(i % 90)) for i in range(400)]).withColumn(
        "seq", F.lit(None).cast("long")))
    slices = plan_slices(df, slice_rows=20)
    counts = slices.assign(df, long_trips_only=True).groupBy("trip_id", "slice").count().collect()
    assert {r.trip_id for r in counts} == {None, "N"} and max(r["count"] for r in counts) <= 60
    assert same_rows(kinematics(df, CURRENT, slices=WHOLE_TRIPS), kinematics(df, CURRENT, slices=slices))


def test_short_trips_need_no_slices(uneven):
    assert not plan_slices(uneven, slice_rows=1500).needed
    assert not plan_slices(uneven.limit(0)).needed


@pytest.mark.parametrize("slice_rows", [5, 60])
def test_slices_planned_on_rows_that_later_vanish(telemetry, slice_rows):
    """Copies and bad positions may empty slices, or take just their last rows."""
    rows = [("A", float(i), float(i % 90), 91.0 if i % 7 > 2 else 0.0, 0.0) for i in range(200)]
    rows += [("A", 100.5, 1.0, 0.0, 0.0)] * 150 + [("A", 300.0, float(i), 0.0, 0.0) for i in range(300)]
    df = telemetry(rows).cache()
    slices = plan_slices(df, slice_rows=slice_rows)
    assert slices.needed
    kept = dedup_lww(df)
    columns = ["trip_id", "samples", "speeding_alerts", "hard_brakes", "points", "last_lat", "risk_score"]
    whole = scored_trips(kept, keep_points=30, slices=WHOLE_TRIPS).select(*columns)
    assert len(whole.head().points) == 30
    assert same_rows(whole, scored_trips(kept, keep_points=30, slices=slices).select(*columns))
    samples = enriched_samples(kept, CURRENT, slices=WHOLE_TRIPS)
    assert same_rows(samples, enriched_samples(kept, CURRENT, slices=slices))
    rolled = rolling_stats(samples, slices=WHOLE_TRIPS).select("seq", "rolling_max_speed")
    assert same_rows(rolled, rolling_stats(samples, slices=slices).select("seq", "rolling_max_speed"))

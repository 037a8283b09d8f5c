"""Sums that are the same for every order of rows."""

from __future__ import annotations

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from tripgauge.functions.exact import exact_mean, exact_sum
from tripgauge.operators.kinematics import kinematics
from tripgauge.operators.metrics import trip_metrics
from tripgauge.operators.slicing import WHOLE_TRIPS
from tripgauge.profiles import LEGACY


def bits(value):
    return None if value is None else struct.pack("<d", value)


def groups():
    random.seed(5)
    yield "mixed", [random.choice([-1, 1]) * random.random() * 2.0 ** random.randint(-30, 55) for _ in range(4000)]
    yield "cancel", [1e16, 1.0, -1e16, 2.5, 1e-3] * 300
    yield "small", [-0.1] * 10 + [random.uniform(-1e-6, 1e-6) for _ in range(500)]
    yield "negative", [-(2.0**-20)] * 7
    yield "zero", [0.1, -0.1]
    yield "none", [None, None]
    yield "some", [None, 3.5, None]


def test_equal_bits_for_any_partitioning(spark):
    rows = [(name, v) for name, values in groups() for v in values]
    seen = set()
    for seed, parts in ((1, 1), (2, 3), (3, 16)):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "g string, v double").repartition(parts)
        got = df.groupBy("g").agg(exact_sum(F.col("v")).alias("s"), exact_mean(F.col("v")).alias("m")).collect()
        seen.add(tuple(sorted((r.g, bits(r.s), bits(r.m)) for r in got)))
    assert len(seen) == 1
    found = {r.g: r.s for r in got}
    for name, values in groups():
        numbers = [v for v in values if v is not None]
        want = math.fsum(numbers) if numbers else None
        # What a value has below the last unit isn't counted.
        slack = len(numbers) * 2.0**-61 + (math.ulp(want) if numbers else 0)
        assert found[name] == want if want is None else abs(found[name] - want) <= slack, name


def test_values_beyond_the_range_are_not_lost(spark):
    df = spark.createDataFrame([("a", 1e300), ("a", 1.0), ("b", float("nan")), ("b", 1.0), ("c", float("inf")), ("c", 2.0)],
                               "g string, v double")
    got = {r.g: r.s for r in df.groupBy("g").agg(exact_sum(F.col("v")).alias("s")).collect()}
    assert got["a"] == 1e300 and math.isnan(got["b"]) and got["c"] == math.inf
    assert df.filter("false").agg(exact_sum(F.col("v")).alias("s")).head().s is None


def test_metrics_of_a_trip_with_exact_sums(spark, telemetry):
    random.seed(9)
    samples = telemetry([("A", i * 0.7, random.uniform(0, 120)) for i in range(300)])
    enriched = kinematics(samples, LEGACY, slices=WHOLE_TRIPS).persist()
    results = []
    for parts in (1, 5, 16):
        r = trip_metrics(enriched.repartition(parts), LEGACY, exact=True).head()
        results.append((bits(r.avg_speed_kmh), bits(r.accel_variance)))
    assert len(set(results)) == 1
    plain = trip_metrics(enriched, LEGACY).head()
    assert (r.avg_speed_kmh, r.accel_variance) == pytest.approx((plain.avg_speed_kmh, plain.accel_variance), rel=1e-12)
    text = trip_metrics(enriched, LEGACY, exact=True)._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in text and "SortAggregate" not in text
    enriched.unpersist()

"""Aggregates per trip, over the whole fleet, and of a trip's last samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripgauge.functions.columns import (
    is_hard_brake,
    is_speeding,
    stable_round,
    tail,
)
from tripgauge.functions.exact import exact_mean
from tripgauge.operators.kinematics import kinematics
from tripgauge.operators.quality import moment_order
from tripgauge.operators.slicing import WHOLE_TRIPS
from tripgauge.profiles import KEEP_POINTS, Profile


def accel_variance(exact: bool = False) -> Column:
    """Population variance in one pass, E[X²] − E[X]², not below zero."""
    average = exact_mean if exact else F.avg
    mean = average(F.col("accel"))
    return F.greatest(F.lit(0.0), average(F.col("accel") * F.col("accel")) - mean * mean)


def _measures(profile: Profile, exact: bool) -> list[Column]:
    average = exact_mean if exact else F.avg
    return [
        F.count(F.lit(1)).alias("samples"),
        average(F.col("speed_kmh")).alias("avg_speed_kmh"),
        F.max("speed_kmh").alias("max_speed_kmh"),
        F.count_if(is_speeding(profile)).alias("speeding_alerts"),
        accel_variance(exact).alias("accel_variance"),
        F.count_if(is_hard_brake(profile)).alias("hard_brakes"),
    ]


def trip_metrics(
    enriched: DataFrame, profile: Profile, keep_points: int | None = None, exact: bool = False
) -> DataFrame:
    """One row per trip. With ``keep_points`` also the trip's last samples in time
    order as ``points`` and the position of the newest as ``last_lat``/``last_lon``;
    the input then needs ``in_tail``. Only marked rows are collected, so the array
    under construction holds at most ``keep_points`` per slice of the trip. With ``exact``
    means and variance have the same bits for any partitioning."""
    measures = _measures(profile, exact)
    if keep_points is None:
        return enriched.groupBy("trip_id").agg(*measures)
    sample = F.struct("event_time", "seq", "speed_kmh", "accel", "lat", "lon")
    collected = F.collect_list(F.when(F.col("in_tail"), sample))
    newest = F.try_element_at("points", F.lit(-1))
    return (
        enriched.groupBy("trip_id")
        .agg(*measures, collected.alias("points"))
        .withColumn("points", tail(F.array_sort("points"), keep_points, F.size("points")))
        .withColumns({"last_lat": newest["lat"], "last_lon": newest["lon"]})
    )


def last_position(df: DataFrame) -> DataFrame:
    """Position of each trip's newest sample. The order is one number and the columns are
    picked one by one, which keeps this in a hash aggregate."""
    newest = moment_order("event_time", "seq")
    return df.groupBy("trip_id").agg(
        F.max_by("lat", newest).alias("last_lat"), F.max_by("lon", newest).alias("last_lon")
    )


def last_samples(df: DataFrame, n: int) -> DataFrame:
    """The newest ``n`` rows of each trip. Every map task passes on at most ``n`` of
    its rows per trip, so a long trip is not gathered in one place."""
    newest = Window.partitionBy("trip_id").orderBy(F.desc("event_time"), F.desc("seq"))
    return df.withColumn("rn", F.row_number().over(newest)).filter(F.col("rn") <= n).drop("rn")


def last_points(df: DataFrame, profile: Profile, n: int = KEEP_POINTS) -> DataFrame:
    """The newest ``n`` samples of each trip with their acceleration and ``position``,
    1 for the oldest kept. One sample more is fetched to feed the oldest one's lag."""
    recent = kinematics(last_samples(df, n + 1), profile, slices=WHOLE_TRIPS)
    trip = Window.partitionBy("trip_id")
    spare = F.greatest(F.count(F.lit(1)).over(trip) - n, F.lit(0))
    rank = F.row_number().over(trip.orderBy("event_time", "seq"))
    return (
        recent.withColumns({"spare": spare, "rank": rank})
        .filter(F.col("rank") > F.col("spare"))
        .withColumn("position", (F.col("rank") - F.col("spare")).cast("int"))
        .drop("spare", "rank")
    )


def fleet_metrics(enriched: DataFrame, profile: Profile) -> DataFrame:
    """One row over all trips, in one job, rounded as the fleet report shows it."""
    even = profile.half_even
    decimals = profile.variance_decimals if profile.variance_decimals is not None else 4
    zero = F.lit(0.0)
    mean, square = F.coalesce(F.avg("accel"), zero), F.coalesce(F.avg(F.col("accel") * F.col("accel")), zero)
    return enriched.agg(
        F.count(F.lit(1)).alias("samples"),
        stable_round(F.coalesce(F.avg("speed_kmh"), zero), 2, even).alias("avg_speed_kmh"),
        stable_round(F.coalesce(F.max("speed_kmh"), zero), 2, even).alias("max_speed_kmh"),
        F.count_if(is_speeding(profile)).alias("speeding_alerts"),
        stable_round(F.greatest(zero, square - mean * mean), decimals, even).alias("accel_variance"),
        stable_round(mean, 6, even).alias("accel_mean"),
        stable_round(square, 6, even).alias("accel_mean_square"),
        F.count_if(is_hard_brake(profile)).alias("hard_brakes"),
    )

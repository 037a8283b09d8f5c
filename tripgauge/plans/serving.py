"""Reads over stored reports: latest, history, JSON, bands, series, logs, routes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgauge.functions.columns import (
    accel_band,
    gauge_angle,
    iso_time,
    needle_angle,
    number_or_zero,
    percent_share,
    risk_band,
    time_of_day,
)
from tripgauge.operators.slicing import SLICE_ROWS, plan_slices, trip_ordinal
from tripgauge.profiles import PAGE_LAT, PAGE_LON

HISTORY_LIMIT = 50
BUFFER_SIZE = 50

# Feed events and the payload of an empty feed.
UPDATE_EVENT, PING_EVENT = "pipeline_update", "ping"
EMPTY_PAYLOAD = '{"status": "empty_collection"}'

# Labels of the lineage log.
LINEAGE_LABELS = (
    ("MOTOR_PROCESAMIENTO", "engine"),
    ("PATRON_ETL", "etl"),
    ("ALGORITMO_VARIANZA", "variance"),
    ("PATRON_PERSISTENCIA", "persistence"),
    ("PRINCIPIOS", "principles"),
)

# Weight factors in display order.
WEIGHT_FACTORS = ("variance", "speeding", "braking")


def _newest(by: str) -> list[Column]:
    """``by`` is ``created_seq`` (first inserted last) or ``processed_at``."""
    return [F.desc(by), F.asc("trip_id")]


def latest_report(reports: DataFrame, by: str = "created_seq") -> DataFrame:
    return reports.orderBy(*_newest(by)).limit(1)


def report_history(reports: DataFrame, n: int = HISTORY_LIMIT, by: str = "created_seq") -> DataFrame:
    return reports.orderBy(*_newest(by)).limit(n)


def for_trip(reports: DataFrame, trip_id: str) -> DataFrame:
    return reports.filter(F.col("trip_id") == F.lit(trip_id))


def latest_for_trip(reports: DataFrame, trip_id: str, by: str = "created_seq") -> DataFrame:
    return latest_report(for_trip(reports, trip_id), by)


def latest_per_trip(updates: DataFrame, by: str = "processed_at") -> DataFrame:
    """The newest update of every trip; a task passes on one row per trip."""
    newest = Window.partitionBy("trip_id").orderBy(F.desc(by))
    return updates.withColumn("_nth", F.row_number().over(newest)).filter(F.col("_nth") == 1).drop("_nth")


def update_buffer(updates: DataFrame, n: int = BUFFER_SIZE) -> DataFrame:
    """The ``n`` newest updates of the feed, newest first."""
    return updates.orderBy(F.desc("processed_at"), F.desc("batch_id"), F.asc("trip_id")).limit(n)


def report_json(reports: DataFrame, name: str = "document", carry: Sequence[str] = ()) -> DataFrame:
    """Each report as a JSON document with ISO times; absent values stay as null. The columns of
    ``carry`` stay beside it."""
    times = {
        f.name: iso_time(F.col(f.name))
        for f in reports.schema.fields
        if isinstance(f.dataType, T.TimestampType)
    }
    told = [c for c in reports.columns if c not in carry]
    document = F.to_json(F.struct(*told), {"ignoreNullFields": "false"})
    return reports.withColumns(times).select("trip_id", *carry, document.alias(name))


def feed_snapshot(reports: DataFrame, trip_id: str, by: str = "created_seq") -> DataFrame:
    """What one poll of the feed emits: the trip's newest report, or a ping."""
    payloads = report_json(latest_for_trip(reports, trip_id, by)).select("document")
    return payloads.agg(F.max("document").alias("document")).select(
        F.when(F.col("document").isNull(), PING_EVENT).otherwise(UPDATE_EVENT).alias("event"),
        F.coalesce("document", F.lit(EMPTY_PAYLOAD)).alias("data"),
    )


def risk_bands(reports: DataFrame) -> DataFrame:
    score = F.coalesce(F.col("risk.score"), F.lit(0.0))
    return reports.select("trip_id", score.alias("score"), risk_band(score).alias("band"))


def current_motion(reports: DataFrame) -> DataFrame:
    """Newest speed and acceleration of each report, their band and gauge angles, and
    the position the map shows."""
    newest = F.try_element_at("points", F.lit(-1))
    speed, accel = number_or_zero(newest["speed"]), number_or_zero(newest["accel"])
    return reports.select(
        "trip_id",
        speed.alias("speed"),
        accel.alias("accel"),
        accel_band(accel).alias("band"),
        gauge_angle(speed).alias("gauge_angle"),
        needle_angle(F.col("basic.avg_speed_kmh")).alias("needle_angle"),
        F.coalesce("position.lat", F.lit(PAGE_LAT)).alias("lat"),
        F.coalesce("position.lon", F.lit(PAGE_LON)).alias("lon"),
    )


def speed_series(reports: DataFrame) -> DataFrame:
    """Chart points of each report in time order, ``idx`` from 0."""
    return reports.select("trip_id", F.posexplode("points").alias("idx", "p")).select(
        "trip_id",
        "idx",
        time_of_day(F.col("p.time")).alias("name"),
        F.round(number_or_zero(F.col("p.speed")), 2).alias("speed"),
        F.round(number_or_zero(F.col("p.accel")), 2).alias("accel"),
    )


def weight_shares(reports: DataFrame) -> DataFrame:
    """Percentage of each factor in the score, one row per trip and factor."""
    pairs = F.array(*[
        F.struct(F.lit(name).alias("factor"), percent_share(F.col(f"risk.weights.{name}")).alias("percent"))
        for name in WEIGHT_FACTORS
    ])
    return reports.select("trip_id", F.explode(pairs).alias("w")).select("trip_id", "w.factor", "w.percent")


def alert_flags(reports: DataFrame) -> DataFrame:
    zero = F.lit(0)
    return reports.select(
        "trip_id",
        (F.coalesce("basic.speeding_alerts", zero) > 0).alias("any_speeding"),
        (F.coalesce("risk.hard_brakes", zero) > 0).alias("any_hard_brake"),
    )


# Fixed value: the format of a line of the sample log.
SAMPLE_LINE = "[%s] [OK] VEL: %.1f km/h | ACEL: %.2f m/s²"


def sample_log(reports: DataFrame) -> DataFrame:
    """Log lines of each report's points, newest first, ``line`` from 0."""
    text = F.format_string(
        SAMPLE_LINE,
        F.coalesce("p.time", F.lit("N/A")),
        number_or_zero(F.col("p.speed")),
        number_or_zero(F.col("p.accel")),
    )
    newest_first = F.posexplode(F.reverse("points")).alias("line", "p")
    return reports.select("trip_id", newest_first).select("trip_id", "line", text.alias("text"))


def lineage_log(reports: DataFrame) -> DataFrame:
    """Log lines of each report's lineage."""
    when = F.coalesce(iso_time(F.col("processed_at")), F.lit("N/A"))
    lines = F.array(*[
        F.format_string(f"[%s] [INFO] {label}: %s", when, F.coalesce(f"lineage.{field}", F.lit("N/A")))
        for label, field in LINEAGE_LABELS
    ])
    return reports.select("trip_id", F.posexplode(lines).alias("line", "text"))


def route(updates: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Positions of a trip's successive reports, numbered from 1. A route grows with
    every update, so it is a table of rows and never an array."""
    lat, lon = F.col("position.lat"), F.col("position.lon")
    positions = updates.filter(
        lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)
    ).select("trip_id", "processed_at", "batch_id", lat.alias("lat"), lon.alias("lon"))
    slices = plan_slices(positions, time="processed_at", seq="batch_id", slice_rows=slice_rows)
    return trip_ordinal(positions, slices)

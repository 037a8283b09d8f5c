"""Telemetry read out of tables that are not telemetry."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgauge.schema import TELEMETRY

EPOCH_2024_MICROS = 1_704_067_200_000_000
TIME_SCALE = 1000


# Given outright, so that no job reads footers to find it out.
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def telemetry_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_telemetry(spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet"))


def arrivals(telemetry: DataFrame, path: str, part: Column, parts: int) -> Iterator[DataFrame]:
    """Telemetry that lands in ``path`` part after part, by the number ``part`` gives each
    row. After each one the stream of all that has landed."""
    for i in range(parts):
        telemetry.filter(part == i).write.mode("append").parquet(path)
        yield telemetry.sparkSession.readStream.schema(TELEMETRY).parquet(path)


def as_telemetry(events: DataFrame) -> DataFrame:
    """One trip per user, the value as speed, gaps shortened a thousandfold (hours of
    idle time would hide every acceleration), positions spread around the default one."""
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(EPOCH_2024_MICROS)
    event_time = F.timestamp_micros(
        F.lit(EPOCH_2024_MICROS) + F.floor(micros / F.lit(TIME_SCALE)).cast("long")
    )
    return events.select(
        F.concat(F.lit("TRIP-"), F.col("user_id").cast("string")).alias("trip_id"),
        event_time.alias("event_time"),
        (F.lit(-12.0464) + (F.col("event_id") % 2001 - 1000) * F.lit(0.08)).alias("lat"),
        (F.lit(-77.0428) + ((F.col("event_id") * 7919) % 3001 - 1500) * F.lit(0.07)).alias("lon"),
        F.col("value").cast("double").alias("speed_kmh"),
        event_time.alias("ingested_at"),
        F.col("event_id").alias("seq"),
    )

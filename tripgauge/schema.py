"""Schemas of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

TELEMETRY = T.StructType([
    T.StructField("trip_id", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("speed_kmh", T.DoubleType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("seq", T.LongType()),
])

# Column names of the external telemetry table and CSV files.
EXTERNAL_NAMES = {
    "id_viaje": "trip_id",
    "tiempo": "event_time",
    "latitud": "lat",
    "longitud": "lon",
    "velocidad": "speed_kmh",
    "velocidad_kmh": "speed_kmh",
}

CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSZ"

POINT = T.StructType([
    T.StructField("speed", T.DoubleType()),
    T.StructField("accel", T.DoubleType()),
    T.StructField("time", T.StringType()),
])

POSITION = T.StructType([
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
])

WEIGHTS = T.StructType([
    T.StructField("speeding", T.DoubleType()),
    T.StructField("variance", T.DoubleType()),
    T.StructField("braking", T.DoubleType()),
])

BASIC = T.StructType([
    T.StructField("samples", T.IntegerType()),
    T.StructField("avg_speed_kmh", T.DoubleType()),
    T.StructField("max_speed_kmh", T.DoubleType()),
    T.StructField("speeding_alerts", T.IntegerType()),
    T.StructField("speed_limit", T.DoubleType()),
])

RISK = T.StructType([
    T.StructField("accel_variance", T.DoubleType()),
    T.StructField("hard_brakes", T.IntegerType()),
    T.StructField("brake_threshold", T.DoubleType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("weights", WEIGHTS),
])

LINEAGE = T.StructType([
    T.StructField("engine", T.StringType()),
    T.StructField("etl", T.StringType()),
    T.StructField("variance", T.StringType()),
    T.StructField("persistence", T.StringType()),
    T.StructField("principles", T.StringType()),
])

TRIP_REPORT = T.StructType([
    T.StructField("project", T.StringType()),
    T.StructField("pipeline_version", T.StringType()),
    T.StructField("trip_id", T.StringType()),
    T.StructField("analyzed_at", T.TimestampType()),
    T.StructField("processed_at", T.TimestampType()),
    T.StructField("avg_speed_kmh", T.DoubleType()),
    T.StructField("max_speed_kmh", T.DoubleType()),
    T.StructField("global_risk_score", T.DoubleType()),
    T.StructField("position", POSITION),
    T.StructField("basic", BASIC),
    T.StructField("risk", RISK),
    T.StructField("lineage", LINEAGE),
    T.StructField("points", T.ArrayType(POINT)),
])

AUDIT = T.StructType([
    T.StructField("trip_id", T.StringType()),
    T.StructField("avg_speed_kmh", T.DoubleType()),
    T.StructField("max_speed_kmh", T.DoubleType()),
    T.StructField("speeding_alerts", T.LongType()),
    T.StructField("accel_variance", T.DoubleType()),
    T.StructField("hard_brakes", T.LongType()),
    T.StructField("risk_score", T.DoubleType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("run_at", T.TimestampType()),
])

# A batch of documents for the history merge; point fields arrive as text.
INCOMING_POINT = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("time", T.StringType()),
    T.StructField("speed", T.StringType()),
    T.StructField("avg_speed_kmh", T.StringType()),
    T.StructField("max_speed_kmh", T.StringType()),
])

INCOMING_DOCUMENT = T.StructType([
    T.StructField("doc_seq", T.LongType()),
    T.StructField("trip_id", T.StringType()),
    T.StructField("basic", T.StructType([
        T.StructField("avg_speed_kmh", T.DoubleType()),
        T.StructField("max_speed_kmh", T.DoubleType()),
    ])),
    T.StructField("risk", T.StructType([T.StructField("score", T.DoubleType())])),
    T.StructField("points", T.ArrayType(INCOMING_POINT)),
])

HISTORY_POINT = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("avg_speed_kmh", T.DoubleType()),
    T.StructField("max_speed_kmh", T.DoubleType()),
])

# Every field of a report, with points as the merge stores them.
HISTORY = T.StructType([
    *[field for field in TRIP_REPORT.fields if field.name != "points"],
    T.StructField("points", T.ArrayType(HISTORY_POINT)),
])

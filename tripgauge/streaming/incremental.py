"""Trip metrics carried forward from batch to batch.

A trip's samples so far are summarised by their sums, counts and newest sample. The
summary of a later run of samples joins on with one more acceleration, the one across
the seam. A batch is summarised with the batch operators, so a trip that fills a batch
is still spread over tasks and only one row per trip meets the stored state.

Samples must arrive in time order per trip: a late one gets no acceleration and leaves
its successor's as it was. ``streaming.cycle`` has no such condition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripgauge.functions.columns import acceleration, elapsed_seconds, is_hard_brake, is_speeding
from tripgauge.operators.scoring import risk_score
from tripgauge.operators.slicing import SLICE_ROWS
from tripgauge.plans.trip_report import enriched_samples
from tripgauge.profiles import CURRENT, Profile
from tripgauge.sources.keyed_log import KeyedLog

_SAMPLE = T.StructType([
    T.StructField("event_time", T.TimestampType()),
    T.StructField("seq", T.LongType()),
    T.StructField("speed_kmh", T.DoubleType()),
])

STATE = T.StructType([
    T.StructField("trip_id", T.StringType()),
    T.StructField("newest", _SAMPLE),
    T.StructField("samples", T.LongType()),
    T.StructField("speeds", T.LongType()),
    T.StructField("speed_sum", T.DoubleType()),
    T.StructField("max_speed_kmh", T.DoubleType()),
    T.StructField("speeding_alerts", T.LongType()),
    T.StructField("accel_sum", T.DoubleType()),
    T.StructField("accel_square_sum", T.DoubleType()),
    T.StructField("hard_brakes", T.LongType()),
])

ADDITIVE = ("samples", "speeds", "speed_sum", "speeding_alerts", "accel_sum", "accel_square_sum", "hard_brakes")


def state_log(spark: SparkSession, path: str) -> KeyedLog:
    return KeyedLog(spark, path, STATE)


def summarise(enriched: DataFrame, profile: Profile) -> DataFrame:
    """One summary per trip of samples with ``accel``; ``oldest`` is kept for the seam."""
    order, sample = F.struct("event_time", "seq"), F.struct(*_SAMPLE.fieldNames())
    return enriched.groupBy("trip_id").agg(
        F.min_by(sample, order).alias("oldest"),
        F.max_by(sample, order).alias("newest"),
        F.count(F.lit(1)).alias("samples"),
        F.count("speed_kmh").alias("speeds"),
        F.coalesce(F.sum("speed_kmh"), F.lit(0.0)).alias("speed_sum"),
        F.max("speed_kmh").alias("max_speed_kmh"),
        F.count_if(is_speeding(profile)).alias("speeding_alerts"),
        F.sum("accel").alias("accel_sum"),
        F.sum(F.col("accel") * F.col("accel")).alias("accel_square_sum"),
        F.count_if(is_hard_brake(profile)).alias("hard_brakes"),
    )


def extend(state: DataFrame, later: DataFrame, profile: Profile) -> DataFrame:
    """State of the trips in ``later`` after taking its samples in."""
    before = state.select("trip_id", F.struct(*[c for c in STATE.fieldNames() if c != "trip_id"]).alias("b"))
    known = F.col("b").isNotNull()
    seconds = elapsed_seconds(F.col("oldest.event_time"), F.col("b.newest.event_time"))
    seam = acceleration(F.col("oldest.speed_kmh"), F.col("b.newest.speed_kmh"), seconds, profile)
    joined = later.join(before, "trip_id", "left").withColumn("seam", F.when(known, seam).otherwise(0.0))
    at_seam = {
        "accel_sum": F.col("seam"),
        "accel_square_sum": F.col("seam") * F.col("seam"),
        # The batch counted its first sample with acceleration 0.
        "hard_brakes": is_hard_brake(profile, "seam").cast("long"),
    }
    merged = {
        c: F.col(c) + F.coalesce(F.col(f"b.{c}"), F.lit(0)) + at_seam.get(c, F.lit(0)) for c in ADDITIVE
    }
    order = [F.struct(f"{s}.event_time", f"{s}.seq") for s in ("newest", "b.newest")]
    merged["newest"] = F.when(known & (order[1] > order[0]), F.col("b.newest")).otherwise(F.col("newest"))
    merged["max_speed_kmh"] = F.greatest("max_speed_kmh", "b.max_speed_kmh")
    return joined.withColumns(merged).select(*STATE.fieldNames())


def state_metrics(state: DataFrame, profile: Profile = CURRENT) -> DataFrame:
    """Scored metrics of each trip's state, on a batch or a stream."""
    mean = F.col("accel_sum") / F.col("samples")
    variance = F.greatest(F.lit(0.0), F.col("accel_square_sum") / F.col("samples") - mean * mean)
    metrics = state.select(
        "trip_id",
        "samples",
        F.when(F.col("speeds") > 0, F.col("speed_sum") / F.col("speeds")).alias("avg_speed_kmh"),
        "max_speed_kmh",
        "speeding_alerts",
        variance.alias("accel_variance"),
        "hard_brakes",
    )
    return risk_score(metrics, profile)


def incremental_metrics(log: KeyedLog, profile: Profile = CURRENT) -> DataFrame:
    """Streaming rows of scored metrics, one per trip and batch it took part in."""
    stored = log.spark.readStream.schema(log.stored_schema).parquet(log.batches_path)
    return state_metrics(stored, profile)


def start_incremental(
    samples: DataFrame,
    log: KeyedLog,
    checkpoint: str,
    profile: Profile = CURRENT,
    slice_rows: int = SLICE_ROWS,
    interval: str | None = None,
    maintain_every: int | None = 100,
) -> StreamingQuery:
    """Keep ``log`` up to date from a stream of telemetry. Every ``maintain_every``
    batches old ones are folded together, so that the state stays one row per trip and
    few batches; readers of ``incremental_metrics`` should be past those."""

    def process(batch: DataFrame, batch_id: int) -> None:
        later = summarise(enriched_samples(batch, profile, slice_rows=slice_rows), profile)
        log.write(extend(log.latest(before=batch_id), later, profile), batch_id)
        log.maintain(batch_id, maintain_every)

    writer = samples.writeStream.option("checkpointLocation", checkpoint).foreachBatch(process)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()

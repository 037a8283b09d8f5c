"""The live feed of reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripgauge.plans.serving import UPDATE_EVENT, feed_snapshot, report_json
from tripgauge.sources.keyed_log import KeyedLog

FEED_SECONDS = 1


def report_feed(reports: KeyedLog, files_per_trigger: int | None = None) -> DataFrame:
    """Streaming rows ``trip_id, event, data``, one per report written."""
    reader = reports.spark.readStream.schema(reports.stored_schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    stored = reader.parquet(reports.batches_path).select(*reports.schema.fieldNames())
    return report_json(stored, "data").select("trip_id", F.lit(UPDATE_EVENT).alias("event"), "data")


def start_feed(
    spark: SparkSession,
    reports: KeyedLog,
    trip_id: str,
    target: str,
    checkpoint: str,
    seconds: int = FEED_SECONDS,
) -> StreamingQuery:
    """Every ``seconds`` append the trip's newest report, or a ping while there is
    none, as a JSON row to ``target``. An unchanged report is emitted again."""

    def poll(_: DataFrame, batch_id: int) -> None:
        emitted = feed_snapshot(reports.latest(key=trip_id), trip_id)
        emitted.write.mode("overwrite").json(f"{target}/batch_id={batch_id}")

    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (
        ticks.writeStream.option("checkpointLocation", checkpoint)
        .trigger(processingTime=f"{seconds} seconds")
        .foreachBatch(poll)
        .start()
    )

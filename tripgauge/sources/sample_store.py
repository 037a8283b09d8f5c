"""Samples kept for the retention window, written batch by batch."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgauge.operators.quality import retain
from tripgauge.profiles import RETENTION_SECONDS
from tripgauge.schema import TELEMETRY
from tripgauge.sources.files import delete_directory

# Long enough that a backfill does not scatter into many files, short against the
# retention it prunes for.
SLOT_SECONDS = 300
EPOCH = datetime(1970, 1, 1)

_STORED = T.StructType([
    *TELEMETRY.fields,
    T.StructField("batch_id", T.LongType()),
    T.StructField("ingest_slot", T.LongType()),
])


class SampleStore:
    """Parquet partitioned by batch, which makes a repeated batch replace itself, and
    by arrival in five-minute slots, which lets a read skip everything past its retention."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def write(self, batch: DataFrame, batch_id: int) -> None:
        arrived = F.coalesce("ingested_at", F.current_timestamp())
        rows = batch.withColumn("ingested_at", arrived).select(*TELEMETRY.fieldNames())
        (
            rows.withColumn("ingest_slot", _slot(F.unix_seconds("ingested_at")))
            .write.mode("overwrite")
            .partitionBy("ingest_slot")
            .parquet(f"{self.path}/batch_id={batch_id}")
        )

    def all(self, upto: int | None = None) -> DataFrame:
        try:
            stored = self.spark.read.schema(_STORED).option("basePath", self.path).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _STORED)
        return stored if upto is None else stored.filter(F.col("batch_id") <= upto)

    def live(
        self,
        as_of: datetime,
        upto: int | None = None,
        ttl_seconds: int = RETENTION_SECONDS,
    ) -> DataFrame:
        """Samples written within ``ttl_seconds`` before ``as_of`` (naive, in UTC)."""
        recent = self.all(upto).filter(F.col("ingest_slot") >= _first_slot(as_of, ttl_seconds))
        micros = int((as_of - EPOCH) / timedelta(microseconds=1))
        return retain(recent, F.timestamp_micros(F.lit(micros)), ttl_seconds)

    def newest_arrival(self) -> datetime | None:
        """Looked up in the newest slot only, which the partition values tell."""
        slot = self.all().agg(F.max("ingest_slot")).head()[0]
        if slot is None:
            return None
        newest = self.all().filter(F.col("ingest_slot") == slot)
        return EPOCH + timedelta(microseconds=newest.agg(F.max(F.unix_micros("ingested_at"))).head()[0])

    def expire(self, as_of: datetime, ttl_seconds: int = RETENTION_SECONDS) -> None:
        """Delete batches of which every sample is past its retention."""
        newest = self.all().groupBy("batch_id").agg(F.max("ingest_slot").alias("slot"))
        for row in newest.filter(F.col("slot") < _first_slot(as_of, ttl_seconds)).collect():
            delete_directory(self.spark, f"{self.path}/batch_id={row['batch_id']}")


def _first_slot(as_of: datetime, ttl_seconds: int) -> int:
    oldest = as_of - timedelta(seconds=ttl_seconds)
    return int((oldest - EPOCH).total_seconds() // SLOT_SECONDS)


def _slot(seconds: Column) -> Column:
    return F.floor(seconds / F.lit(SLOT_SECONDS)).cast("long")

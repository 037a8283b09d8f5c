"""The repeating run: store arriving samples, score the live trips, write audit rows
and reports.

A late sample changes its own acceleration and its successor's, so each cycle scores
trips from the retained samples instead of carrying sums forward. Every write of a
cycle goes to a location named after its batch, so a repeated batch replaces its own
output.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Literal

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripgauge.operators.quality import dedup_lww, dedup_whole_trips, require_rows
from tripgauge.operators.slicing import SLICE_ROWS, plan_slices
from tripgauge.plans.trip_report import build_report, scored_trips
from tripgauge.profiles import CURRENT, KEEP_POINTS, RETENTION_SECONDS, Profile
from tripgauge.schema import AUDIT, TRIP_REPORT
from tripgauge.sources.keyed_log import KeyedLog
from tripgauge.sources.sample_store import SampleStore
from tripgauge.sources.sinks import audit_rows

CYCLE_INTERVAL = "10 seconds"

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Cycle:
    """Where a run keeps its tables and how it treats time, scope and failures."""

    path: str
    profile: Profile = CURRENT
    # None keeps every sample.
    ttl_seconds: int | None = RETENTION_SECONDS
    # Retention counts back from the wall clock, or from the newest arrival stored.
    clock: Literal["wall", "data"] = "wall"
    # Score every live trip, or only those with samples in the batch.
    scope: Literal["live", "batch"] = "live"
    keep_points: int = KEEP_POINTS
    slice_rows: int = SLICE_ROWS
    # Every so many cycles fold old report batches together and delete what has expired.
    maintain_every: int | None = 360
    # A failed cycle is logged and the next one picks its samples up, or it stops the run.
    on_error: Literal["continue", "raise"] = "continue"

    def samples(self, spark: SparkSession) -> SampleStore:
        return SampleStore(spark, f"{self.path}/samples")

    def reports(self, spark: SparkSession) -> KeyedLog:
        return KeyedLog(spark, f"{self.path}/reports", TRIP_REPORT)

    @property
    def audit_path(self) -> str:
        return f"{self.path}/audit"

    def audit(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(AUDIT).option("basePath", self.audit_path).parquet(self.audit_path)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        # Samples are stored outside the guard: losing them is not a failed cycle.
        self.samples(batch.sparkSession).write(batch, batch_id)
        try:
            self._score(batch, batch_id)
            self.reports(batch.sparkSession).maintain(batch_id, self.maintain_every)
            if self.ttl_seconds is not None and self.maintain_every and batch_id and batch_id % self.maintain_every == 0:
                store = self.samples(batch.sparkSession)
                store.expire(self._now(store), self.ttl_seconds)
        except Exception:
            if self.on_error == "raise":
                raise
            log.exception("cycle %s failed; its samples stay stored for the next one", batch_id)

    def _now(self, store: SampleStore) -> datetime:
        wall = datetime.now(timezone.utc).replace(tzinfo=None)
        return wall if self.clock == "wall" else store.newest_arrival() or wall

    def _live(self, batch: DataFrame, batch_id: int) -> DataFrame:
        store = self.samples(batch.sparkSession)
        if self.ttl_seconds is None:
            live = store.all(batch_id)
        else:
            live = store.live(self._now(store), batch_id, self.ttl_seconds)
        if self.scope == "batch":
            arrived = store.all(batch_id).filter(F.col("batch_id") == batch_id)
            live = live.join(arrived.select("trip_id").distinct(), "trip_id", "left_semi")
        return live.drop("ingest_slot")

    def _score(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        live = self._live(batch, batch_id)
        if not require_rows(live, self.profile.on_empty):
            log.warning("no live samples in cycle %s", batch_id)
            return
        # Planned before removing copies, which only lowers the counts it goes by.
        slices = plan_slices(live, slice_rows=self.slice_rows)
        once = dedup_lww(live) if slices.needed else dedup_whole_trips(live)
        scored = scored_trips(once.drop("batch_id"), self.profile, self.keep_points, slices)
        scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            audit = audit_rows(scored, str(batch_id)).select(*AUDIT.fieldNames())
            audit.write.mode("overwrite").parquet(f"{self.audit_path}/batch_id={batch_id}")
            self.reports(spark).write(build_report(scored, self.profile), batch_id)
        finally:
            scored.unpersist()


def start_cycle(
    samples: DataFrame,
    cycle: Cycle,
    checkpoint: str,
    interval: str | None = CYCLE_INTERVAL,
) -> StreamingQuery:
    """Run ``cycle`` over a stream of telemetry; without ``interval`` process what is
    there and stop."""
    writer = samples.writeStream.option("checkpointLocation", checkpoint).foreachBatch(cycle.process)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def run_cycle(samples: DataFrame, cycle: Cycle, batch_id: int) -> None:
    """One cycle over a batch DataFrame."""
    cycle.process(samples, batch_id)

"""One-shot runs from input to stored result."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from tripgauge.operators.quality import dedup_lww, dedup_whole_trips, require_rows
from tripgauge.operators.slicing import plan_slices
from tripgauge.plans.fleet_report import build_fleet_report
from tripgauge.plans.trip_report import build_report, scored_trips
from tripgauge.profiles import CURRENT, KEEP_POINTS, LEGACY, Profile
from tripgauge.sources.sinks import append_audit, append_report, upsert_reports
from tripgauge.sources.telemetry import read_csv


def run_trips(
    telemetry: DataFrame,
    audit_target: str,
    reports_path: str,
    batch_id: int,
    profile: Profile = CURRENT,
    maintain_every: int | None = 100,
    **jdbc: str,
) -> bool:
    """Score every trip once, append the audit rows and put the reports in place. The
    scored trips are kept across both writes. Every ``maintain_every`` batches old
    reports are folded together. False, and nothing written, without input rows."""
    if not require_rows(telemetry, profile.on_empty):
        return False
    slices = plan_slices(telemetry)
    once = dedup_lww(telemetry) if slices.needed else dedup_whole_trips(telemetry)
    scored = scored_trips(once, profile, KEEP_POINTS, slices).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        append_audit(scored, audit_target, str(batch_id), **jdbc)
        upsert_reports(build_report(scored, profile), reports_path, batch_id, maintain_every)
    finally:
        scored.unpersist()
    return True


def run_fleet(spark: SparkSession, csv_path: str, target: str, profile: Profile = LEGACY) -> str | None:
    """Report on a CSV file as a whole, append the report and return its id. Without
    rows an error, or None where the profile skips empty input."""
    telemetry = read_csv(spark, csv_path)
    if not require_rows(telemetry, profile.on_empty):
        return None
    return append_report(build_fleet_report(telemetry, profile), target)

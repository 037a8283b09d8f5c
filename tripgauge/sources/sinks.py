"""Audit rows and reports, written and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgauge.operators.history import changed_histories
from tripgauge.plans.trip_report import audit_view
from tripgauge.profiles import KEEP_POINTS
from tripgauge.schema import AUDIT, HISTORY, TRIP_REPORT
from tripgauge.sources.keyed_log import KeyedLog

AUDIT_WRITERS = 2


def audit_rows(scored: DataFrame, run_id: str) -> DataFrame:
    return audit_view(scored).withColumns({"run_id": F.lit(run_id), "run_at": F.current_timestamp()})


def append_audit(scored: DataFrame, target: str, run_id: str, **jdbc: str) -> None:
    """Append one audit row per trip. With ``url=…`` and further JDBC properties the
    target is a table there and at most two tasks hold a connection; otherwise it is a
    folder, in which a repeated run replaces its own rows."""
    rows = audit_rows(scored, run_id)
    if "url" in jdbc:
        # A shuffle, not a narrow coalesce: that would run the whole computation
        # upstream in two tasks as well.
        properties = dict(jdbc)
        url = properties.pop("url")
        rows.repartition(AUDIT_WRITERS).write.jdbc(url, target, mode="append", properties=properties)
    else:
        rows.write.mode("overwrite").parquet(f"{target}/run={run_id}")


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT).option("recursiveFileLookup", True).parquet(path)


def append_report(report: DataFrame, path: str) -> str:
    """Store one fleet report and return its id."""
    report_id = str(uuid.uuid4())
    report.withColumn("report_id", F.lit(report_id)).write.mode("append").parquet(path)
    return report_id


def upsert_reports(reports: DataFrame, path: str, batch_id: int, maintain_every: int | None = None) -> None:
    """Put each report in the place of its trip's earlier one; every ``maintain_every``
    batches fold old ones together."""
    log = KeyedLog(reports.sparkSession, path, TRIP_REPORT)
    log.write(reports, batch_id)
    log.maintain(batch_id, maintain_every)


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """The stored report of every trip, with ``created_seq`` and ``batch_id``."""
    return KeyedLog(spark, path, TRIP_REPORT).latest()


def upsert_histories(
    documents: DataFrame,
    path: str,
    batch_id: int,
    as_of: Column | None = None,
    keep: int = KEEP_POINTS,
    maintain_every: int | None = None,
) -> None:
    """Merge a batch of documents into the stored histories of the trips it names. A
    repeated batch meets what was stored before it and replaces itself."""
    log = KeyedLog(documents.sparkSession, path, HISTORY)
    stored = log.latest(before=batch_id).select(*HISTORY.fieldNames())
    now = F.current_timestamp() if as_of is None else as_of
    log.write(changed_histories(stored, documents, now, keep), batch_id)
    log.maintain(batch_id, maintain_every)


def read_histories(spark: SparkSession, path: str) -> DataFrame:
    return KeyedLog(spark, path, HISTORY).latest()

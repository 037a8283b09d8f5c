"""Plans keep the shape they were designed for."""

from __future__ import annotations

import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tripgauge.functions.columns import parse_time
from tripgauge.operators.history import latest_by_key, latest_fields
from tripgauge.operators.kinematics import kinematics, rolling_stats
from tripgauge.operators.metrics import last_samples
from tripgauge.operators.quality import dedup_lww, dedup_whole_trips
from tripgauge.operators.slicing import WHOLE_TRIPS, plan_slices, trip_ordinal
from tripgauge.plans import serving
from tripgauge.plans.fleet_report import scored_fleet
from tripgauge.plans.trip_report import audit_view, enriched_samples, scored_trips, trip_reports
from tripgauge.profiles import CURRENT, LEGACY
from tripgauge.sources.keyed_log import BUCKET, KeyedLog
from tripgauge.sources.telemetry import read_bucketed, write_bucketed

SHUFFLE = re.compile(r"(?<!Broadcast)Exchange (hash|range|single|Single)")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(SHUFFLE.findall(plan(df)))


@pytest.fixture
def stored(spark, golden, tmp_path):
    golden.write.parquet(str(tmp_path / "t"))
    return spark.read.parquet(str(tmp_path / "t"))


def test_one_shuffle_from_samples_to_reports(stored):
    assert shuffles(scored_trips(stored)) == 1
    assert shuffles(audit_view(scored_trips(stored))) == 1
    assert shuffles(trip_reports(stored)) == 1


def test_bucketed_table_needs_no_shuffle(spark, golden, tmp_path):
    write_bucketed(golden, "bucketed_golden", str(tmp_path / "b"), 4)
    table = spark.table("bucketed_golden")
    assert shuffles(scored_trips(table)) == 0
    assert scored_trips(table).collect() and table.count() == 8
    spark.sql("DROP TABLE bucketed_golden")


@pytest.fixture
def by_slice(spark, telemetry, tmp_path):
    """A long trip with positions out of bounds wherever a slice may begin, a short one, and
    rows without a trip; as a plain table and by slice."""
    rows = [("L", i // 3 * 1.0, 50.0 + i * 37 % 61, 91.0 if i % 4 else -12.0, -77.0) for i in range(120)]
    rows += [("S", float(i), 40.0 + i) for i in range(3)] + [(None, float(i), 30.0 + i) for i in range(40)]
    plain = telemetry(rows)
    write_bucketed(plain, "by_slice", str(tmp_path / "s"), 4, slice_rows=16)
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    yield plain, *read_bucketed(spark, "by_slice")
    spark.conf.unset("spark.sql.legacy.bucketedTableScan.outputOrdering")
    spark.sql("DROP TABLE by_slice")


def test_slices_of_long_trips_are_read_without_exchange_or_sort(by_slice):
    _, table, slices = by_slice
    assert table.filter("context").count() > 0 and table.select("trip_id", "slice").distinct().count() > 8
    text = plan(kinematics(table, LEGACY, slices=slices))
    assert not SHUFFLE.search(text) and "Sort " not in text
    # What is shuffled to score trips are sums by trip and slice.
    text = plan(scored_trips(table, slices=slices))
    assert len(SHUFFLE.findall(text)) == 1 and "Sort " not in text


def test_stored_slices_give_what_whole_trips_give(by_slice):
    plain, table, slices = by_slice

    def rows(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    for profile in (CURRENT, LEGACY):
        got = enriched_samples(table, profile, slices=slices)
        want = enriched_samples(plain, profile, slices=WHOLE_TRIPS)
        assert rows(got.select(want.columns)) == rows(want)
    got = rolling_stats(with_accel(table), slices=slices)
    want = rolling_stats(plain.withColumn("accel", F.col("speed_kmh")), slices=WHOLE_TRIPS)
    assert rows(got.select(want.columns)) == rows(want)
    got = trip_ordinal(table, slices).select("seq", "ordinal")
    assert rows(got) == rows(trip_ordinal(plain, WHOLE_TRIPS).select("seq", "ordinal"))
    with pytest.raises(ValueError, match="ahead of a slice"):
        rolling_stats(with_accel(table), rows=30, slices=slices)


def with_accel(table):
    """A stand-in for acceleration that context rows have too."""
    return table.withColumn("accel", F.col("speed_kmh"))


def test_fleet_report_is_one_aggregate(stored):
    text = plan(scored_fleet(stored))
    assert len(SHUFFLE.findall(text)) == 2 and text.count("Window ") == 1


def test_metrics_stay_in_hash_aggregates(stored):
    text = plan(scored_trips(stored))
    assert "HashAggregate" in text and "ObjectHashAggregate" not in text and "SortAggregate" not in text


def test_bounds_and_columns_reach_the_scan(spark, stored):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = plan(audit_view(scored_trips(stored)))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(lat,-90.0)" in text and "LessThanOrEqual(lon,180.0)" in text
    assert "ingested_at" not in text


def test_whole_documents_are_not_sorted_by_aggregates(stored):
    reports = trip_reports(stored).withColumns({"batch_id": F.lit(1), "doc_seq": F.lit(1)})
    documents = reports.select("trip_id", "doc_seq", "batch_id", "basic", "risk", "position")
    for df in (
        latest_by_key(documents, "trip_id", "batch_id", "created_seq"),
        latest_fields(documents),
        serving.latest_per_trip(documents.withColumn("processed_at", F.col("doc_seq"))),
    ):
        assert "SortAggregate" not in plan(df)
    assert plan(serving.latest_per_trip(stored, "event_time")).count("WindowGroupLimit") == 2


def test_lookup_reads_one_bucket(spark, golden, tmp_path):
    log = KeyedLog(spark, str(tmp_path / "log"), golden.schema)
    first = golden.dropDuplicates(["trip_id"])
    log.write(first, 0)
    log.compact(0)
    log.write(first, 1)
    found = log.latest(key="T1")
    # Long texts of plans are cut, by the length of column numbers too.
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        text = found._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pruned = re.findall(rf"PartitionFilters: \[[^\]]*{BUCKET}#\d+ = \d+", text)
    assert len(pruned) == 2
    assert [(r.trip_id, r.batch_id, r.created_seq) for r in found.collect()] == [("T1", 1, 0)]
    assert log.latest(key="none").isEmpty()


def test_lookup_skips_what_lies_beside_the_key(spark, tmp_path):
    """Files are sorted by key: of a batch of many pages one lookup reads few."""
    trips = 400_000
    rows = spark.range(trips).select(F.format_string("T%06d", F.col("id") * 7919 % trips).alias("trip_id"), "id")
    log = KeyedLog(spark, str(tmp_path / "log"), rows.schema, buckets=2)
    log.write(rows.repartition(8), 0)
    files = [f for f in (tmp_path / "log" / "batches").rglob("*.parquet")]
    for f in files:
        keys = pq.ParquetFile(f).read(columns=["trip_id"]).column(0).to_pylist()
        assert keys == sorted(keys)
    assert sum(pq.ParquetFile(f).metadata.num_rows for f in files) == trips
    found = spark.read.parquet(*map(str, files)).filter("trip_id = 'T000500'")
    found.collect()
    nodes = found._jdf.queryExecution().executedPlan().collectLeaves()
    read = sum(nodes.apply(i).metrics().apply("numOutputRows").value() for i in range(nodes.length()))
    # A page holds 20,000 rows, and the page index leaves one or two a file.
    assert 1 <= read < trips * 0.25
    assert [r.id for r in log.latest(key="T000500").collect()] == [r.id for r in rows.filter("trip_id = 'T000500'").collect()]


def test_last_writes_of_batches_need_no_sort(stored):
    text = plan(dedup_lww(stored.withColumn("batch_id", F.lit(1).cast("long"))))
    assert "SortAggregate" not in text and "HashAggregate" in text


def test_short_trips_are_shuffled_and_sorted_once_to_drop_copies_and_score(stored):
    batches = stored.withColumn("batch_id", F.lit(1).cast("long"))
    slices = plan_slices(batches)
    assert not slices.needed
    text = plan(scored_trips(dedup_whole_trips(batches).drop("batch_id"), CURRENT, 5, slices))
    assert len(SHUFFLE.findall(text)) == 1 and len(re.findall(r"\bSort \[", text)) == 1


def test_top_rows_are_cut_before_the_shuffle(stored):
    text = plan(last_samples(stored, 5))
    assert text.count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in plan(serving.latest_report(stored.withColumn("created_seq", F.col("seq"))))


def test_no_python_in_batch_plans(stored):
    parsed = stored.select(parse_time(F.col("trip_id"), F.current_timestamp()))
    reports = trip_reports(stored)
    for df in (reports, serving.sample_log(reports), serving.report_json(reports), dedup_lww(stored), parsed):
        assert not re.search(r"Python|ArrowEval|MapInPandas", plan(df))


def test_slices_force_no_broadcast(spark, stored):
    """Spark broadcasts the cut points where it finds them small, and not otherwise."""
    slices = plan_slices(stored, slice_rows=2)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(scored_trips(stored, slices=slices))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BroadcastExchange" not in text

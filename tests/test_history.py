"""Merging points into histories, and replacing documents by key."""

from __future__ import annotations

from datetime import datetime

from conftest import by_key
from pyspark.sql import functions as F

from tripgauge.functions.columns import first_truthy_number, parse_time
from tripgauge.operators.history import merge_history, replace_documents
from tripgauge.schema import HISTORY, INCOMING_DOCUMENT
from tripgauge.plans.trip_report import trip_reports
from tripgauge.sources.keyed_log import KeyedLog
from tripgauge.sources.sinks import read_histories, upsert_histories

def now():
    return F.lit("2026-05-07 00:00:00").cast("timestamp")


def point(timestamp, speed=None, avg=None, top=None, time=None):
    return (timestamp, time, speed, avg, top)


def documents(spark, *docs):
    rows = [(i, trip, (avg, avg), (score,), points) for i, (trip, avg, score, points) in enumerate(docs, 1)]
    return spark.createDataFrame(rows, INCOMING_DOCUMENT)


def empty(spark):
    return spark.createDataFrame([], HISTORY)


def test_merge_sets_fields_and_sorts_points(spark):
    batch = documents(
        spark,
        ("A", 50.0, 10.0, [point("2026-05-06 14:00:02", "7"), point("2026-05-06T14:00:01.5", "6")]),
        ("A", 55.0, 20.0, [point(" 2026-05-06 14:00:03.25 ", "8")]),
        ("", 1.0, 1.0, [point("2026-05-06 14:00:02", "7")]),
        (None, 1.0, 1.0, [point("2026-05-06 14:00:02", "7")]),
        ("B", 1.0, 2.0, None),
    )
    merged = by_key(merge_history(empty(spark), batch, now()))
    assert set(merged) == {"A", "B"}
    a = merged["A"]
    assert (a.avg_speed_kmh, a.max_speed_kmh, a.global_risk_score) == (55.0, 55.0, 20.0)
    assert a.processed_at == datetime(2026, 5, 7)
    assert [p.avg_speed_kmh for p in a.points] == [6.0, 7.0, 8.0]
    assert a.points[0].timestamp == datetime(2026, 5, 6, 14, 0, 1, 500000)
    assert merged["B"].points == []


def test_merge_keeps_the_newest(spark):
    def many(first, n):
        return [point(f"2026-05-06 14:{i // 60:02d}:{i % 60:02d}", str(float(i + 1))) for i in range(first, first + n)]

    stored = merge_history(empty(spark), documents(spark, ("A", 1.0, 1.0, many(0, 70))), now())
    merged = merge_history(stored, documents(spark, ("A", 2.0, 2.0, many(70, 80)), ("C", 1.0, 1.0, many(0, 1))), now())
    trips = by_key(merged)
    assert [p.avg_speed_kmh for p in trips["A"].points] == [float(i) for i in range(51, 151)]
    assert len(trips["C"].points) == 1
    # A trip without news keeps its document.
    kept = by_key(merge_history(merged, documents(spark, ("C", 9.0, 9.0, None)), now()))
    assert len(kept["A"].points) == 100 and kept["A"].avg_speed_kmh == 2.0 and kept["C"].avg_speed_kmh == 9.0


def test_absent_fields_keep_what_is_stored(spark):
    schema = "doc_seq long, trip_id string, basic struct<avg_speed_kmh double, max_speed_kmh double>, " \
             "risk struct<score double>, position struct<lat double, lon double>, " \
             "points array<struct<time string, speed double>>"
    rows = [
        (1, "A", (5.0, 6.0), (7.0,), (1.0, 2.0), [("2026-05-06 14:00:02", 3.0)]),
        (2, "A", None, (8.0,), None, None),
        (None, "B", None, None, (3.0, 4.0), []),
    ]
    merged = by_key(merge_history(empty(spark), spark.createDataFrame(rows, schema), now()))
    a, b = merged["A"], merged["B"]
    assert (a.basic.avg_speed_kmh, a.risk.score, a.position.lat, len(a.points)) == (5.0, 8.0, 1.0, 1)
    # The headline figures are those of the last document.
    assert (a.avg_speed_kmh, a.global_risk_score) == (None, 8.0)
    assert (b.position.lon, b.basic, b.points) == (4.0, None, [])


def test_stored_histories(spark, golden, tmp_path):
    path = str(tmp_path / "histories")
    reports = trip_reports(golden).withColumn("doc_seq", F.lit(1).cast("long"))
    upsert_histories(reports, path, 0)
    first = by_key(read_histories(spark, path))
    assert first["T1"].lineage.engine and first["T1"].basic.samples == 5 and len(first["T1"].points) == 5
    late = documents(spark, ("T1", 9.0, 9.0, [point("2026-05-07 00:00:00", "7")]))
    for _ in range(2):
        upsert_histories(late, path, 1)
    got = by_key(read_histories(spark, path))
    assert [p.avg_speed_kmh for p in got["T1"].points][-1] == 7.0 and len(got["T1"].points) == 6
    assert (got["T1"].batch_id, got["T1"].created_seq, got["T1"].basic.avg_speed_kmh) == (1, 0, 9.0)
    assert got["T1"].position == first["T1"].position and got["T2"] == first["T2"]


def test_replay_duplicates_unless_deduped(spark):
    batch = documents(spark, ("A", 1.0, 1.0, [point("2026-05-06 14:00:02", "7"), point("2026-05-06 14:00:03", "8")]))
    once = merge_history(empty(spark), batch, now())
    again = merge_history(once, batch, now()).head()
    assert [p.avg_speed_kmh for p in again.points] == [7.0, 7.0, 8.0, 8.0]
    deduped = merge_history(once, batch, now(), dedupe=True)
    assert deduped.select("trip_id", "points").collect() == once.select("trip_id", "points").collect()


def test_time_shapes(spark):
    texts = {
        "2026-05-06 14:00:39.165": datetime(2026, 5, 6, 14, 0, 39, 165000),
        "2026-05-06 14:00:39": datetime(2026, 5, 6, 14, 0, 39),
        "2026-05-06T14:00:39.165": datetime(2026, 5, 6, 14, 0, 39, 165000),
        "2026-05-06T14:00:39": datetime(2026, 5, 6, 14, 0, 39),
        "  2026-05-06 14:00:39.1  ": datetime(2026, 5, 6, 14, 0, 39, 100000),
        "2026-05-06 14:00:39.123456": datetime(2026, 5, 6, 14, 0, 39, 123456),
        "2026-05-06": datetime(2026, 5, 6),
        "2026-05-06T14:00:39Z": datetime(2026, 5, 6, 14, 0, 39),
        "2026-5-6 4:00:39": datetime(2026, 5, 6, 4, 0, 39),
        "garbage": datetime(2026, 5, 7),
        "2026-13-45 99:00:00": datetime(2026, 5, 7),
        "": datetime(2026, 5, 7),
    }
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r.text: r.parsed for r in df.withColumn("parsed", parse_time(F.col("text"), now())).collect()}
    assert got == texts
    assert spark.range(1).select(parse_time(F.lit(None).cast("string"), now())).head()[0] == datetime(2026, 5, 7)


def test_first_truthy_number(spark):
    cases = [
        (("0", "5", "6"), 5.0), ((None, "5", "6"), 5.0), (("", None, "6"), 6.0), (("0.0", "0", None), 0.0),
        ((None, None, None), 0.0), (("fast", "5", "6"), 0.0), (("7.5", "5", "6"), 7.5),
    ]
    df = spark.createDataFrame([c for c, _ in cases], "a string, b string, c string")
    got = [r[0] for r in df.select(first_truthy_number(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == [want for _, want in cases]


def test_replace_documents(spark):
    schema = "trip_id string, score double, batch_id long"
    existing = spark.createDataFrame([("A", 1.0, 1), ("B", None, 1)], schema)
    updates = spark.createDataFrame([("B", 2.0, 2), ("C", None, 2)], schema)
    got = by_key(replace_documents(existing, updates))
    assert {k: (r.score, r.batch_id, r.created_seq) for k, r in got.items()} == {
        "A": (1.0, 1, 1), "B": (2.0, 2, 1), "C": (None, 2, 2),
    }
    replaced = replace_documents(replace_documents(existing, updates),
                                 spark.createDataFrame([("B", None, 3)], schema))
    b = by_key(replaced)["B"]
    assert (b.score, b.batch_id, b.created_seq) == (None, 3, 1)


def test_keyed_log(spark, tmp_path):
    schema = spark.createDataFrame([], "trip_id string, score double").schema
    log = KeyedLog(spark, str(tmp_path / "log"), schema)
    assert log.latest().count() == 0

    def write(batch_id, **scores):
        log.write(spark.createDataFrame(list(scores.items()), schema), batch_id)

    def state(**kwargs):
        return {r.trip_id: (r.score, r.batch_id, r.created_seq) for r in log.latest(**kwargs).collect()}

    write(0, A=1.0, B=1.0)
    write(1, B=2.0, C=2.0)
    want = {"A": (1.0, 0, 0), "B": (2.0, 1, 0), "C": (2.0, 1, 1)}
    assert state() == want
    write(1, B=2.0, C=2.0)
    assert state() == want and log.history().count() == 4
    assert state(before=1) == {"A": (1.0, 0, 0), "B": (1.0, 0, 0)}
    log.compact(1)
    assert state() == want
    write(2, A=3.0)
    write(1, B=9.0)
    # Batch 1 is folded in; what lies in its directory no longer counts.
    assert state() == {**want, "A": (3.0, 2, 0)}
    log.compact(2)
    assert state() == {**want, "A": (3.0, 2, 0)}
    # A snapshot that was never committed is not read.
    spark.createDataFrame([("X", 0.0, 9, 9)], "trip_id string, score double, batch_id long, created_seq long") \
        .write.parquet(str(tmp_path / "log/snapshots/9"))
    assert "X" not in state()
    log.vacuum()
    assert state() == {**want, "A": (3.0, 2, 0)} and log.history().count() == 0
    write(3, A=4.0)
    assert state() == {**want, "A": (4.0, 3, 0)}

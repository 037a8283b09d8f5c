"""Named queries over the test tables, each a callable ``(spark, sf_dir) -> DataFrame``.

Times leave as microseconds and doubles are rounded where the order of addition could
show, so that results compare by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripgauge.functions.columns import (
    accel_band,
    is_hard_brake,
    is_speeding,
    parse_time,
    stable_round,
    time_text,
)
from tripgauge.operators.history import replace_documents
from tripgauge.operators.kinematics import kinematics, rolling_stats
from tripgauge.operators.metrics import last_points, last_position, trip_metrics
from tripgauge.operators.quality import dedup_lww, filter_coordinates, retain
from tripgauge.operators.slicing import plan_slices, trip_ordinal
from tripgauge.plans import serving
from tripgauge.plans.fleet_report import build_fleet_report, scored_fleet
from tripgauge.plans.runs import run_fleet, run_trips
from tripgauge.plans.trip_report import audit_view, clean, enriched_samples, scored_trips, trip_reports
from tripgauge.profiles import CURRENT, LAT_MAX, LAT_MIN, LEGACY, LON_MAX, LON_MIN, RETENTION_SECONDS
from tripgauge.session import scratch_dir
from tripgauge.sources.adapters import arrivals, telemetry_from_events
from tripgauge.sources.keyed_log import KeyedLog
from tripgauge.sources.sinks import audit_rows, read_audit, read_histories, read_reports, upsert_histories
from tripgauge.sources.telemetry import (
    append_telemetry,
    normalize,
    read_bucketed,
    read_csv,
    read_telemetry,
    write_bucketed,
    write_clustered,
)
from tripgauge.streaming.cycle import Cycle, run_cycle, start_cycle
from tripgauge.streaming.feed import report_feed
from tripgauge.streaming.keyed_state import metric_log, start_carried, start_events, start_live, start_summaries
from tripgauge.streaming.incremental import start_incremental, state_log, state_metrics

# Trips of the test tables are short; this many points makes the cut visible.
KEEP = 20
# Batches of the streamed queries; the retention spans more than one of them.
ARRIVALS = 5
# Low enough to slice every trip of the test tables.
SLICE_ALL = 16
TRIP = "TRIP-7"

Query = Callable[[SparkSession, str], DataFrame]


def micros(column: str):
    return F.unix_micros(column)


def instant(text: str):
    return F.lit(text).cast("timestamp")


def rounded_metrics(scored: DataFrame) -> DataFrame:
    return scored.select(
        "trip_id",
        "samples",
        stable_round(F.col("avg_speed_kmh"), 6).alias("avg_speed_kmh"),
        "max_speed_kmh",
        "speeding_alerts",
        stable_round(F.col("accel_variance"), 4).alias("accel_variance"),
        "hard_brakes",
        *[c for c in ("risk_score",) if c in scored.columns],
    )


def coordinate_filter(spark: SparkSession, sf: str) -> DataFrame:
    kept = filter_coordinates(telemetry_from_events(spark, sf))
    return kept.select("trip_id", micros("event_time").alias("event_us"), "lat", "lon", "speed_kmh", "seq")


def speeding_samples(spark: SparkSession, sf: str) -> DataFrame:
    fast = clean(telemetry_from_events(spark, sf), CURRENT).filter(is_speeding(CURRENT))
    return fast.select("trip_id", "seq", "speed_kmh")


def hard_brake_samples(spark: SparkSession, sf: str) -> DataFrame:
    samples = enriched_samples(telemetry_from_events(spark, sf), CURRENT)
    return samples.filter(is_hard_brake(CURRENT)).select("trip_id", "seq", "accel")


def _kinematic_columns(samples: DataFrame) -> DataFrame:
    return samples.select(
        "trip_id",
        "seq",
        micros("event_time").alias("event_us"),
        "speed_kmh",
        "prev_speed",
        micros("prev_time").alias("prev_us"),
        "delta_v",
        "delta_t",
        "accel",
    )


def kinematics_current(spark: SparkSession, sf: str) -> DataFrame:
    return _kinematic_columns(enriched_samples(telemetry_from_events(spark, sf), CURRENT))


def kinematics_legacy(spark: SparkSession, sf: str) -> DataFrame:
    return _kinematic_columns(enriched_samples(telemetry_from_events(spark, sf), LEGACY))


def skew_safe_kinematics(spark: SparkSession, sf: str) -> DataFrame:
    samples = enriched_samples(telemetry_from_events(spark, sf), CURRENT, slice_rows=SLICE_ALL)
    return _kinematic_columns(samples)


def rolling_speed(spark: SparkSession, sf: str) -> DataFrame:
    telemetry = clean(telemetry_from_events(spark, sf), CURRENT)
    slices = plan_slices(telemetry)
    rolled = rolling_stats(kinematics(telemetry, CURRENT, slices=slices), slices=slices)
    return rolled.select(
        "trip_id",
        "seq",
        stable_round(F.col("rolling_avg_speed"), 4).alias("rolling_avg_speed"),
        "rolling_max_speed",
        stable_round(F.col("rolling_avg_accel"), 3).alias("rolling_avg_accel"),
    )


def trip_metrics_query(spark: SparkSession, sf: str) -> DataFrame:
    return rounded_metrics(scored_trips(telemetry_from_events(spark, sf)).drop("risk_score"))


def trip_risk_score(spark: SparkSession, sf: str) -> DataFrame:
    return rounded_metrics(scored_trips(telemetry_from_events(spark, sf)))


def skew_safe_trip_risk(spark: SparkSession, sf: str) -> DataFrame:
    return rounded_metrics(scored_trips(telemetry_from_events(spark, sf), slice_rows=SLICE_ALL))


def exact_trip_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics from exact sums, and whether samples dealt out otherwise give the same bits."""
    enriched = enriched_samples(telemetry_from_events(spark, sf), CURRENT)
    one = trip_metrics(enriched, CURRENT, exact=True)
    other = trip_metrics(enriched.repartition(7, "seq"), CURRENT, exact=True)
    raw = ["avg_speed_kmh", "accel_variance"]
    alike = other.select("trip_id", *[F.col(c).alias(f"other_{c}") for c in raw])
    same = F.lit(True)
    for c in raw:
        same = same & F.col(c).eqNullSafe(F.col(f"other_{c}"))
    return one.join(alike, "trip_id").select(
        "trip_id",
        "samples",
        *[stable_round(F.col(c), 4).alias(c) for c in raw],
        same.alias("same_bits"),
    )


def bucketed_trip_risk(spark: SparkSession, sf: str) -> DataFrame:
    """Scores off a table bucketed by trip and slice."""
    table = "tripgauge_samples_by_slice"
    write_bucketed(telemetry_from_events(spark, sf), table, scratch_dir(spark, "bucketed"), 8, SLICE_ALL)
    stored, slices = read_bucketed(spark, table)
    return rounded_metrics(scored_trips(stored, slices=slices))


def audit_rows_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = audit_rows(scored_trips(telemetry_from_events(spark, sf)), "run-1")
    return rows.select(
        "trip_id",
        stable_round(F.col("avg_speed_kmh"), 6).alias("avg_speed_kmh"),
        "max_speed_kmh",
        "speeding_alerts",
        stable_round(F.col("accel_variance"), 4).alias("accel_variance"),
        "hard_brakes",
        "risk_score",
        "run_id",
    )


def fleet_report_legacy(spark: SparkSession, sf: str) -> DataFrame:
    report = build_fleet_report(telemetry_from_events(spark, sf))
    return report.select(
        "basic.samples", "basic.avg_speed_kmh", "basic.max_speed_kmh", "basic.speeding_alerts",
        "basic.speed_limit", "risk.accel_variance", "risk.accel_mean",
        F.round("risk.accel_mean_square", 4).alias("accel_mean_square"),
        "risk.hard_brakes", "risk.brake_threshold", "risk.score",
        F.col("risk.weights.speeding").alias("w_speeding"),
        F.col("risk.weights.variance").alias("w_variance"),
        F.col("risk.weights.braking").alias("w_braking"),
    )


def skew_safe_fleet(spark: SparkSession, sf: str) -> DataFrame:
    scored = scored_fleet(telemetry_from_events(spark, sf), slice_rows=SLICE_ALL)
    return scored.select("samples", "speeding_alerts", "accel_variance", "hard_brakes", "risk_score")


def last_points_query(spark: SparkSession, sf: str) -> DataFrame:
    points = last_points(clean(telemetry_from_events(spark, sf), CURRENT), CURRENT, KEEP)
    return points.select(
        "trip_id", "position", micros("event_time").alias("event_us"), "speed_kmh", "accel"
    )


def last_position_query(spark: SparkSession, sf: str) -> DataFrame:
    return last_position(clean(telemetry_from_events(spark, sf), CURRENT))


def retention_window(spark: SparkSession, sf: str) -> DataFrame:
    telemetry = telemetry_from_events(spark, sf)
    newest = telemetry.agg(F.max("ingested_at")).scalar()
    return retain(telemetry, newest).select("trip_id", "seq", micros("ingested_at").alias("ingested_us"))


def lww_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every sample in the second half of the period is written again later on, 10 km/h
    faster."""
    telemetry = telemetry_from_events(spark, sf)
    again = telemetry.filter(F.col("event_time") >= instant("2024-01-01 00:21:36")).withColumns(
        {"speed_kmh": F.col("speed_kmh") + 10.0, "seq": F.col("seq") + 1_000_000_000_000}
    )
    kept = dedup_lww(telemetry.unionByName(again))
    return kept.select("trip_id", micros("event_time").alias("event_us"), "speed_kmh", "seq")


def lww_rewrites(spark: SparkSession, sf: str) -> DataFrame:
    """Every third sample is written again a minute later, by a writer whose sequence starts
    anew or is missing; the later write counts."""
    telemetry = telemetry_from_events(spark, sf)
    anew = F.when(F.col("seq") % 2 == 0, -F.col("seq"))
    again = telemetry.filter(F.col("seq") % 3 == 0).withColumns({
        "speed_kmh": F.col("speed_kmh") + 10.0,
        "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 MINUTE"),
        "seq": anew,
    })
    kept = dedup_lww(telemetry.unionByName(again))
    return kept.select(
        "trip_id", micros("event_time").alias("event_us"), "speed_kmh", "seq",
        micros("ingested_at").alias("ingested_us"),
    )


def _reports(spark: SparkSession, sf: str, keep: int = KEEP) -> DataFrame:
    return trip_reports(
        telemetry_from_events(spark, sf), as_of=instant("2024-01-02 03:04:05"), keep_points=keep
    )


def _stored_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Reports as a store would hold them: created with the trip's first sample,
    processed with its newest."""
    first = telemetry_from_events(spark, sf).groupBy("trip_id").agg(F.min("seq").alias("created_seq"))
    newest = F.to_timestamp(F.try_element_at("points", F.lit(-1))["time"])
    return _reports(spark, sf).join(first, "trip_id").withColumn("processed_at", newest)


def trip_report_flat(spark: SparkSession, sf: str) -> DataFrame:
    oldest, newest = F.get("points", F.lit(0)), F.try_element_at("points", F.lit(-1))
    return _reports(spark, sf).select(
        "trip_id", "avg_speed_kmh", "max_speed_kmh", "global_risk_score",
        "position.lat", "position.lon", "basic.samples", "basic.speeding_alerts", "basic.speed_limit",
        "risk.accel_variance", "risk.hard_brakes", "risk.brake_threshold",
        F.col("risk.weights.speeding").alias("w_speeding"),
        F.col("risk.weights.variance").alias("w_variance"),
        F.col("risk.weights.braking").alias("w_braking"),
        F.size("points").alias("n_points"),
        oldest["time"].alias("oldest_time"),
        newest["time"].alias("newest_time"),
        newest["speed"].alias("newest_speed"),
        newest["accel"].alias("newest_accel"),
        micros("processed_at").alias("processed_us"),
    )


def report_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Reports of the first fifteen minutes, then the trips still moving near the end
    reported anew from all their samples."""
    telemetry = telemetry_from_events(spark, sf)
    early = scored_trips(telemetry.filter(F.col("event_time") < instant("2024-01-01 00:15:00")))
    late = scored_trips(telemetry, keep_points=1).filter(
        F.get("points", F.lit(0))["event_time"] >= instant("2024-01-01 00:42:30")
    )
    stored = replace_documents(
        audit_view(early).withColumn("batch_id", F.lit(1)),
        audit_view(late).withColumn("batch_id", F.lit(2)),
    )
    return stored.select(
        "trip_id", "speeding_alerts", "hard_brakes", "max_speed_kmh", "risk_score", "batch_id", "created_seq"
    )


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    """One document per event with its point in the text shapes a merge must read."""
    telemetry = telemetry_from_events(spark, sf)
    kind, shape = F.col("seq") % 4, F.col("seq") % 3
    time, speed = F.col("event_time"), F.col("speed_kmh").cast("string")
    text = (
        F.when(kind == 0, F.date_format(time, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .when(kind == 1, F.date_format(time, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 2, F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .otherwise(F.concat(F.lit("  "), F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(" ")))
    )
    point = F.struct(
        F.when(kind < 2, text).alias("timestamp"),
        F.when(kind >= 2, text).alias("time"),
        F.when(shape == 0, speed).when(shape == 1, "0.0").alias("speed"),
        F.when(shape == 1, speed).alias("avg_speed_kmh"),
        speed.alias("max_speed_kmh"),
    )
    return telemetry.select(
        F.col("seq").alias("doc_seq"),
        F.when(F.col("seq") % 50 != 0, F.col("trip_id")).otherwise(F.lit("")).alias("trip_id"),
        F.struct(
            F.col("speed_kmh").alias("avg_speed_kmh"), (F.col("speed_kmh") + 1.0).alias("max_speed_kmh")
        ).alias("basic"),
        F.struct(F.least("speed_kmh", F.lit(100.0)).alias("score")).alias("risk"),
        F.when(shape != 0, F.struct("lat", "lon")).alias("position"),
        F.when(F.col("seq") % 5 == 0, F.struct(F.concat(F.lit("doc-"), F.col("seq")).alias("engine"))).alias("lineage"),
        F.array(point).alias("points"),
        "event_time",
    )


def history_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Documents merged into the stored histories in three batches, by time."""
    documents, path = _documents(spark, sf), scratch_dir(spark, "history")
    first, second = (F.col("event_time") >= instant(f"2024-01-01 00:{at}") for at in ("14:24", "28:48"))
    for batch_id, chosen in enumerate((~first, first & ~second, second)):
        batch = documents.filter(chosen).drop("event_time")
        upsert_histories(batch, path, batch_id, instant("2024-01-02 00:00:00"), KEEP)
    return read_histories(spark, path).select(
        "trip_id", "avg_speed_kmh", "max_speed_kmh", "global_risk_score", "position.lat", "lineage.engine",
        "batch_id", "created_seq", F.posexplode("points").alias("pos", "p"),
    ).select(
        "trip_id", "avg_speed_kmh", "max_speed_kmh", "global_risk_score", "lat", "engine", "batch_id", "created_seq",
        "pos", micros("p.timestamp").alias("point_us"), F.col("p.avg_speed_kmh").alias("point_speed"),
    )


def timestamp_parse(spark: SparkSession, sf: str) -> DataFrame:
    texts = _documents(spark, sf).select(
        "doc_seq",
        F.when(F.col("doc_seq") % 5 == 4, F.concat(F.lit("about "), F.col("doc_seq")))
        .otherwise(F.coalesce(F.get("points", F.lit(0))["timestamp"], F.get("points", F.lit(0))["time"]))
        .alias("text"),
    )
    parsed = parse_time(F.col("text"), instant("2024-01-02 00:00:00"))
    return texts.select("doc_seq", F.unix_micros(parsed).alias("parsed_us"))


# Ways to write an instant, to the second.
WRITTEN = (
    "MMMM d, yyyy h:mm:ss a", "EEEE, dd MMM yyyy HH:mm:ss", "d-MMM-yyyy HH:mm:ss", "MM/dd/yyyy hh:mm:ssa",
    "dd MMMM yyyy 'at' HH:mm:ss", "HH:mm:ss yyyy/MM/dd", "dd MMM yy HH:mm:ss", "EEE MMM d HH:mm:ss yyyy",
)


def timestamp_parse_lenient(spark: SparkSession, sf: str) -> DataFrame:
    """Every sample's time, to the second, in a form Spark's own cast doesn't read; each
    ninth is no date at all."""
    samples = telemetry_from_events(spark, sf)
    form = F.col("seq") % (len(WRITTEN) + 1)
    text = F.lit("about noon")
    for i, pattern in enumerate(WRITTEN):
        text = F.when(form == i, F.date_format("event_time", pattern)).otherwise(text)
    parsed = parse_time(text, instant("2024-01-02 00:00:00"))
    return samples.select("seq", F.unix_micros(parsed).alias("parsed_us"))


def _headline(reports: DataFrame) -> DataFrame:
    return reports.select(
        "trip_id", "created_seq", micros("processed_at").alias("processed_us"), "global_risk_score", "position.lat"
    )


def latest_report(spark: SparkSession, sf: str) -> DataFrame:
    return _headline(serving.latest_report(_stored_reports(spark, sf)))


def report_history(spark: SparkSession, sf: str) -> DataFrame:
    return _headline(serving.report_history(_stored_reports(spark, sf)))


def report_history_processed(spark: SparkSession, sf: str) -> DataFrame:
    return _headline(serving.report_history(_stored_reports(spark, sf), by="processed_at"))


def latest_for_trip(spark: SparkSession, sf: str) -> DataFrame:
    return _headline(serving.latest_for_trip(_stored_reports(spark, sf), TRIP))


def _updates(spark: SparkSession, sf: str) -> DataFrame:
    """Every sample as an update of its trip. Positions outside the bounds arrive as
    null or NaN."""
    lat, lon = F.col("lat"), F.col("lon")
    return telemetry_from_events(spark, sf).select(
        "trip_id",
        F.col("event_time").alias("processed_at"),
        F.col("seq").alias("batch_id"),
        F.struct(
            F.when(lat.between(LAT_MIN, LAT_MAX), lat).alias("lat"),
            F.when(lon.between(LON_MIN, LON_MAX), lon).otherwise(F.lit(float("nan"))).alias("lon"),
        ).alias("position"),
        "speed_kmh",
    )


def latest_per_trip(spark: SparkSession, sf: str) -> DataFrame:
    newest = serving.latest_per_trip(_updates(spark, sf))
    return newest.select("trip_id", micros("processed_at").alias("processed_us"), "batch_id", "speed_kmh")


def update_buffer(spark: SparkSession, sf: str) -> DataFrame:
    newest = serving.update_buffer(_updates(spark, sf))
    return newest.select("trip_id", micros("processed_at").alias("processed_us"), "batch_id", "speed_kmh")


def route_points(spark: SparkSession, sf: str) -> DataFrame:
    points = serving.route(_updates(spark, sf))
    return points.select("trip_id", F.col("ordinal").cast("long").alias("ordinal"), "lat", "lon")


def skew_safe_route(spark: SparkSession, sf: str) -> DataFrame:
    points = serving.route(_updates(spark, sf), slice_rows=SLICE_ALL)
    return points.select("trip_id", F.col("ordinal").cast("long").alias("ordinal"), "lat", "lon")


def risk_bands(spark: SparkSession, sf: str) -> DataFrame:
    return serving.risk_bands(_reports(spark, sf))


def accel_bands(spark: SparkSession, sf: str) -> DataFrame:
    samples = enriched_samples(telemetry_from_events(spark, sf), CURRENT)
    return (
        samples.groupBy("trip_id", accel_band(F.col("accel")).alias("band"))
        .agg(F.count(F.lit(1)).alias("samples"))
    )


def current_motion(spark: SparkSession, sf: str) -> DataFrame:
    return serving.current_motion(_reports(spark, sf)).withColumns({
        "gauge_angle": F.round("gauge_angle", 6),
        "needle_angle": F.round("needle_angle", 6),
    })


def speed_series(spark: SparkSession, sf: str) -> DataFrame:
    return serving.speed_series(_reports(spark, sf))


def weight_shares(spark: SparkSession, sf: str) -> DataFrame:
    return serving.weight_shares(_reports(spark, sf))


def alert_flags(spark: SparkSession, sf: str) -> DataFrame:
    return serving.alert_flags(_reports(spark, sf))


def sample_log(spark: SparkSession, sf: str) -> DataFrame:
    return serving.sample_log(_reports(spark, sf))


def lineage_log(spark: SparkSession, sf: str) -> DataFrame:
    return serving.lineage_log(_reports(spark, sf))


def report_json(spark: SparkSession, sf: str) -> DataFrame:
    return serving.report_json(_reports(spark, sf))


def report_json_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Values read back out of the JSON documents."""
    documents = serving.report_json(_reports(spark, sf))

    def field(path: str):
        return F.get_json_object("document", path)

    return documents.select(
        "trip_id",
        field("$.analyzed_at").alias("analyzed_at"),
        field("$.basic.samples").cast("long").alias("samples"),
        field("$.risk.score").cast("double").alias("score"),
        field("$.risk.weights.variance").cast("double").alias("w_variance"),
        field("$.points[0].time").alias("oldest_time"),
        field("$.points[0].speed").cast("double").alias("oldest_speed"),
        F.json_array_length(field("$.points")).alias("n_points"),
        field("$.project").alias("project"),
        field("$.processed_at").alias("processed_at"),
        field("$.avg_speed_kmh").cast("double").alias("avg_speed_kmh"),
        field("$.basic.max_speed_kmh").cast("double").alias("max_speed_kmh"),
        field("$.basic.speeding_alerts").cast("long").alias("speeding_alerts"),
        field("$.basic.speed_limit").cast("double").alias("speed_limit"),
        field("$.risk.accel_variance").cast("double").alias("accel_variance"),
        field("$.risk.hard_brakes").cast("long").alias("hard_brakes"),
        field("$.risk.brake_threshold").cast("double").alias("brake_threshold"),
        field("$.position.lat").cast("double").alias("lat"),
        field("$.position.lon").cast("double").alias("lon"),
        field("$.lineage.principles").alias("principles"),
    )


def feed_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """A poll for a trip there is, and one for a trip there is not."""
    reports = _stored_reports(spark, sf)
    found = serving.feed_snapshot(reports, TRIP).withColumn("asked", F.lit(TRIP))
    missing = serving.feed_snapshot(reports, "TRIP-NONE").withColumn("asked", F.lit("TRIP-NONE"))
    return found.unionByName(missing).select(
        "asked", "event", F.get_json_object("data", "$.trip_id").alias("trip_id"),
        F.get_json_object("data", "$.status").alias("status"),
    )


def normalized(spark: SparkSession, sf: str) -> DataFrame:
    """External column names in, engine names out."""
    external = telemetry_from_events(spark, sf).select(
        F.col("trip_id").alias("id_viaje"), F.col("event_time").alias("tiempo"),
        F.col("lat").alias("latitud"), F.col("lon").alias("longitud"), F.col("speed_kmh").alias("velocidad"), "seq",
    )
    named = normalize(external)
    return named.select(
        "trip_id", micros("event_time").alias("event_us"), "lat", "lon", "speed_kmh", "seq",
        F.col("ingested_at").isNull().alias("no_write_time"),
    )


def _write_csv(telemetry: DataFrame, path: str) -> None:
    """CSV with columns in an order of its own."""
    telemetry.select(
        F.col("lat").alias("latitud"),
        F.col("speed_kmh").alias("velocidad_kmh"),
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSZ").alias("tiempo"),
        F.col("lon").alias("longitud"),
        F.col("trip_id").alias("id_viaje"),
    ).write.option("header", True).csv(path)


def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Telemetry written as CSV and read back by name."""
    path = scratch_dir(spark, "csv")
    _write_csv(telemetry_from_events(spark, sf), path)
    rows = read_csv(spark, path)
    return rows.select("trip_id", micros("event_time").alias("event_us"), "speed_kmh", "lat", "lon")


def clustered_store(spark: SparkSession, sf: str) -> DataFrame:
    """Telemetry appended to a store, rewritten in trip and time order, and scored."""
    store = scratch_dir(spark, "store")
    append_telemetry(telemetry_from_events(spark, sf), f"{store}/arrived")
    write_clustered(read_telemetry(spark, "parquet", f"{store}/arrived"), f"{store}/clustered")
    return rounded_metrics(scored_trips(read_telemetry(spark, "parquet", f"{store}/clustered")))


def _by_time(telemetry: DataFrame) -> Column:
    """Which of ``ARRIVALS`` equal stretches of the whole period a sample falls into."""
    at = F.unix_micros("event_time")
    first, last = telemetry.agg(F.min(at), F.max(at)).head()
    return F.floor((at - F.lit(first)) * F.lit(ARRIVALS) / F.lit((last or 0) - (first or 0) + 1))


def _cycle_over(spark: SparkSession, sf: str, name: str, part: Callable[[DataFrame], Column], **settings) -> Cycle:
    """The repeating run over events that arrive in parts, one batch each."""
    path = scratch_dir(spark, name)
    cycle = Cycle(path, keep_points=KEEP, on_error="raise", **settings)
    telemetry = telemetry_from_events(spark, sf)
    for samples in arrivals(telemetry, f"{path}/arrived", part(telemetry), ARRIVALS):
        start_cycle(samples, cycle, f"{path}/checkpoint", None).awaitTermination()
    return cycle


def _final_audit(spark: SparkSession, cycle: Cycle) -> DataFrame:
    """Every trip's newest audit row, with the sample count of its newest report."""
    newest = Window.partitionBy("trip_id").orderBy(F.desc(F.col("run_id").cast("long")))
    rows = cycle.audit(spark).withColumn("nth", F.row_number().over(newest)).filter(F.col("nth") == 1)
    counts = cycle.reports(spark).latest().select("trip_id", F.col("basic.samples").cast("long").alias("samples"))
    return rounded_metrics(rows.join(counts, "trip_id"))


def stream_trip_risk(spark: SparkSession, sf: str) -> DataFrame:
    """The repeating run over the events as a stream, read back from its audit table."""
    return _final_audit(spark, _cycle_over(spark, sf, "cycle", _by_time, ttl_seconds=None))


def stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The same with arrivals out of order: every batch falls between the samples of the
    ones before."""
    return _final_audit(spark, _cycle_over(spark, sf, "late", lambda _: F.col("seq") % ARRIVALS, ttl_seconds=None))


def stream_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of which two are run again; each trip's final metrics and its audit rows."""
    cycle = Cycle(scratch_dir(spark, "replay"), ttl_seconds=None, keep_points=KEEP, on_error="raise")
    telemetry = telemetry_from_events(spark, sf)
    for i in (*range(ARRIVALS), 1, ARRIVALS - 1):
        run_cycle(telemetry.filter(F.col("seq") % ARRIVALS == i), cycle, i)
    runs = cycle.audit(spark).groupBy("trip_id").agg(F.count(F.lit(1)).alias("runs"))
    return _final_audit(spark, cycle).join(runs, "trip_id")


def stream_retained_risk(spark: SparkSession, sf: str) -> DataFrame:
    """What the last batch reports of the 600 seconds before the newest arrival."""
    cycle = _cycle_over(spark, sf, "retained", _by_time, clock="data")
    reports = cycle.reports(spark).latest().filter(F.col("batch_id") == ARRIVALS - 1)
    return reports.select(
        "trip_id", "basic.samples", "basic.speeding_alerts", "risk.hard_brakes", "global_risk_score"
    )


def incremental_trip_risk(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics carried from batch to batch, after the whole stream."""
    path = scratch_dir(spark, "incremental")
    state, telemetry = state_log(spark, f"{path}/state"), telemetry_from_events(spark, sf)
    for samples in arrivals(telemetry, f"{path}/arrived", _by_time(telemetry), ARRIVALS):
        start_incremental(samples, state, f"{path}/checkpoint").awaitTermination()
    return rounded_metrics(state_metrics(state.latest()))


def keyed_trip_risk(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics carried in keyed state, one summary per trip and batch, after the whole stream."""
    path = scratch_dir(spark, "carried")
    log, telemetry = metric_log(spark, f"{path}/metrics"), telemetry_from_events(spark, sf)
    for samples in arrivals(telemetry, f"{path}/arrived", _by_time(telemetry), ARRIVALS):
        start_summaries(samples, path, f"{path}/checkpoint-summaries").awaitTermination()
        start_carried(spark, path, log, f"{path}/checkpoint-state").awaitTermination()
    return rounded_metrics(state_metrics(log.latest()))


def _live_log(spark: SparkSession, sf: str, name: str, part: Callable[[DataFrame], Column], ttl: int | None) -> KeyedLog:
    path = scratch_dir(spark, name)
    log, telemetry = metric_log(spark, f"{path}/metrics"), telemetry_from_events(spark, sf)
    for samples in arrivals(telemetry, f"{path}/arrived", part(telemetry), ARRIVALS):
        start_live(samples, log, f"{path}/checkpoint", ttl_seconds=ttl).awaitTermination()
    return log


def keyed_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Samples kept in keyed state; every batch falls between the samples of the ones before."""
    log = _live_log(spark, sf, "repaired", lambda _: F.col("seq") % ARRIVALS, None)
    return rounded_metrics(state_metrics(log.latest()))


def keyed_retained_risk(spark: SparkSession, sf: str) -> DataFrame:
    """What state holds of the 600 seconds before the newest arrival, the rest expired by timers."""
    live = state_metrics(_live_log(spark, sf, "expiring", _by_time, RETENTION_SECONDS).latest()).filter("samples > 0")
    return live.select(
        "trip_id", F.col("samples").cast("int").alias("samples"), F.col("speeding_alerts").cast("int").alias("speeding_alerts"),
        F.col("hard_brakes").cast("int").alias("hard_brakes"), F.col("risk_score").alias("global_risk_score"),
    )


def report_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The events of two cycles and one that repeats the second: reports that changed."""
    path, telemetry = scratch_dir(spark, "changes"), telemetry_from_events(spark, sf)
    cycle = Cycle(path, ttl_seconds=None, keep_points=1, on_error="raise")
    for i in range(3):
        run_cycle(telemetry.filter(F.col("seq") % 2 == i), cycle, i)
    start_events(cycle.reports(spark), f"{path}/emitted", f"{path}/checkpoint", seconds=86_400).awaitTermination()
    emitted = spark.read.schema("trip_id string, event string, data string").json(f"{path}/emitted")
    return emitted.select(
        "trip_id", "event",
        F.get_json_object("data", "$.basic.samples").cast("long").alias("samples"),
        F.get_json_object("data", "$.global_risk_score").cast("double").alias("score"),
    )


def report_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The live feed as a stream: one event per report of two cycles."""
    path, telemetry = scratch_dir(spark, "feed"), telemetry_from_events(spark, sf)
    cycle = Cycle(path, ttl_seconds=None, keep_points=1, on_error="raise")
    for i in range(2):
        run_cycle(telemetry.filter(F.col("seq") % 2 == i), cycle, i)
    feed = report_feed(cycle.reports(spark)).writeStream.option("checkpointLocation", f"{path}/checkpoint")
    feed.trigger(availableNow=True).start(f"{path}/emitted", format="parquet").awaitTermination()
    emitted = spark.read.schema("trip_id string, event string, data string").parquet(f"{path}/emitted")
    return emitted.select(
        "trip_id", "event",
        F.get_json_object("data", "$.basic.samples").cast("long").alias("samples"),
        F.get_json_object("data", "$.global_risk_score").cast("double").alias("score"),
    )


def stored_runs(spark: SparkSession, sf: str) -> DataFrame:
    """One-shot runs over the first half, over nothing and over all; the reports in store
    after them and the audit rows each left."""
    path, telemetry = scratch_dir(spark, "runs"), telemetry_from_events(spark, sf)
    half = telemetry.filter(F.col("event_time") < instant("2024-01-01 00:21:36"))
    for batch_id, samples in enumerate((half, telemetry.filter(F.lit(False)), telemetry), 1):
        run_trips(samples, f"{path}/audit", f"{path}/reports", batch_id)
    audit = read_audit(spark, f"{path}/audit").select(
        "trip_id", F.col("run_id").cast("long").alias("run"), "speeding_alerts", "hard_brakes", "risk_score"
    )
    reports = read_reports(spark, f"{path}/reports").select(
        "trip_id", F.col("basic.samples").cast("long").alias("samples"), "batch_id", "created_seq"
    )
    return audit.join(reports, "trip_id")


def stored_fleet(spark: SparkSession, sf: str) -> DataFrame:
    """The legacy report of a CSV file, appended to its table and read back."""
    path = scratch_dir(spark, "fleet")
    _write_csv(telemetry_from_events(spark, sf), f"{path}/csv")
    run_fleet(spark, f"{path}/csv", f"{path}/reports")
    report = spark.read.parquet(f"{path}/reports")
    return report.select(
        "basic.samples", "basic.max_speed_kmh", "basic.speeding_alerts", F.col("report_id").isNotNull().alias("has_id")
    )


def default_position(spark: SparkSession, sf: str) -> DataFrame:
    """Reports where the newest sample of every other trip has no position."""
    telemetry = telemetry_from_events(spark, sf)
    known = F.when(F.substring_index("trip_id", "-", -1).cast("long") % 2 == 0, True)
    blank = telemetry.withColumns({c: F.when(known, F.col(c)) for c in ("lat", "lon")})
    return trip_reports(blank, LEGACY, keep_points=1).select("trip_id", "position.lat", "position.lon")


def trip_ordinals(spark: SparkSession, sf: str) -> DataFrame:
    telemetry = telemetry_from_events(spark, sf)
    numbered = trip_ordinal(telemetry, plan_slices(telemetry))
    return numbered.select("trip_id", "seq", F.col("ordinal").cast("long").alias("ordinal"),
                           time_text(F.col("event_time")).alias("time_text"))


QUERIES: dict[str, Query] = {
    "coordinate_filter": coordinate_filter,
    "speeding_samples": speeding_samples,
    "hard_brake_samples": hard_brake_samples,
    "kinematics": kinematics_current,
    "kinematics_legacy": kinematics_legacy,
    "skew_safe_kinematics": skew_safe_kinematics,
    "rolling_speed": rolling_speed,
    "trip_metrics": trip_metrics_query,
    "trip_risk_score": trip_risk_score,
    "skew_safe_trip_risk": skew_safe_trip_risk,
    "exact_trip_metrics": exact_trip_metrics,
    "bucketed_trip_risk": bucketed_trip_risk,
    "audit_rows": audit_rows_query,
    "fleet_report_legacy": fleet_report_legacy,
    "skew_safe_fleet": skew_safe_fleet,
    "last_points": last_points_query,
    "last_position": last_position_query,
    "trip_report_flat": trip_report_flat,
    "retention_window": retention_window,
    "lww_dedup": lww_dedup,
    "lww_rewrites": lww_rewrites,
    "report_upsert": report_upsert,
    "history_merge": history_merge,
    "timestamp_parse": timestamp_parse,
    "timestamp_parse_lenient": timestamp_parse_lenient,
    "latest_report": latest_report,
    "report_history": report_history,
    "report_history_processed": report_history_processed,
    "latest_for_trip": latest_for_trip,
    "latest_per_trip": latest_per_trip,
    "update_buffer": update_buffer,
    "route_points": route_points,
    "skew_safe_route": skew_safe_route,
    "trip_ordinals": trip_ordinals,
    "risk_bands": risk_bands,
    "accel_bands": accel_bands,
    "current_motion": current_motion,
    "speed_series": speed_series,
    "weight_shares": weight_shares,
    "alert_flags": alert_flags,
    "sample_log": sample_log,
    "lineage_log": lineage_log,
    "report_json": report_json,
    "report_json_fields": report_json_fields,
    "feed_snapshot": feed_snapshot,
    "normalized": normalized,
    "csv_scan": csv_scan,
    "clustered_store": clustered_store,
    "stream_trip_risk": stream_trip_risk,
    "stream_late_rows": stream_late_rows,
    "stream_replay": stream_replay,
    "stream_retained_risk": stream_retained_risk,
    "incremental_trip_risk": incremental_trip_risk,
    "keyed_trip_risk": keyed_trip_risk,
    "keyed_late_rows": keyed_late_rows,
    "keyed_retained_risk": keyed_retained_risk,
    "report_changes": report_changes,
    "report_stream": report_stream,
    "stored_runs": stored_runs,
    "stored_fleet": stored_fleet,
    "default_position": default_position,
}

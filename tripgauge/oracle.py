"""SQL for every query that has one, over the same tables."""

from __future__ import annotations

import pyspark


TELEMETRY = """
tel AS (
  SELECT 'TRIP-' || user_id AS trip_id,
         1704067200000000 + (epoch_us(ts) - 1704067200000000) // 1000 AS event_us,
         -12.0464::DOUBLE + ((event_id % 2001) - 1000) * 0.08::DOUBLE AS lat,
         -77.0428::DOUBLE + (((event_id * 7919) % 3001) - 1500) * 0.07::DOUBLE AS lon,
         value AS speed_kmh,
         CAST(round(value * 100) AS BIGINT) AS cents,
         event_id AS seq
  FROM events
),
ok AS (SELECT * FROM tel WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180)"""


def _kin(source: str, divisor: str, name: str = "kin") -> str:
    return f"""
{name}_lag AS (
  SELECT *, lag(speed_kmh) OVER w AS prev_speed, lag(event_us) OVER w AS prev_us
  FROM {source} WINDOW w AS (PARTITION BY trip_id ORDER BY event_us, seq)
),
{name}_delta AS (
  SELECT *, (speed_kmh - prev_speed) / {divisor}::DOUBLE AS delta_v,
         CAST(event_us - prev_us AS DOUBLE) / 1e6::DOUBLE AS delta_t
  FROM {name}_lag
),
{name} AS (
  SELECT *, CASE WHEN delta_t > 0 THEN coalesce(delta_v / delta_t, 0) ELSE 0 END::DOUBLE AS accel
  FROM {name}_delta
)"""


def _metrics(source: str, name: str = "met") -> str:
    return f"""
{name}_raw AS (
  SELECT trip_id, count(*) AS samples, CAST(sum(cents) AS BIGINT) AS cents,
         max(speed_kmh) AS max_speed_kmh,
         count(*) FILTER (WHERE speed_kmh > 90) AS speeding_alerts,
         greatest(0, avg(accel * accel) - avg(accel) * avg(accel)) AS variance,
         count(*) FILTER (WHERE accel < -4.5) AS hard_brakes
  FROM {source} GROUP BY trip_id
),
{name} AS (
  SELECT *, (20000 * cents + samples) // (2 * samples) / 1e6::DOUBLE AS avg6,
         (2 * cents + samples) // (2 * samples) / 100::DOUBLE AS avg2,
         round(greatest(0, least(100,
           0.40::DOUBLE * least(variance * 2::DOUBLE, 100)
           + 0.35::DOUBLE * least(speeding_alerts * 5::DOUBLE, 100)
           + 0.25::DOUBLE * least(hard_brakes * 10::DOUBLE, 100))), 2) AS risk_score
  FROM {name}_raw
)"""


TRIPS = f"WITH {TELEMETRY}, {_kin('ok', '3.6')}, {_metrics('kin')}"
KEPT = f"""{TRIPS},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY event_us DESC, seq DESC) AS back,
         count(*) OVER (PARTITION BY trip_id) AS n
  FROM kin
),
pts AS (
  SELECT *, CAST(least(n, 20) - back + 1 AS INTEGER) AS position,
         CAST(make_timestamp(event_us) AS VARCHAR) AS time_text
  FROM ranked WHERE back <= 20
)"""
FINAL = "SELECT trip_id, samples, avg6 AS avg_speed_kmh, max_speed_kmh, speeding_alerts, " \
        "round(variance, 4) AS accel_variance, hard_brakes, risk_score FROM met"
TRIP_RISK = f"{TRIPS} {FINAL}"
KINEMATICS = f"WITH {TELEMETRY}, {_kin('ok', '3.6')} SELECT trip_id, seq, event_us, speed_kmh, " \
             "prev_speed, prev_us, delta_v, delta_t, accel FROM kin"
FLEET = f"""WITH {TELEMETRY}, {_kin('tel', '1')},
fleet AS (
  SELECT count(*) AS samples,
         (2 * CAST(sum(cents) AS BIGINT) + count(*)) // (2 * count(*)) / 100::DOUBLE AS avg_speed_kmh,
         round(max(speed_kmh), 2) AS max_speed_kmh,
         count(*) FILTER (WHERE speed_kmh > 80) AS speeding_alerts,
         round(greatest(0, avg(accel * accel) - avg(accel) * avg(accel)), 4) AS accel_variance,
         round(avg(accel), 6) AS accel_mean, round(avg(accel * accel), 4) AS accel_mean_square,
         count(*) FILTER (WHERE accel <= -12) AS hard_brakes
  FROM kin
),
scored AS (
  SELECT *, round(greatest(0, least(100,
           0.30::DOUBLE * least(accel_variance / 12.96::DOUBLE * 2, 100)
           + 0.30::DOUBLE * least(speeding_alerts * 5::DOUBLE, 100)
           + 0.40::DOUBLE * least(hard_brakes * 10::DOUBLE, 100))), 2) AS score
  FROM fleet
)"""
NEWEST = """(SELECT trip_id, max_by(event_us, (event_us, seq)) AS newest_us, max_by(lat, (event_us, seq)) AS lat,
  max_by(lon, (event_us, seq)) AS lon, max_by(speed_kmh, (event_us, seq)) AS speed,
  max_by(accel, (event_us, seq)) AS accel, min(seq) AS first_kept FROM kin GROUP BY trip_id)"""
STORED = f"""{TRIPS},
stored AS (
  SELECT met.trip_id, c.created_seq, n.newest_us AS processed_us, met.risk_score AS global_risk_score, n.lat
  FROM met JOIN {NEWEST} n USING (trip_id)
  JOIN (SELECT trip_id, min(seq) AS created_seq FROM tel GROUP BY trip_id) c USING (trip_id)
)"""
ROUTE = f"""WITH {TELEMETRY} SELECT trip_id,
  row_number() OVER (PARTITION BY trip_id ORDER BY event_us, seq) AS ordinal, lat, lon FROM ok"""
HALF_US = "1704068496000000"
NEW_YEAR = "1704067200000000"

SAMPLE_LINE = """'[' || time_text || '] [OK] VEL: ' || CAST(CAST(round(CAST(speed_kmh AS DECIMAL(18,2)), 1)
  AS DECIMAL(18,1)) AS VARCHAR) || ' km/h | ACEL: ' ||
  CASE WHEN round(accel, 2) = 0 AND accel < 0 THEN '-' ELSE '' END ||
  CAST(CAST(round(accel, 2) AS DECIMAL(18,2)) AS VARCHAR) || ' m/s²'"""


def _documents() -> str:
    """Documents as the history query builds them, with times already as numbers."""
    return f"""WITH {TELEMETRY},
docs AS (
  SELECT *, CASE WHEN seq % 4 IN (0, 2) THEN event_us ELSE event_us // 1000000 * 1000000 END AS point_us
  FROM tel
)"""


def _lineage_lines() -> str:
    values = [
        ("MOTOR_PROCESAMIENTO", f"Spark {pyspark.__version__}"),
        ("PATRON_ETL", "lag and deltas along each trip, long trips in slices"),
        ("ALGORITMO_VARIANZA", "population variance from the means of x and x squared"),
        ("PATRON_PERSISTENCIA", "Keyed Parquet log, one replacement per trip"),
        ("PRINCIPIOS", "DataFrame operators, one profile per run"),
    ]
    rows = ", ".join(
        f"({i}, '[2024-01-02T03:04:05] [INFO] {label}: {value}')" for i, (label, value) in enumerate(values)
    )
    return f"(VALUES {rows}) v(line, text)"


ORACLE: dict[str, str] = {
    "coordinate_filter": f"WITH {TELEMETRY} SELECT trip_id, event_us, lat, lon, speed_kmh, seq FROM ok",
    "speeding_samples": f"WITH {TELEMETRY} SELECT trip_id, seq, speed_kmh FROM ok WHERE speed_kmh > 90",
    "hard_brake_samples": f"WITH {TELEMETRY}, {_kin('ok', '3.6')} "
                          "SELECT trip_id, seq, accel FROM kin WHERE accel < -4.5",
    "kinematics": KINEMATICS,
    "skew_safe_kinematics": KINEMATICS,
    "kinematics_legacy": f"WITH {TELEMETRY}, {_kin('tel', '1')} SELECT trip_id, seq, event_us, speed_kmh, "
                         "prev_speed, prev_us, coalesce(delta_v, 0) AS delta_v, coalesce(delta_t, 0) AS delta_t, "
                         "accel FROM kin",
    "rolling_speed": f"""WITH {TELEMETRY}, {_kin('ok', '3.6')},
      roll AS (SELECT trip_id, seq, CAST(sum(cents) OVER w AS BIGINT) AS c, count(*) OVER w AS n,
        max(speed_kmh) OVER w AS m, avg(accel) OVER w AS a FROM kin
        WINDOW w AS (PARTITION BY trip_id ORDER BY event_us, seq ROWS BETWEEN 10 PRECEDING AND CURRENT ROW))
      SELECT trip_id, seq, (200 * c + n) // (2 * n) / 1e4::DOUBLE AS rolling_avg_speed, m AS rolling_max_speed,
        round(a, 3) + 0 AS rolling_avg_accel FROM roll""",
    "trip_metrics": f"{TRIPS} {FINAL.replace(', risk_score', '')}",
    "trip_risk_score": TRIP_RISK,
    "skew_safe_trip_risk": TRIP_RISK,
    "bucketed_trip_risk": TRIP_RISK,
    "exact_trip_metrics": f"""{TRIPS} SELECT trip_id, samples,
      (200 * cents + samples) // (2 * samples) / 1e4::DOUBLE AS avg_speed_kmh,
      round(round(variance, 9), 4) AS accel_variance, TRUE AS same_bits FROM met""",
    "clustered_store": TRIP_RISK,
    "stream_trip_risk": TRIP_RISK,
    "stream_late_rows": TRIP_RISK,
    "stream_replay": f"""{TRIPS} SELECT t.*, runs FROM ({FINAL}) t
      JOIN (SELECT trip_id, 5 - min(seq % 5) AS runs FROM ok GROUP BY trip_id) USING (trip_id)""",
    "report_stream": f"""{TRIPS}, first AS (SELECT * FROM ok WHERE seq % 2 = 0), {_kin('first', '3.6', 'fkin')},
      {_metrics('fkin', 'fmet')}
      SELECT trip_id, 'pipeline_update' AS event, samples, risk_score AS score FROM fmet UNION ALL
      SELECT trip_id, 'pipeline_update', samples, risk_score FROM met""",
    "report_changes": f"""{TRIPS}, first AS (SELECT * FROM ok WHERE seq % 2 = 0), {_kin('first', '3.6', 'fkin')},
      {_metrics('fkin', 'fmet')}
      SELECT trip_id, 'pipeline_update' AS event, samples, risk_score AS score FROM fmet UNION ALL
      SELECT m.trip_id, 'pipeline_update', m.samples, m.risk_score FROM met m LEFT JOIN fmet f USING (trip_id)
      WHERE f.trip_id IS NULL OR f.samples <> m.samples""",
    "stored_runs": f"""{TRIPS}, early AS (SELECT * FROM ok WHERE event_us < {HALF_US}), {_kin('early', '3.6', 'ekin')},
      {_metrics('ekin', 'emet')},
      runs AS (SELECT *, 1 AS run FROM emet UNION ALL SELECT *, 3 FROM met)
      SELECT trip_id, CAST(run AS BIGINT) AS run, speeding_alerts, hard_brakes, risk_score,
        first_value(samples) OVER w AS samples, CAST(first_value(run) OVER w AS BIGINT) AS batch_id,
        CAST(min(run) OVER (PARTITION BY trip_id) AS BIGINT) AS created_seq
      FROM runs WINDOW w AS (PARTITION BY trip_id ORDER BY run DESC)""",
    "stored_fleet": f"""WITH {TELEMETRY} SELECT count(*) AS samples, round(max(speed_kmh), 2) AS max_speed_kmh,
      count(*) FILTER (WHERE speed_kmh > 80) AS speeding_alerts, true AS has_id FROM tel""",
    "default_position": f"""WITH {TELEMETRY}, newest AS (SELECT trip_id, max_by(lat, (event_us, seq)) AS lat,
      max_by(lon, (event_us, seq)) AS lon, CAST(substr(trip_id, 6) AS BIGINT) % 2 = 0 AS known FROM tel GROUP BY trip_id)
      SELECT trip_id, CASE WHEN known THEN lat ELSE -12.0464 END::DOUBLE AS lat,
        CASE WHEN known THEN lon ELSE -77.0428 END::DOUBLE AS lon FROM newest""",
    "incremental_trip_risk": TRIP_RISK,
    "keyed_trip_risk": TRIP_RISK,
    "keyed_late_rows": TRIP_RISK,
    "audit_rows": f"{TRIPS} {FINAL.replace('samples, ', '').replace(' FROM', ', ' + chr(39) + 'run-1' + chr(39) + ' AS run_id FROM')}",
    "fleet_report_legacy": f"""{FLEET} SELECT samples, avg_speed_kmh, max_speed_kmh, speeding_alerts,
      80::DOUBLE AS speed_limit, accel_variance, accel_mean, accel_mean_square, hard_brakes,
      -12::DOUBLE AS brake_threshold, score, 0.3::DOUBLE AS w_speeding, 0.3::DOUBLE AS w_variance,
      0.4::DOUBLE AS w_braking FROM scored""",
    "skew_safe_fleet": f"{FLEET} SELECT samples, speeding_alerts, accel_variance, hard_brakes, "
                       "score AS risk_score FROM scored",
    "last_points": f"{KEPT} SELECT trip_id, position, event_us, speed_kmh, accel FROM pts",
    "last_position": f"WITH {TELEMETRY} SELECT trip_id, max_by(lat, (event_us, seq)) AS last_lat, "
                     "max_by(lon, (event_us, seq)) AS last_lon FROM ok GROUP BY trip_id",
    "trip_report_flat": f"""{KEPT},
      o AS (SELECT trip_id, time_text FROM pts WHERE position = 1),
      z AS (SELECT trip_id, time_text, lat, lon, speed_kmh, accel FROM pts WHERE back = 1)
      SELECT met.trip_id, avg2 AS avg_speed_kmh, round(max_speed_kmh, 2) AS max_speed_kmh,
        risk_score AS global_risk_score, z.lat, z.lon, CAST(samples AS INTEGER) AS samples,
        CAST(speeding_alerts AS INTEGER) AS speeding_alerts, 90::DOUBLE AS speed_limit,
        round(variance, 2) AS accel_variance, CAST(hard_brakes AS INTEGER) AS hard_brakes,
        -4.5::DOUBLE AS brake_threshold, 0.35::DOUBLE AS w_speeding, 0.40::DOUBLE AS w_variance,
        0.25::DOUBLE AS w_braking, CAST(least(samples, 20) AS INTEGER) AS n_points,
        o.time_text AS oldest_time, z.time_text AS newest_time, z.speed_kmh AS newest_speed,
        z.accel AS newest_accel, epoch_us(TIMESTAMP '2024-01-02 03:04:05') AS processed_us
      FROM met JOIN o USING (trip_id) JOIN z USING (trip_id)""",
    "retention_window": f"WITH {TELEMETRY} SELECT trip_id, seq, event_us AS ingested_us FROM tel "
                        "WHERE event_us > (SELECT max(event_us) FROM tel) - 600000000",
    "lww_dedup": f"""WITH {TELEMETRY},
      written AS (SELECT trip_id, event_us, speed_kmh, seq FROM tel UNION ALL
        SELECT trip_id, event_us, speed_kmh + 10, seq + 1000000000000 FROM tel WHERE event_us >= {HALF_US})
      SELECT trip_id, event_us, speed_kmh, seq FROM written
      QUALIFY row_number() OVER (PARTITION BY trip_id, event_us ORDER BY seq DESC) = 1""",
    "lww_rewrites": f"""WITH {TELEMETRY},
      written AS (SELECT trip_id, event_us, speed_kmh, seq, event_us AS ingested_us FROM tel UNION ALL
        SELECT trip_id, event_us, speed_kmh + 10, CASE WHEN seq % 2 = 0 THEN -seq END, event_us + 60000000
        FROM tel WHERE seq % 3 = 0)
      SELECT trip_id, event_us, speed_kmh, seq, ingested_us FROM written
      QUALIFY row_number() OVER (PARTITION BY trip_id, event_us ORDER BY ingested_us DESC, seq DESC NULLS LAST) = 1""",
    "report_upsert": f"""WITH {TELEMETRY}, {_kin('ok', '3.6')}, {_metrics('kin')},
      early AS (SELECT * FROM ok WHERE event_us < {NEW_YEAR} + 900000000),
      {_kin('early', '3.6', 'ekin')}, {_metrics('ekin', 'emet')},
      late AS (SELECT trip_id FROM kin GROUP BY trip_id HAVING max(event_us) >= {NEW_YEAR} + 2550000000),
      upd AS (SELECT * FROM met SEMI JOIN late USING (trip_id))
      SELECT trip_id, speeding_alerts, hard_brakes, max_speed_kmh, risk_score, 2 AS batch_id,
        CASE WHEN trip_id IN (SELECT trip_id FROM emet) THEN 1 ELSE 2 END AS created_seq FROM upd
      UNION ALL
      SELECT trip_id, speeding_alerts, hard_brakes, max_speed_kmh, risk_score, 1, 1 FROM emet
      WHERE trip_id NOT IN (SELECT trip_id FROM upd)""",
    "history_merge": f"""{_documents()},
      named AS (SELECT *, (event_us >= {NEW_YEAR} + 864000000)::INT + (event_us >= {NEW_YEAR} + 1728000000)::INT AS part
        FROM docs WHERE seq % 50 <> 0),
      newest AS (SELECT trip_id, max_by(speed_kmh, (part, seq)) AS s, max_by(lat, (part, seq)) FILTER (seq % 3 <> 0) AS lat,
        'doc-' || max_by(seq, (part, seq)) FILTER (seq % 5 = 0) AS engine, max(part) AS batch_id,
        min(part) AS created_seq FROM named GROUP BY trip_id),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY point_us DESC, part DESC, seq DESC) AS back,
        count(*) OVER (PARTITION BY trip_id) AS n FROM named)
      SELECT trip_id, s AS avg_speed_kmh, s + 1 AS max_speed_kmh, least(s, 100) AS global_risk_score, newest.lat,
        engine, CAST(batch_id AS BIGINT) AS batch_id, CAST(created_seq AS BIGINT) AS created_seq,
        CAST(least(n, 20) - back AS INTEGER) AS pos, point_us, speed_kmh AS point_speed
      FROM ranked JOIN newest USING (trip_id) WHERE back <= 20""",
    "timestamp_parse": f"""{_documents()} SELECT seq AS doc_seq,
      CASE WHEN seq % 5 = 4 THEN epoch_us(TIMESTAMP '2024-01-02') ELSE point_us END AS parsed_us FROM docs""",
    "timestamp_parse_lenient": f"""WITH {TELEMETRY} SELECT seq, CASE WHEN seq % 9 = 8
      THEN epoch_us(TIMESTAMP '2024-01-02') ELSE event_us // 1000000 * 1000000 END AS parsed_us FROM tel""",
    "latest_report": f"{STORED} SELECT * FROM stored ORDER BY created_seq DESC, trip_id LIMIT 1",
    "report_history": f"{STORED} SELECT * FROM stored ORDER BY created_seq DESC, trip_id LIMIT 50",
    "report_history_processed": f"{STORED} SELECT * FROM stored ORDER BY processed_us DESC, trip_id LIMIT 50",
    "latest_for_trip": f"{STORED} SELECT * FROM stored WHERE trip_id = 'TRIP-7'",
    "latest_per_trip": f"""WITH {TELEMETRY} SELECT trip_id, event_us AS processed_us, seq AS batch_id, speed_kmh
      FROM tel QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY event_us DESC) = 1""",
    "update_buffer": f"""WITH {TELEMETRY} SELECT trip_id, event_us AS processed_us, seq AS batch_id, speed_kmh
      FROM tel ORDER BY event_us DESC, seq DESC, trip_id LIMIT 50""",
    "route_points": ROUTE,
    "skew_safe_route": ROUTE,
    "trip_ordinals": f"""WITH {TELEMETRY} SELECT trip_id, seq,
      row_number() OVER (PARTITION BY trip_id ORDER BY event_us, seq) AS ordinal,
      CAST(make_timestamp(event_us) AS VARCHAR) AS time_text FROM tel""",
    "risk_bands": f"""{TRIPS} SELECT trip_id, risk_score AS score, CASE WHEN risk_score <= 30 THEN 'LOW'
      WHEN risk_score <= 70 THEN 'MODERATE' ELSE 'HIGH' END AS band FROM met""",
    "accel_bands": f"""WITH {TELEMETRY}, {_kin('ok', '3.6')} SELECT trip_id, CASE WHEN accel >= 2
      THEN 'STRONG_ACCEL' WHEN accel < -4.5 THEN 'HARD_BRAKE' ELSE 'NORMAL' END AS band, count(*) AS samples
      FROM kin GROUP BY ALL""",
    "current_motion": f"""{TRIPS} SELECT met.trip_id, speed, accel, CASE WHEN accel >= 2 THEN 'STRONG_ACCEL'
      WHEN accel < -4.5 THEN 'HARD_BRAKE' ELSE 'NORMAL' END AS band,
      round(-90::DOUBLE + least(speed, 120) / 120 * 180, 6) AS gauge_angle,
      round(210::DOUBLE - avg2 * 1.5::DOUBLE, 6) AS needle_angle, lat, lon
      FROM met JOIN {NEWEST} USING (trip_id)""",
    "speed_series": f"""{KEPT} SELECT trip_id, position - 1 AS idx,
      strftime(make_timestamp(event_us), '%H:%M:%S') AS name, round(speed_kmh, 2) AS speed,
      round(accel, 2) + 0 AS accel FROM pts""",
    "weight_shares": f"""{TRIPS} SELECT trip_id, factor, percent FROM met, (VALUES ('variance', 40::DOUBLE),
      ('speeding', 35::DOUBLE), ('braking', 25::DOUBLE)) w(factor, percent)""",
    "alert_flags": f"{TRIPS} SELECT trip_id, speeding_alerts > 0 AS any_speeding, "
                   "hard_brakes > 0 AS any_hard_brake FROM met",
    "sample_log": f"{KEPT} SELECT trip_id, CAST(back - 1 AS INTEGER) AS line, {SAMPLE_LINE} AS text FROM pts",
    "lineage_log": f"{TRIPS} SELECT trip_id, line, text FROM met, {_lineage_lines()}",
    "report_json_fields": f"""{KEPT} SELECT met.trip_id, '2024-01-02T03:04:05' AS analyzed_at, samples,
      risk_score AS score, 0.4::DOUBLE AS w_variance, o.time_text AS oldest_time, o.speed_kmh AS oldest_speed,
      CAST(least(samples, 20) AS INTEGER) AS n_points, 'tripgauge' AS project, '2024-01-02T03:04:05' AS processed_at,
      avg2 AS avg_speed_kmh, round(max_speed_kmh, 2) AS max_speed_kmh, speeding_alerts, 90::DOUBLE AS speed_limit,
      round(variance, 2) AS accel_variance, hard_brakes, -4.5::DOUBLE AS brake_threshold, z.lat, z.lon,
      'DataFrame operators, one profile per run' AS principles
      FROM met JOIN pts o ON o.trip_id = met.trip_id AND o.position = 1
      JOIN pts z ON z.trip_id = met.trip_id AND z.back = 1""",
    "feed_snapshot": f"""WITH {TELEMETRY} SELECT asked, CASE WHEN trip_id IS NULL THEN 'ping' ELSE 'pipeline_update' END
      AS event, trip_id, CASE WHEN trip_id IS NULL THEN 'empty_collection' END AS status
      FROM (VALUES ('TRIP-7'), ('TRIP-NONE')) a(asked) LEFT JOIN (SELECT DISTINCT trip_id FROM ok) ON trip_id = asked""",
    "normalized": f"WITH {TELEMETRY} SELECT trip_id, event_us, lat, lon, speed_kmh, seq, true AS no_write_time FROM tel",
    "csv_scan": f"WITH {TELEMETRY} SELECT trip_id, event_us // 1000 * 1000 AS event_us, speed_kmh, lat, lon FROM tel",
    "stream_retained_risk": f"""WITH {TELEMETRY},
      live AS (SELECT * FROM ok WHERE event_us > (SELECT max(event_us) FROM tel) - 600000000),
      {_kin('live', '3.6')}, {_metrics('kin')}
      SELECT trip_id, CAST(samples AS INTEGER) AS samples, CAST(speeding_alerts AS INTEGER) AS speeding_alerts,
        CAST(hard_brakes AS INTEGER) AS hard_brakes, risk_score AS global_risk_score FROM met""",
}
ORACLE["keyed_retained_risk"] = ORACLE["stream_retained_risk"]

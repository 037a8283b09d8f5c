"""Trip metrics and live events from state that the state store keeps per trip.

* ``start_carried`` folds one summary per trip and batch into a trip's sums. Samples of a batch are
  summarised by the batch operators first, so a trip that fills a batch is still spread over tasks,
  and a batch costs what the trips in it cost, whatever the number of trips in state.
* ``start_live`` keeps the samples themselves, in slots of time, each with its own sums. A
  late sample is put into its slot and that slot is summed anew; accelerations across two slots come
  from their edges, which are kept with the sums. Other slots aren't read. The later write of
  a trip and time wins. With ``ttl_seconds`` timers on the write times expire samples.

  Both deal trips to ``CELLS`` by a hash. A cell is what the state store is asked for at a time and what
  numpy works on at a time; in it every trip keeps a state of its own, and the samples of a slot
  lie together, so that many trips of few samples cost no call each for every slot.
* ``report_events`` emits a trip's report when it changed, and a ping by timer while it is silent.

State is on RocksDB and belongs to a checkpoint; a restart goes on from it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tripgauge.operators.quality import position_inside
from tripgauge.operators.slicing import SLICE_ROWS
from tripgauge.plans.serving import PING_EVENT, UPDATE_EVENT, report_json
from tripgauge.plans.trip_report import enriched_samples
from tripgauge.profiles import CURRENT, RETENTION_SECONDS, Profile
from tripgauge.sources.keyed_log import KeyedLog
from tripgauge.streaming.incremental import summarise

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SLOT_SECONDS = 60
# Part of what a checkpoint holds; can't change later.
CELLS = 1024
# Columns of a report that differ from run to run.
MADE_AT = ("analyzed_at", "processed_at")
# Stands for a missing time or number; sorts first.
NONE = -(2**63)

_SUMS = [
    T.StructField("samples", T.LongType()), T.StructField("speeds", T.LongType()),
    T.StructField("speed_sum", T.DoubleType()), T.StructField("max_speed_kmh", T.DoubleType()),
    T.StructField("speeding_alerts", T.LongType()), T.StructField("accel_sum", T.DoubleType()),
    T.StructField("accel_square_sum", T.DoubleType()), T.StructField("hard_brakes", T.LongType()),
]
SUMS = [f.name for f in _SUMS]
# Sums of a trip, how many of its stored samples the last change read, and the number of the change.
METRIC_STATE = T.StructType([
    T.StructField("trip_id", T.StringType()), *_SUMS, T.StructField("rows_read", T.LongType()),
    T.StructField("version", T.LongType()),
])
# ``trip`` counts the trips of a slot in state, and those of a call elsewhere.
_SAMPLE = np.dtype([
    ("trip", "<i4"), ("t", "<i8"), ("seq", "<i8"), ("at", "<i8"), ("v", "<f8"), ("known", "?"), ("inside", "?"),
])
_SLOT = np.dtype([
    ("slot", "<i8"), ("n", "<i8"), ("speeds", "<i8"), ("speed_sum", "<f8"),
    ("most", "<f8"), ("alerts", "<i8"), ("accel", "<f8"), ("square", "<f8"), ("brakes", "<i8"),
    ("first_t", "<i8"), ("first_v", "<f8"), ("last_t", "<i8"), ("last_v", "<f8"),
])
# The slots that a cell holds samples of, and the least write time in each.
_DUE = np.dtype([("slot", "<i8"), ("least_at", "<i8")])


def accelerations(t: np.ndarray, v: np.ndarray, before_t: np.ndarray, before_v: np.ndarray, profile: Profile) -> np.ndarray:
    """As ``functions.columns.acceleration``; an unknown speed is NaN."""
    known = (t != NONE) & (before_t != NONE) & (t > before_t)
    seconds = np.where(known, t - np.where(known, before_t, 0), 1) / 1e6
    with np.errstate(invalid="ignore"):
        raw = np.where(known, (v - before_v) / profile.accel_divisor / seconds, 0.0)
    return np.nan_to_num(raw, nan=0.0, posinf=np.inf, neginf=-np.inf)


def _braking(accel: np.ndarray, profile: Profile) -> np.ndarray:
    return accel <= profile.brake_threshold if profile.brake_inclusive else accel < profile.brake_threshold


def _by_cell(rows: DataFrame):
    return rows.withColumn("cell", F.pmod(F.xxhash64("trip_id"), F.lit(CELLS)).cast("int")).groupBy("cell")


def _use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)


def metric_log(spark: SparkSession, path: str) -> KeyedLog:
    """Where the changed trips of each batch go; read with ``incremental.state_metrics``."""
    return KeyedLog(spark, path, METRIC_STATE)


def _start_into(changes: DataFrame, log: KeyedLog, checkpoint: str, interval: str | None) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        # A timer may follow on samples of the same batch: the last change stays.
        picked = [F.max_by(c, "version").alias(c) for c in METRIC_STATE.fieldNames()[1:]]
        log.write(batch.groupBy("trip_id").agg(*picked), batch_id)

    writer = changes.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    return writer.trigger(**({"processingTime": interval} if interval else {"availableNow": True})).start()


# Sums carried from batch to batch

SUMMARY = T.StructType([
    T.StructField("trip_id", T.StringType()), T.StructField("batch_id", T.LongType()),
    *[T.StructField(f"{e}_{c}", k) for e in ("oldest", "newest") for c, k in (("t", T.LongType()), ("seq", T.LongType()), ("v", T.DoubleType()))],
    *_SUMS,
])
_CARRIED = T.StructType([T.StructField("version", T.LongType()), *[f for f in SUMMARY if f.name.startswith("newest")], *_SUMS])


class CarriedTrips(StatefulProcessor):
    """One value per trip: its sums and newest sample. Of a cell, the trips of the batch are read."""

    def __init__(self, profile: Profile):
        self.profile = profile

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.carried = handle.getMapState("carried", "trip_id string", _CARRIED)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names, states = _CARRIED.fieldNames(), {}
        given = pd.concat(list(rows))
        given["trip_id"] = _named(given["trip_id"])
        for later in given.sort_values("batch_id").to_dict("records"):
            trip = later["trip_id"]
            if trip not in states:
                held = self.carried.getValue((trip,))
                states[trip] = None if held is None else dict(zip(names, held, strict=True))
            state = states[trip]
            states[trip] = later | {"version": 1} if state is None else self._after(state, later)
        for trip, state in states.items():
            self.carried.updateValue((trip,), tuple(_plain(state[c]) for c in names))
        yield pd.DataFrame([
            {"trip_id": trip, **{c: state[c] for c in SUMS}, "rows_read": 0, "version": state["version"]}
            for trip, state in states.items()
        ])

    def _after(self, state: dict, later: dict) -> dict:
        seam = accelerations(*(np.array([x]) for x in (
            later["oldest_t"], later["oldest_v"], state["newest_t"], state["newest_v"])), self.profile)
        found = {c: state[c] + later[c] for c in SUMS if c != "max_speed_kmh"}
        found["accel_sum"] += seam[0]
        found["accel_square_sum"] += seam[0] ** 2
        found["hard_brakes"] += int(_braking(seam, self.profile)[0])
        tops = [s["max_speed_kmh"] for s in (state, later) if s["speeds"]]
        found["max_speed_kmh"] = float(np.max(tops)) if tops else np.nan  # NaN counts as largest
        newest = max((state, later), key=lambda s: (s["newest_t"], s["newest_seq"]))
        return found | {c: newest[c] for c in ("newest_t", "newest_seq", "newest_v")} | {"version": state["version"] + 1}

    def close(self) -> None:
        pass


def _named(trips: pd.Series) -> pd.Series:
    """Trip names as objects, None in place of any other missing value."""
    return trips.astype(object).where(trips.notna(), None)


def _plain(value):
    return value.item() if isinstance(value, np.generic) else value


def start_summaries(
    samples: DataFrame, path: str, checkpoint: str, profile: Profile = CURRENT, slice_rows: int = SLICE_ROWS,
    interval: str | None = None,
) -> StreamingQuery:
    """Write one summary per trip of every batch of telemetry below ``path``."""

    def edge(name: str) -> list:
        return [
            F.coalesce(F.unix_micros(f"{name}.event_time"), F.lit(NONE)).alias(f"{name}_t"),
            F.coalesce(f"{name}.seq", F.lit(NONE)).alias(f"{name}_seq"),
            F.coalesce(f"{name}.speed_kmh", F.lit(float("nan"))).alias(f"{name}_v"),
        ]

    def write(batch: DataFrame, batch_id: int) -> None:
        found = summarise(enriched_samples(batch, profile, slice_rows=slice_rows), profile)
        flat = found.select("trip_id", F.lit(batch_id).cast("long").alias("batch_id"), *edge("oldest"), *edge("newest"), *SUMS)
        flat.write.mode("overwrite").parquet(f"{path}/summaries-{batch_id}")

    writer = samples.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return writer.trigger(**({"processingTime": interval} if interval else {"availableNow": True})).start()


def start_carried(
    spark: SparkSession, path: str, log: KeyedLog, checkpoint: str, profile: Profile = CURRENT, interval: str | None = None
) -> StreamingQuery:
    """Fold the summaries below ``path`` into state; each batch of ``log`` has the trips that
    changed. Samples are expected in time order per trip, as in ``incremental``."""
    _use_rocksdb(spark)
    stored = spark.readStream.schema(SUMMARY).parquet(f"{path}/summaries-*")
    changes = _by_cell(stored).transformWithStateInPandas(
        CarriedTrips(profile), METRIC_STATE, outputMode="Update", timeMode="None"
    )
    return _start_into(changes, log, checkpoint, interval)


# Samples kept in state

class LiveTrips(StatefulProcessor):
    """Of a cell: a map of slots to the samples of its trips, a map of trips to the sums and edges of
    their slots, and, in one value, the slots there are."""

    def __init__(self, profile: Profile, ttl: bool):
        self.profile, self.ttl = profile, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.due = handle.getValueState("due", "slots binary")
        self.heads = handle.getMapState("heads", "trip_id string", "version long, slots binary")
        self.samples = handle.getMapState("samples", "slot long", "trips string, rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        given = pd.concat(list(rows))
        new = np.zeros(len(given), _SAMPLE)
        new["trip"], trips = pd.factorize(_named(given["trip_id"]), use_na_sentinel=False)
        for name in _SAMPLE.names[1:]:
            new[name] = given[name].to_numpy()
        yield from self._change(list(_named(pd.Series(trips))), new, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._change([], np.zeros(0, _SAMPLE), timerValues)

    def _change(self, trips: list, new: np.ndarray, timerValues) -> Iterator[pd.DataFrame]:
        due = np.frombuffer(self.due.get()[0], _DUE) if self.due.exists() else np.zeros(0, _DUE)
        due = dict(zip(due["slot"].tolist(), due["least_at"].tolist(), strict=True))
        limit = timerValues.getCurrentWatermarkInMs() if self.ttl else -1
        touched = set(np.unique(_place(new)).tolist())
        if limit >= 0:
            touched |= {k for k, least_at in due.items() if least_at // 1000 <= limit}
        number = {t: i for i, t in enumerate(trips)}
        held = [self._held(k, number) for k in touched if k in due]
        trips = list(number)
        old = np.concatenate([np.zeros(0, _SAMPLE), *held])
        rows = _last_writes(np.concatenate([old, new]))
        gone = new[:0]
        if limit >= 0:
            live = rows["at"] // 1000 > limit
            rows, gone = rows[live], rows[~live]
        for k in touched:
            self._keep(k, rows[_place(rows) == k], trips, due)
        if due:
            self.due.update((np.array(list(due.items()), "<i8").tobytes(),))
        else:
            self.due.clear()
        if self.ttl:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if due:
                self.handle.registerTimer(min(due.values()) // 1000)
        found = self._summed_anew(trips, old, rows, np.concatenate([new, gone]))
        if len(found):
            yield found

    def _held(self, slot: int, number: dict) -> np.ndarray:
        """Stored samples of a slot. Trips that are not in ``number`` yet are put there."""
        trips, packed = self.samples.getValue((slot,))
        rows = np.frombuffer(packed, _SAMPLE).copy()
        rows["trip"] = np.array([number.setdefault(t, len(number)) for t in json.loads(trips)], "<i4")[rows["trip"]]
        return rows

    def _keep(self, slot: int, rows: np.ndarray, trips: list, due: dict) -> None:
        if len(rows):
            there, place = np.unique(rows["trip"], return_inverse=True)
            packed = rows.copy()
            packed["trip"] = place
            self.samples.updateValue((slot,), (json.dumps([trips[i] for i in there]), packed.tobytes()))
            due[slot] = int(rows["at"].min())
        elif due.pop(slot, None) is not None:
            self.samples.removeKey((slot,))

    def _summed_anew(self, trips: list, old: np.ndarray, rows: np.ndarray, cause: np.ndarray) -> pd.DataFrame:
        """Sums of the trips with samples in ``cause``, of whose slots those with such samples are
        summed from ``rows`` and counted as read in ``old``."""
        changed, of = np.unique(cause["trip"], return_inverse=True)
        slots, slot_of = np.unique(_place(cause), return_inverse=True)
        pairs = np.unique(of * len(slots) + slot_of)

        def summed_anew(trip: np.ndarray, slot: np.ndarray) -> np.ndarray:
            if not len(pairs):
                return np.zeros(len(trip), bool)
            i = np.minimum(np.searchsorted(changed, trip), len(changed) - 1)
            j = np.minimum(np.searchsorted(slots, slot), len(slots) - 1)
            there = (changed[i] == trip) & (slots[j] == slot)
            return there & np.isin(i * len(slots) + j, pairs)

        read = np.bincount(old["trip"][summed_anew(old["trip"], _place(old))], minlength=len(trips))
        rows = rows[summed_anew(rows["trip"], _place(rows))]
        trip, sums = _slot_sums(rows, self.profile)
        versions, tables, owners = [], [sums], [trip]
        for i in changed.tolist():
            version, packed = self.heads.getValue((trips[i],)) or (0, b"")
            versions.append(version + 1)
            tables.append(np.frombuffer(packed, _SLOT))
            owners.append(np.full(len(tables[-1]), i, trip.dtype))
        before, owner = np.concatenate(tables[1:] + [sums[:0]]), np.concatenate(owners[1:] + [trip[:0]])
        stay = ~summed_anew(owner, before["slot"])
        table, owner = np.concatenate([before[stay], sums]), np.concatenate([owner[stay], trip])
        order = np.lexsort((table["slot"], owner))
        table, owner = table[order], owner[order]
        first, last = np.searchsorted(owner, changed), np.searchsorted(owner, changed, "right")
        for i, version, a, b in zip(changed.tolist(), versions, first.tolist(), last.tolist(), strict=True):
            if a < b:
                self.heads.updateValue((trips[i],), (version, table[a:b].tobytes()))
            elif version > 1:
                self.heads.removeKey((trips[i],))
        found = _totals(table, np.searchsorted(changed, owner), len(changed), self.profile)
        return pd.DataFrame({
            "trip_id": pd.Series([trips[i] for i in changed.tolist()], dtype=object), **found, "rows_read": read[changed],
            "version": np.array(versions, "<i8"),
        })

    def close(self) -> None:
        pass


def _place(rows: np.ndarray) -> np.ndarray:
    return np.where(rows["t"] == NONE, NONE, rows["t"] // (SLOT_SECONDS * 1_000_000))


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.flatnonzero(new)


def _slot_sums(rows: np.ndarray, profile: Profile) -> tuple[np.ndarray, np.ndarray]:
    """Sums of every slot of every trip, without what its first sample owes to the slot before, and the
    trips they are of. ``rows`` come by trip and time."""
    starts = _starts(rows["trip"], _place(rows))
    found = np.zeros(len(starts), _SLOT)
    trip, found["slot"] = rows["trip"][starts], _place(rows)[starts]
    group = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(rows)))
    group, rows = group[rows["inside"]], rows[rows["inside"]]
    if len(rows):
        at = _starts(group)
        g, end = group[at], np.append(at[1:], len(rows)) - 1
        known, v = rows["known"], rows["v"]
        accel = np.zeros(len(rows))
        accel[1:] = accelerations(rows["t"][1:], v[1:], rows["t"][:-1], v[:-1], profile)
        accel[at] = 0.0
        braking = _braking(accel, profile)
        braking[at] = False
        speeds = np.add.reduceat(known.astype("<i8"), at)
        found["n"][g], found["speeds"][g] = end - at + 1, speeds
        found["speed_sum"][g] = np.add.reduceat(np.where(known, v, 0.0), at)
        found["most"] = np.nan
        found["most"][g] = np.where(speeds > 0, np.maximum.reduceat(np.where(known, v, -np.inf), at), np.nan)
        # NaN is above every limit, as in Spark.
        found["alerts"][g] = np.add.reduceat((known & ((v > profile.speed_limit) | np.isnan(v))).astype("<i8"), at)
        found["accel"][g], found["square"][g] = np.add.reduceat(accel, at), np.add.reduceat(accel * accel, at)
        found["brakes"][g] = np.add.reduceat(braking.astype("<i8"), at)
        found["first_t"][g], found["first_v"][g] = rows["t"][at], v[at]
        found["last_t"][g], found["last_v"][g] = rows["t"][end], v[end]
    return trip, found


def _totals(table: np.ndarray, owner: np.ndarray, n: int, profile: Profile) -> dict[str, np.ndarray]:
    """Sums of ``n`` trips from those of their slots, which come by trip and time; ``owner`` is the
    number of the trip."""
    filled = table["n"] > 0
    used, of = table[filled], owner[filled]
    seams, braking = np.zeros(len(used)), np.zeros(len(used), bool)
    if len(used):
        seams[1:] = accelerations(used["first_t"][1:], used["first_v"][1:], used["last_t"][:-1], used["last_v"][:-1], profile)
        # The first sample of a trip has acceleration 0.
        seams[_starts(of)] = 0.0
        braking = _braking(seams, profile)
    most = np.full(n, -np.inf)
    spoken = used["speeds"] > 0
    np.maximum.at(most, of[spoken], used["most"][spoken])
    speeds = _added(used["speeds"], of, n)
    return {
        "samples": _added(used["n"], of, n), "speeds": speeds, "speed_sum": _added(used["speed_sum"], of, n),
        "max_speed_kmh": np.where(speeds > 0, most, np.nan),
        "speeding_alerts": _added(used["alerts"], of, n),
        "accel_sum": _added(used["accel"] + seams, of, n),
        "accel_square_sum": _added(used["square"] + seams * seams, of, n),
        "hard_brakes": _added(used["brakes"] + braking, of, n),
    }


def _added(values: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, values.dtype)
    np.add.at(out, of, values)
    return out


def _last_writes(rows: np.ndarray) -> np.ndarray:
    """By trip and time, one row of each: the one written last, then of the highest sequence."""
    rows = rows[np.lexsort((rows["seq"], rows["at"], rows["t"], rows["trip"]))]
    ends = np.append(_starts(rows["trip"], rows["t"])[1:], len(rows)) - 1
    return rows[ends] if len(rows) else rows


def start_live(
    samples: DataFrame, log: KeyedLog, checkpoint: str, profile: Profile = CURRENT,
    ttl_seconds: int | None = RETENTION_SECONDS, interval: str | None = None,
) -> StreamingQuery:
    """Keep the samples of all trips in state, late and rewritten ones in their place; each batch of
    ``log`` has the trips that changed, those left without samples included.

    With ``ttl_seconds`` the newest write time seen is the clock, in whole milliseconds: what was
    written so long before it is dropped, also on arrival. Without a write time a sample counts as written
    now. A trip's samples of one batch are sorted in one task: for trips that fill a batch use
    ``cycle``. Nulls in other columns count as in the batch operators."""
    spark = samples.sparkSession
    _use_rocksdb(spark)
    at = F.coalesce("ingested_at", F.current_timestamp())
    marked = samples.withColumn("ingested_at", at)
    if ttl_seconds is not None:
        marked = marked.withWatermark("ingested_at", f"{ttl_seconds} seconds")
    inside = position_inside() if profile.filter_coordinates else F.lit(True)
    rows = marked.select(
        "trip_id", "ingested_at",
        F.coalesce(F.unix_micros("event_time"), F.lit(NONE)).alias("t"), F.coalesce("seq", F.lit(NONE)).alias("seq"),
        F.unix_micros("ingested_at").alias("at"), F.coalesce("speed_kmh", F.lit(float("nan"))).alias("v"),
        F.col("speed_kmh").isNotNull().alias("known"), F.coalesce(inside, F.lit(False)).alias("inside"),
    )
    changes = _by_cell(rows).transformWithStateInPandas(
        LiveTrips(profile, ttl_seconds is not None), METRIC_STATE, outputMode="Update",
        timeMode="None" if ttl_seconds is None else "EventTime",
    )
    return _start_into(changes, log, checkpoint, interval)


# Events of the live feed

class Announcer(StatefulProcessor):
    """What a trip's last report was known by; a timer that each event sets anew."""

    def __init__(self, seconds: int):
        self.seconds = seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "mark long")

    def _event(self, key, timerValues, event: str, data: str | None) -> pd.DataFrame:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + 1000 * self.seconds)
        return pd.DataFrame([{"trip_id": key[0], "event": event, "data": data}])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last = self.last.get()[0] if self.last.exists() else None
        given = pd.concat(list(rows)).sort_values("batch_id")
        for mark, data in zip(given["mark"].tolist(), given["data"], strict=True):
            if mark != last:
                last = mark
                self.last.update((mark,))
                yield self._event(key, timerValues, UPDATE_EVENT, data)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._event(key, timerValues, PING_EVENT, None)

    def close(self) -> None:
        pass


def report_events(reports: KeyedLog, seconds: int = 1) -> DataFrame:
    """Streaming rows ``trip_id, event, data``: a report that differs from the trip's last one in
    more than when it was made, and a ping without data whenever ``seconds`` went by without
    either. Order is that of batches. After a restart timers run from the first batch with a report on."""
    _use_rocksdb(reports.spark)
    stored = reports.spark.readStream.schema(reports.stored_schema).parquet(reports.batches_path)
    told = [c for c in reports.schema.fieldNames() if c not in MADE_AT]
    marked = stored.select(*reports.schema.fieldNames(), "batch_id", F.xxhash64(F.to_json(F.struct(*told))).alias("mark"))
    data = report_json(marked, "data", carry=("batch_id", "mark"))
    return data.groupBy("trip_id").transformWithStateInPandas(
        Announcer(seconds), "trip_id string, event string, data string", outputMode="Update", timeMode="ProcessingTime"
    )


def start_events(
    reports: KeyedLog, target: str, checkpoint: str, seconds: int = 1, interval: str | None = None
) -> StreamingQuery:
    """Write ``report_events`` as JSON rows below ``target``, a folder per batch; without
    ``interval`` those there are, and stop."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").json(f"{target}/batch_id={batch_id}")

    conf, setting = reports.spark.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    events = report_events(reports, seconds)
    writer = events.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    before = conf.get(setting)
    # Timers go off in batches without data, of which a run that is to stop would have no end.
    conf.set(setting, "true" if interval else "false")
    try:
        return writer.trigger(**({"processingTime": interval} if interval else {"availableNow": True})).start()
    finally:
        conf.set(setting, before)

"""Ordered per-trip windows that survive a trip too long for one task.

A window over ``trip_id`` sorts a whole trip in one task. Here a trip with more than
``slice_rows`` samples is cut into consecutive slices of its order, each slice
becomes its own window group, and the few rows a look-back needs from earlier slices
are copied in front of it. Every long trip is cut, however many there are, the rows
without a trip included. When no trip is long, nothing of this shows in the plan.

Cut points are a table of one row per long trip, estimated from a sample as a range
partitioner does; they decide only where a trip is cut, never what a row's result is.
They are written once, so that all uses cut alike, and joined like any other table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripgauge.session import scratch_dir

SLICE_ROWS = 2_000_000
SAMPLES_PER_SLICE = 128

LONG_MIN = -(2**63)


@dataclass(frozen=True)
class TripSlices:
    """Cut points of the long trips; ``lookup`` is None when there is no long trip. With
    ``stored``, rows bring their ``slice`` along, and with it that many rows ahead of each
    slice, marked as ``context``."""

    lookup: DataFrame | None
    key: str
    time: str
    seq: str
    stored: int = 0

    @property
    def needed(self) -> bool:
        return self.lookup is not None or self.stored > 0

    def named(self) -> Column:
        """The trip as a text that is never null, to join by."""
        return F.coalesce(F.concat(F.lit("="), F.col(self.key).cast("string")), F.lit("~"))

    def assign(self, df: DataFrame, long_trips_only: bool = False) -> DataFrame:
        """Add each row's ``slice``, 0 for short trips. It follows from the row alone, so
        any rows of the trip may be given, also fewer than the cuts were planned on."""
        if self.stored:
            return df.filter(~F.col("context")).drop("context")
        t, s = _place(self.time, self.seq)

        def reached(cut: Column) -> Column:
            return (cut["t"] < t) | ((cut["t"] == t) & (cut["s"] <= s))

        # Two short scans instead of one long one: first the group, then inside it.
        group = F.size(F.filter("coarse", reached)) - 1
        within = F.size(F.filter(F.get("fine", F.col("group")), reached)) - 1
        how = "inner" if long_trips_only else "left"
        return (
            df.withColumn("_trip", self.named())
            .join(self.lookup, "_trip", how)
            .withColumn("group", group)
            .withColumn("slice", F.coalesce(F.col("group") * F.col("stride") + within, F.lit(0)))
            .drop("_trip", "group", "stride", "coarse", "fine")
        )


# For inputs known to hold few rows per trip.
WHOLE_TRIPS = TripSlices(None, "trip_id", "event_time", "seq")


def _place(time: str, seq: str) -> tuple[Column, Column]:
    """A row's place in its trip; nulls come first, as they sort."""
    return F.coalesce(F.unix_micros(time), F.lit(LONG_MIN)), F.coalesce(F.col(seq), F.lit(LONG_MIN))


def plan_slices(
    df: DataFrame,
    key: str = "trip_id",
    time: str = "event_time",
    seq: str = "seq",
    slice_rows: int = SLICE_ROWS,
) -> TripSlices:
    """Find the long trips and where to cut them, each into pieces of about ``slice_rows``.

    One narrow job counts rows per trip, combined on the map side, and only whether
    there is a long one reaches the driver. Their rows are sampled alike, so that a
    trip's sample grows with its pieces and stays far below a slice."""
    whole = TripSlices(None, key, time, seq)
    heavy = (
        df.groupBy(whole.named().alias("_trip"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > slice_rows)
        .withColumn("pieces", F.ceil(F.col("rows") / slice_rows))
    )
    if heavy.isEmpty():
        return whole
    t, s = _place(time, seq)
    by_trip = Window.partitionBy("_trip")
    rank = F.row_number().over(by_trip.orderBy("t", "s"))
    share = F.col("pieces") / F.col("size")
    starts_piece = F.floor(F.col("rank") * share) > F.floor((F.col("rank") - 1) * share)
    cut = F.struct("t", "s")
    first = F.struct(F.lit(LONG_MIN).alias("t"), F.lit(LONG_MIN).alias("s"))
    fine = F.transform(
        F.sequence(F.lit(1), F.size("bounds"), F.col("stride")), lambda i: F.slice("bounds", i, F.col("stride"))
    )
    lookup = (
        df.select(whole.named().alias("_trip"), t.alias("t"), s.alias("s"))
        .sample(min(1.0, SAMPLES_PER_SLICE / slice_rows), seed=7)
        .join(heavy, "_trip")
        .withColumns({"rank": rank, "size": F.count(F.lit(1)).over(by_trip)})
        .filter(starts_piece & (F.col("rank") < F.col("size")))
        .groupBy("_trip")
        .agg(F.array_sort(F.collect_set(cut)).alias("cuts"))
        .withColumn("bounds", F.array_distinct(F.concat(F.array(first), "cuts")))
        .withColumn("stride", F.greatest(F.floor(F.sqrt(F.size("bounds"))).cast("int"), F.lit(1)))
        .withColumn("fine", fine)
        .select("_trip", "stride", F.transform("fine", lambda g: F.get(g, F.lit(0))).alias("coarse"), "fine")
    )
    path = scratch_dir(df.sparkSession, "slices")
    lookup.write.parquet(path)
    return TripSlices(df.sparkSession.read.schema(lookup.schema).parquet(path), key, time, seq)


def over_trips(
    df: DataFrame,
    derive: Callable[[DataFrame, list[str]], DataFrame],
    lookback: int,
    columns: list[str],
    slices: TripSlices,
) -> DataFrame:
    """Apply ``derive(frame, partition_columns)``, which may look back ``lookback``
    rows at ``columns`` in each trip's order, and never at rows ahead."""
    if not slices.needed:
        return derive(df, [slices.key])
    if slices.stored:
        if lookback > slices.stored:
            raise ValueError(f"the table holds {slices.stored} rows ahead of a slice, not {lookback}")
        return derive(df, [slices.key, "slice"]).filter(~F.col("context")).drop("context", "slice")
    context = _rows_before_slices(df, lookback, columns, slices).withColumn("context", F.lit(True))
    rows = slices.assign(df).withColumn("context", F.lit(False))
    joined = rows.unionByName(context, allowMissingColumns=True)
    done = derive(joined, [slices.key, "slice"])
    return done.filter(~F.col("context")).drop("context", "slice")


def _rows_before_slices(df: DataFrame, lookback: int, columns: list[str], slices: TripSlices) -> DataFrame:
    """For every slice but a trip's first, the ``lookback`` rows ahead of it, with
    ``slice`` set to the slice they precede.

    These are among the last ``lookback`` rows of each slice. Numbered along the trip,
    the ones wanted by a slice are the numbers just below those of its own, also where
    a slice before it holds fewer rows than the look-back; they are fetched by number."""
    key, order = slices.key, [slices.time, slices.seq]
    carried = [*order, *[c for c in columns if c not in order]]
    rows = slices.assign(df.select(key, *carried), long_trips_only=True).withColumn("_trip", slices.named())
    latest = Window.partitionBy("_trip", "slice").orderBy(*[F.desc(c) for c in order])
    along = Window.partitionBy("_trip").orderBy("slice", *order)
    ends = (
        rows.withColumn("rn", F.row_number().over(latest))
        .filter(F.col("rn") <= lookback)
        .withColumn("at", F.row_number().over(along))
    )
    firsts = ends.groupBy("_trip", "slice").agg(F.min("at").alias("first")).filter("first > 1")
    number = F.explode(F.sequence(F.greatest(F.col("first") - lookback, F.lit(1)), F.col("first") - 1))
    wanted = firsts.select("_trip", "slice", number.alias("at"))
    return wanted.join(ends.drop("slice", "rn"), ["_trip", "at"]).select(key, "slice", *carried)


def with_context(df: DataFrame, lookback: int, slices: TripSlices, *views: DataFrame) -> DataFrame:
    """All rows with their ``slice``, and ahead of each slice, marked as ``context``, the
    ``lookback`` rows before it: of ``df`` and of each of ``views``, which are filtered forms
    of it. Windows over (trip, slice) of ``df`` or of a view then need nothing else."""
    columns = [c for c in df.columns if c != slices.key]
    copy = F.row_number().over(Window.partitionBy(slices.key, "slice", *columns).orderBy(F.lit(0)))
    context = None
    for view in (df, *views):
        rows = _rows_before_slices(view, lookback, columns, slices).withColumn("copy", copy)
        context = rows if context is None else context.unionByName(rows).distinct()
    rows = slices.assign(df).withColumn("context", F.lit(False))
    return rows.unionByName(context.drop("copy").withColumn("context", F.lit(True)))


def trip_ordinal(df: DataFrame, slices: TripSlices, name: str = "ordinal") -> DataFrame:
    """Number each trip's rows from 1 in time order."""
    order = [slices.time, slices.seq]
    if not slices.needed:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(slices.key).orderBy(*order)))
    key = slices.key
    rows = slices.assign(df).withColumn("_trip", slices.named())
    earlier = Window.partitionBy("_trip").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice of a long trip.
    offsets = (
        slices.assign(df, long_trips_only=True)
        .groupBy(slices.named().alias("_trip"), "slice")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("_trip", "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    )
    local = F.row_number().over(Window.partitionBy(key, "slice").orderBy(*order))
    return (
        rows.withColumn(name, local)
        .join(offsets, ["_trip", "slice"], "left")
        .withColumn(name, (F.col(name) + F.coalesce("offset", F.lit(0))).cast("long"))
        .drop("slice", "offset", "_trip")
    )


def in_last_rows(keep: int, window: Window) -> Column:
    """True for the last ``keep`` rows of a window group: exactly a trip's last rows, or
    with slices those of each slice, the trip's own among them."""
    return F.lead(F.lit(1), keep).over(window).isNull()

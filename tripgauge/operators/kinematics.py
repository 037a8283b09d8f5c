"""Previous sample, deltas, acceleration and trailing statistics along each trip."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripgauge.functions.columns import acceleration, elapsed_seconds
from tripgauge.operators.slicing import SLICE_ROWS, TripSlices, in_last_rows, over_trips, plan_slices
from tripgauge.profiles import Profile

ROLLING_ROWS = 11


def kinematics(
    df: DataFrame,
    profile: Profile,
    keep_points: int | None = None,
    slices: TripSlices | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add ``prev_speed``, ``prev_time``, ``delta_v``, ``delta_t`` and ``accel``.

    With ``keep_points`` also ``in_tail``, which marks the rows a report of the last
    ``keep_points`` samples can need; it shares the window, so it costs no sort.
    """
    slices = slices or plan_slices(df, slice_rows=slice_rows)

    def derive(frame: DataFrame, keys: list[str]) -> DataFrame:
        trip = Window.partitionBy(*keys).orderBy("event_time", "seq")
        added = {
            "prev_speed": F.lag("speed_kmh").over(trip),
            "prev_time": F.lag("event_time").over(trip),
        }
        if keep_points is not None:
            added["in_tail"] = in_last_rows(keep_points, trip)
        return frame.withColumns(added)

    lagged = over_trips(df, derive, 1, ["speed_kmh"], slices)
    delta_v = (F.col("speed_kmh") - F.col("prev_speed")) / F.lit(profile.accel_divisor)
    delta_t = elapsed_seconds(F.col("event_time"), F.col("prev_time"))
    accel = acceleration(F.col("speed_kmh"), F.col("prev_speed"), F.col("delta_t"), profile)
    out = lagged.withColumns({"delta_v": delta_v, "delta_t": delta_t}).withColumn("accel", accel)
    return out.fillna(0.0, subset=["delta_v", "delta_t"]) if profile.fill_deltas else out


def rolling_stats(
    df: DataFrame,
    rows: int = ROLLING_ROWS,
    slices: TripSlices | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Mean and maximum speed and mean acceleration over the current row and the
    ``rows - 1`` before it. Expects ``accel``."""
    slices = slices or plan_slices(df, slice_rows=slice_rows)

    def derive(frame: DataFrame, keys: list[str]) -> DataFrame:
        trailing = Window.partitionBy(*keys).orderBy("event_time", "seq").rowsBetween(1 - rows, 0)
        return frame.withColumns({
            "rolling_avg_speed": F.avg("speed_kmh").over(trailing),
            "rolling_max_speed": F.max("speed_kmh").over(trailing),
            "rolling_avg_accel": F.avg("accel").over(trailing),
        })

    return over_trips(df, derive, rows - 1, ["speed_kmh", "accel"], slices)

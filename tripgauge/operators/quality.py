"""Filters that decide which samples count."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripgauge.profiles import LAT_MAX, LAT_MIN, LON_MAX, LON_MIN, RETENTION_SECONDS


LONG_MIN = -(2**63)
# Microseconds around 1970 that write times are told apart in.
TIME_REACH = 2**61


class EmptyInputError(ValueError):
    """The input holds no rows and the profile treats that as an error."""


def position_inside() -> Column:
    """Whether the position lies inside the inclusive bounds; null or false for null and NaN."""
    return F.col("lat").between(F.lit(LAT_MIN), F.lit(LAT_MAX)) & F.col("lon").between(F.lit(LON_MIN), F.lit(LON_MAX))


def filter_coordinates(df: DataFrame) -> DataFrame:
    """Rows whose position lies inside the inclusive bounds; null and NaN fall out."""
    return df.filter(position_inside())


def retain(df: DataFrame, as_of: Column, ttl_seconds: int = RETENTION_SECONDS) -> DataFrame:
    """Rows written less than ``ttl_seconds`` before ``as_of``."""
    return df.filter(F.col("ingested_at") > as_of - F.make_interval(secs=F.lit(ttl_seconds)))


def moment_order(time: str, seq: str) -> Column:
    """Time and sequence as one number that sorts as the two do, null lowest. Times reach
    over 70,000 years around 1970 beside the 64 bits of the sequence."""
    micros = F.coalesce(F.unix_micros(time), F.lit(LONG_MIN))
    within = F.greatest(F.lit(-TIME_REACH), F.least(F.lit(TIME_REACH), micros)).cast("decimal(19,0)")
    number = F.coalesce(F.col(seq), F.lit(LONG_MIN)).cast("decimal(19,0)")
    return (within * F.lit(Decimal(2**64)) + number).cast("decimal(38,0)")


def dedup_lww(df: DataFrame) -> DataFrame:
    """One row per trip and time, the one written last: by write time, then by
    ``batch_id`` where there is one, and by ``seq`` only among those. What is null counts
    as earliest. Copies collapse on the map side, so a heavily repeated key reaches the
    shuffle as one row per task. Columns are picked one by one, and the order is a
    number: of fixed width, they keep this in a hash aggregate, where a struct would need
    its input sorted. With ``batch_id`` the first aggregate leaves one row of each batch, by time
    and sequence within it, and the second takes the batch that wrote last."""
    keys = ["trip_id", "event_time"]

    def latest(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
        picked = [F.max_by(c, order).alias(c) for c in rows.columns if c not in keys]
        return rows.groupBy(*keys).agg(*picked)

    if "batch_id" in df.columns:
        of_batch = latest(df, [*keys, "batch_id"], moment_order("ingested_at", "seq"))
        return latest(of_batch, keys, moment_order("ingested_at", "batch_id")).select(*df.columns)
    return latest(df, keys, moment_order("ingested_at", "seq")).select(*df.columns)


def dedup_whole_trips(df: DataFrame) -> DataFrame:
    """What ``dedup_lww`` gives, for input that ``plan_slices`` found no long trip in. Rows are
    shuffled by trip, as windows over trips need them, and sorted by time and sequence within it, so
    that those windows need no shuffle and no sort of their own. Rows of the same write time, batch
    and sequence are one."""
    written = ["ingested_at", *(["batch_id"] if "batch_id" in df.columns else [])]
    copies = Window.partitionBy("trip_id", "event_time").orderBy("seq", *written)
    write = F.struct(*written, "seq")
    newest = F.max("_write").over(copies.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return (
        df.repartition("trip_id")
        .withColumn("_write", write)
        .withColumns({"_newest": newest, "_next": F.lead("_write").over(copies)})
        .filter((F.col("_write") == F.col("_newest")) & ~F.col("_write").eqNullSafe(F.col("_next")))
        .select(*df.columns)
    )


def require_rows(df: DataFrame, on_empty: str = "skip") -> bool:
    """True when there are rows; without any, False or an error."""
    if not df.isEmpty():
        return True
    if on_empty == "raise":
        raise EmptyInputError("the telemetry input holds no rows")
    return False

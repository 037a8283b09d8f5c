"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripgauge.functions.dates import lenient_time
from tripgauge.profiles import Profile

# Risk bands, acceleration bands and gauge scale.
LOW_MAX, MODERATE_MAX = 30.0, 70.0
STRONG_ACCEL, HARD_BRAKE = 2.0, -4.5
GAUGE_LIMIT = 120.0

# Mean and variance of doubles carry noise near 1e-12 that depends on the order of
# addition; rounding to this many places first makes later ties independent of it.
NOISE_DECIMALS = 9


def stable_round(value: Column, decimals: int, half_even: bool = False) -> Column:
    rounded = F.bround if half_even else F.round
    return rounded(F.round(value, NOISE_DECIMALS), decimals)


def is_speeding(profile: Profile, speed: str = "speed_kmh") -> Column:
    return F.col(speed) > F.lit(profile.speed_limit)


def is_hard_brake(profile: Profile, accel: str = "accel") -> Column:
    threshold = F.lit(profile.brake_threshold)
    return F.col(accel) <= threshold if profile.brake_inclusive else F.col(accel) < threshold


def elapsed_seconds(now: Column, before: Column) -> Column:
    """Seconds between two timestamps; the subtraction is in whole microseconds."""
    return (F.unix_micros(now) - F.unix_micros(before)).cast("double") / F.lit(1e6)


def acceleration(speed: Column, prev_speed: Column, seconds: Column, profile: Profile) -> Column:
    """Speed change over time; zero for the first sample and for intervals that do
    not advance, and in place of null or NaN."""
    change = (speed - prev_speed) / F.lit(profile.accel_divisor)
    raw = F.when(seconds > 0.0, change / seconds).otherwise(F.lit(0.0))
    return F.coalesce(F.nanvl(raw, F.lit(0.0)), F.lit(0.0))


def risk_band(score: Column) -> Column:
    s = F.coalesce(score, F.lit(0.0))
    return (
        F.when((s > LOW_MAX) & (s <= MODERATE_MAX), "MODERATE")
        .when(s > MODERATE_MAX, "HIGH")
        .otherwise("LOW")
    )


def accel_band(accel: Column) -> Column:
    a = F.coalesce(accel, F.lit(0.0))
    return (
        F.when(a >= STRONG_ACCEL, "STRONG_ACCEL")
        .when(a < HARD_BRAKE, "HARD_BRAKE")
        .otherwise("NORMAL")
    )


def gauge_angle(speed: Column) -> Column:
    """Dial angle in degrees, -90 at rest to 90 at the gauge limit."""
    return F.lit(-90.0) + F.least(speed, F.lit(GAUGE_LIMIT)) / F.lit(GAUGE_LIMIT) * F.lit(180.0)


def needle_angle(avg_speed: Column) -> Column:
    """Angle of the drawn needle, in degrees."""
    return F.lit(210.0) - F.coalesce(avg_speed, F.lit(0.0)) * F.lit(1.5)


def percent_share(weight: Column) -> Column:
    """Weight as a percentage: fractions are scaled by 100, the result stops at 100."""
    w = F.coalesce(weight, F.lit(0.0))
    return F.round(F.least(F.when(w <= 1.0, w * 100.0).otherwise(w), F.lit(100.0)), 1)


def number_or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def first_truthy_number(*texts: Column) -> Column:
    """First text that is neither missing, empty nor zero, as a number; 0.0 when
    there is none or when it is not numeric."""
    zero = F.lit(0.0)
    usable = [
        F.when(t.isNotNull() & (t != "") & F.coalesce(t.try_cast("double") != 0.0, F.lit(True)), t)
        for t in texts
    ]
    return F.coalesce(F.coalesce(*usable).try_cast("double"), zero)


def parse_time(text: Column, as_of: Column) -> Column:
    """Timestamp from padded text, or ``as_of``. Spark's cast reads date and time joined
    by a space or a T, with or without a fraction, and shorter forms; unlike a chain of
    patterns it raises no exception per row for those that do not match. Only those are
    then read as people write dates, with the day of ``as_of`` for what they leave out."""
    return F.coalesce(F.trim(text).try_cast("timestamp"), lenient_time(text, as_of), as_of)


def time_of_day(text: Column) -> Column:
    """Text between the first and second space, up to its first dot; without a space
    the text itself, and N/A when there is none."""
    value = F.coalesce(text, F.lit(""))
    second = F.get(F.split(value, " "), F.lit(1))
    return F.coalesce(
        F.get(F.split(second, r"\."), F.lit(0)),
        F.when(value != "", value),
        F.lit("N/A"),
    )


def time_text(timestamp: Column) -> Column:
    """Timestamp in the session zone, with a fraction only when it has one."""
    return timestamp.cast("string")


def iso_time(timestamp: Column) -> Column:
    """ISO 8601 local time, microseconds only when there are any."""
    return F.when(
        F.unix_micros(timestamp) % 1_000_000 == 0,
        F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss"),
    ).otherwise(F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def tail(items: Column, keep: int, size: Column | None = None) -> Column:
    """Last ``keep`` elements of an array, or all of a shorter one. ``size`` spares a
    second evaluation of a costly ``items``."""
    length = F.size(items) if size is None else size
    return F.slice(items, F.greatest(F.lit(1), length - F.lit(keep - 1)), keep)

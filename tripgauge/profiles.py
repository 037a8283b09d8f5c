"""Scoring profiles: every threshold, unit and weight of a run in one value."""

from __future__ import annotations

from dataclasses import dataclass

WEIGHT_TOLERANCE = 1e-9

# Inclusive coordinate bounds in degrees.
LAT_MIN, LAT_MAX = -90.0, 90.0
LON_MIN, LON_MAX = -180.0, 180.0

# Position reported when a trip has none.
DEFAULT_LAT, DEFAULT_LON = -12.0464, -77.0428

# Position the web page falls back to.
PAGE_LAT, PAGE_LON = -12.046374, -77.042793

# Points per unit of each signal of the score.
PER_SPEEDING, PER_VARIANCE, PER_BRAKE = 5.0, 2.0, 10.0

RETENTION_SECONDS = 600
KEEP_POINTS = 100


@dataclass(frozen=True)
class Profile:
    name: str
    speed_limit: float
    brake_threshold: float
    brake_inclusive: bool
    accel_divisor: float
    variance_divisor: float
    variance_decimals: int | None
    weight_speeding: float
    weight_variance: float
    weight_braking: float
    per_trip: bool
    filter_coordinates: bool
    fill_deltas: bool
    on_empty: str
    half_even: bool

    def __post_init__(self) -> None:
        self.validate()

    @property
    def signals(self) -> tuple[tuple[str, float, float, float], ...]:
        """Column, its unit, points per unit and weight of each signal of the score."""
        return (
            ("accel_variance", self.variance_divisor, PER_VARIANCE, self.weight_variance),
            ("speeding_alerts", 1.0, PER_SPEEDING, self.weight_speeding),
            ("hard_brakes", 1.0, PER_BRAKE, self.weight_braking),
        )

    def validate(self) -> None:
        total = self.weight_speeding + self.weight_variance + self.weight_braking
        if abs(total - 1.0) >= WEIGHT_TOLERANCE:
            raise ValueError(f"weights of profile {self.name!r} sum to {total}, not 1.0")


# Per-trip metrics, accelerations in m/s².
CURRENT = Profile(
    name="current",
    speed_limit=90.0,
    brake_threshold=-4.5,
    brake_inclusive=False,
    accel_divisor=3.6,
    variance_divisor=1.0,
    variance_decimals=None,
    weight_speeding=0.35,
    weight_variance=0.40,
    weight_braking=0.25,
    per_trip=True,
    filter_coordinates=True,
    fill_deltas=False,
    on_empty="skip",
    half_even=False,
)

# One score over the whole input, accelerations in km/h per second.
LEGACY = Profile(
    name="legacy",
    speed_limit=80.0,
    brake_threshold=-12.0,
    brake_inclusive=True,
    accel_divisor=1.0,
    variance_divisor=12.96,
    variance_decimals=4,
    weight_speeding=0.30,
    weight_variance=0.30,
    weight_braking=0.40,
    per_trip=False,
    filter_coordinates=False,
    fill_deltas=True,
    on_empty="raise",
    half_even=True,
)

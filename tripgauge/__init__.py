"""Vehicle-telemetry analytics on Spark DataFrames."""

__version__ = "0.2.0"

from tripgauge.profiles import CURRENT, LEGACY, Profile  # noqa: E402

__all__ = ["CURRENT", "LEGACY", "Profile"]

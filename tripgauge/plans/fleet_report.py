"""One report over the whole input, computed in a single job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgauge.operators.metrics import fleet_metrics
from tripgauge.operators.scoring import risk_score
from tripgauge.operators.slicing import SLICE_ROWS
from tripgauge.plans.trip_report import (
    LINEAGE_ETL,
    LINEAGE_FLEET_SINK,
    LINEAGE_PRINCIPLES,
    LINEAGE_VARIANCE,
    PROJECT,
    VERSION,
    engine_name,
    enriched_samples,
    weights,
)
from tripgauge.profiles import LEGACY, Profile


def scored_fleet(df: DataFrame, profile: Profile = LEGACY, slice_rows: int = SLICE_ROWS) -> DataFrame:
    return risk_score(fleet_metrics(enriched_samples(df, profile, slice_rows=slice_rows), profile), profile)


def build_fleet_report(df: DataFrame, profile: Profile = LEGACY, as_of: Column | None = None) -> DataFrame:
    """The nested document; ``df`` is telemetry, or the result of ``scored_fleet``."""
    scored = df if "risk_score" in df.columns else scored_fleet(df, profile)
    now = F.current_timestamp() if as_of is None else as_of
    return scored.select(
        F.lit(PROJECT).alias("project"),
        F.lit(VERSION).alias("pipeline_version"),
        now.alias("analyzed_at"),
        F.struct(
            "samples", "avg_speed_kmh", "max_speed_kmh", "speeding_alerts",
            F.lit(profile.speed_limit).alias("speed_limit"),
        ).alias("basic"),
        F.struct(
            "accel_variance", "accel_mean", "accel_mean_square", "hard_brakes",
            F.lit(profile.brake_threshold).alias("brake_threshold"),
            F.col("risk_score").alias("score"),
            weights(profile).alias("weights"),
        ).alias("risk"),
        F.struct(
            F.lit(engine_name(scored.sparkSession)).alias("engine"),
            F.lit(LINEAGE_ETL).alias("etl"),
            F.lit(LINEAGE_VARIANCE).alias("variance"),
            F.lit(LINEAGE_FLEET_SINK).alias("persistence"),
            F.lit(LINEAGE_PRINCIPLES).alias("principles"),
        ).alias("lineage"),
    )

"""Risk score: signals turned to points, each up to 100, and added up by weight."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgauge.functions.columns import stable_round
from tripgauge.profiles import Profile

def risk_score(metrics: DataFrame, profile: Profile) -> DataFrame:
    """Add ``risk_score``, 0 to 100 with two decimals. ``profile.signals`` says which
    columns count, for how many points per unit, and at what weight."""

    def capped(column):
        return F.least(column, F.lit(100.0))

    parts = [
        capped(F.col(column) / F.lit(unit) * F.lit(points)) * F.lit(weight)
        for column, unit, points, weight in profile.signals
    ]
    total = F.greatest(F.lit(0.0), capped(reduce(lambda a, b: a + b, parts)))
    return metrics.withColumn("risk_score", stable_round(total, 2, profile.half_even))

"""Connected components of links, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgauge.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``links`` (``a, b``), ``root`` being the smallest node
    it is linked to, however far. Nodes without a link to another are left out.

    Rounds of large-star and small-star: each node hangs its larger neighbours, then its
    smaller ones and itself, below the smallest of them. The longest path shrinks
    by powers, so few rounds do; they go on until one changes nothing. A round is a minimum per node, combined on the map
    side, and a join back that adaptive execution splits at a hot node; every round is a
    written table. Only sums reach the driver.
    """
    edges = stage(_normal(links.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))), "links")
    seen = _fingerprint(edges)
    while seen[0]:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = _normal(both.filter("v > u").join(least, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")))
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(lowest, "hi").select(F.col("m").alias("lo"), F.col("lo").alias("hi")).unionByName(
            lowest.select(F.col("m").alias("lo"), "hi")
        )
        edges = stage(_normal(small), "links")
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )


def _normal(edges: DataFrame) -> DataFrame:
    return edges.filter("lo < hi").distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).head()
    return tuple(row)

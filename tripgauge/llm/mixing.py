"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, target over size.
Summed along the source that is a line with one random offset on it; a document is taken
once per integer the line crosses on its stretch. Documents stand in order of their
size, so what is taken of each size is in proportion and the words taken come within
about one document of the target.

A document's place in its source is found by counting, in three levels: the sizes of a
source, the pieces of a size, the rows of a piece. No level gathers the rows of a source,
nor those of a source that share a size, in one task. Only built-in expressions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripgauge.llm.common import WORDS

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
PIECES = 1024
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """Targets of the sources. ``sizes``: ``source_key`` in the order that deals out the
    weights, and ``source_size``. All targets together are ``share`` of all sizes; none is
    over ``cap`` times its size, and what exceeds that goes to the others by weight.

    Sources fill up in order of size per weight: the first that stays below its cap
    tells the level, the target per unit of weight, of all that follow (it is the highest).
    """
    dealt = F.element_at(F.lit(list(weights)), (F.col("place") % len(weights) + 1).cast("int"))
    placed = sizes.withColumn("place", F.row_number().over(Window.orderBy("source_key")) - 1).withColumn(
        "weight", dealt.cast("double")
    )
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), "source_key")
    limit = F.col("source_size") * F.lit(float(cap))
    levels = placed.withColumns({
        "before": F.coalesce(F.sum(limit).over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "rest": F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)),
        "budget": F.sum("source_size").over(Window.partitionBy()) * F.lit(share),
    }).withColumn("level", F.greatest(F.col("budget") - F.col("before"), F.lit(0.0)) / F.col("rest"))
    free = F.when(F.col("level") * F.col("weight") < limit, F.col("level"))
    level = F.max(free).over(Window.partitionBy())
    target = F.when(F.col("level") * F.col("weight") < limit, F.col("weight") * level).otherwise(limit)
    return levels.select("source_key", "source_size", target.alias("target"))


def source_key(source: Column) -> Column:
    """Sorts as the source by code point, null last."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("~"))


def mix_plan(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    cap: int = CAP,
    pieces: int = PIECES,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` with ``mix_size`` (words), ``mix_source_size``, ``mix_target`` and
    ``mix_copies``, the times the mix takes the document.

    Null texts have size 0 and null is a source of its own, as is the empty string. Rows
    without words may be taken too, they change no sum. Rows alike in source, size and
    ``doc_id`` may swap their copies. Columns of ``docs`` keep their names; any that
    start with ``mix_`` are left out. Reruns agree, however the rows are partitioned.
    """
    docs = docs.drop(*(c for c in docs.columns if c.lower().startswith("mix_")))
    rows = docs.withColumns({
        "mix_key": source_key(F.col(source)),
        "mix_size": word_count(F.col(text)),
        "mix_piece": F.pmod(F.coalesce(F.col(doc_id).cast("long"), F.lit(0)), F.lit(pieces)),
    })
    cell = ["mix_key", "mix_size", "mix_piece"]
    cells = rows.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"))
    of_size = cells.groupBy("mix_key", "mix_size").agg(F.sum("n").alias("size_n"))
    before = Window.unboundedPreceding, -1
    by_size = Window.partitionBy("mix_key").orderBy("mix_size").rowsBetween(*before)
    by_piece = Window.partitionBy("mix_key", "mix_size").orderBy("mix_piece").rowsBetween(*before)
    sizes = of_size.groupBy(F.col("mix_key").alias("source_key")).agg(
        F.sum(F.col("mix_size") * F.col("size_n")).alias("source_size")
    )
    targets = source_targets(sizes, weights, share, cap).select(
        F.col("source_key").alias("mix_key"),
        F.col("source_size").alias("mix_source_size"),
        F.col("target").alias("mix_target"),
    )
    starts = (
        of_size.withColumn("size_start", F.coalesce(F.sum("size_n").over(by_size), F.lit(0)))
        .join(targets, "mix_key")
        .drop("size_n")
    )
    places = (
        cells.withColumn("piece_start", F.coalesce(F.sum("n").over(by_piece), F.lit(0)))
        .join(starts, ["mix_key", "mix_size"])
        .withColumn("mix_start", F.col("size_start") + F.col("piece_start"))
        .select(*cell, "mix_start", "mix_source_size", "mix_target")
    )
    within = F.row_number().over(Window.partitionBy(*cell).orderBy(F.col(doc_id)))
    k = F.col("mix_start") + F.col("mix_row")
    ratio = F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")).otherwise(F.lit(0.0))
    offset = F.conv(F.substring(F.sha2(F.concat(F.lit(seed), F.col("mix_key")).cast("binary"), 256), 1, 12), 16, 10)
    line = offset.cast("double") / F.lit(float(1 << 48))
    crossed = F.floor(k * F.col("mix_ratio") + line) - F.floor((k - 1) * F.col("mix_ratio") + line)
    return (
        rows.withColumn("mix_row", within)
        .join(places, cell)
        .withColumn("mix_ratio", ratio)
        .withColumn("mix_copies", F.least(crossed, F.lit(cap)).cast("long"))
        .select(*docs.columns, "mix_size", "mix_source_size", "mix_target", "mix_copies")
    )


def mix(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", **options
) -> DataFrame:
    """The mixed documents, each as often as it is taken, in all columns of ``docs``, whatever
    their names."""
    at = {name: f"c{i}" for i, name in enumerate(docs.columns)}
    plan = mix_plan(docs.toDF(*at.values()), at[text], at[doc_id], at[source], **options).filter("mix_copies > 0")
    repeated = plan.withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int"))))
    return repeated.select(*at.values()).toDF(*at)

"""Labelled rows to learn from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgauge.llm.common import held_out, stage

# The bound of the sample that a classifier is fitted on.
FIT_ROWS = 24_000


def known(labels: DataFrame, label: str) -> DataFrame:
    """``doc_id, label`` of those that aren't held out; of several for an id the largest counts,
    and rows without either take no part."""
    return (
        labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label"))
        .dropna()
        .filter(~held_out(F.col("doc_id"), 4, 2))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )


def _with_text(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, text, label, h`` of every row of a known id; equal ``text, label`` share ``h``."""
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return text.join(labels, "doc_id").withColumn("h", F.xxhash64("label", "text"))


def first_ids(ids: DataFrame, rows: int) -> DataFrame:
    return ids.select("doc_id").dropna().distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def one_text_of_each(sample: DataFrame) -> DataFrame:
    """Of the rows of each id that of the lowest ``h``, so that an id of very many texts counts once
    and no more rows than ids reach the driver; equal ``text, label`` count once."""
    lowest = sample.groupBy("doc_id").agg(F.min("h").alias("h"))
    return sample.join(lowest, ["doc_id", "h"], "left_semi").dropDuplicates(["h"])


def fit_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = FIT_ROWS) -> DataFrame:
    """``text, label`` of at most ``rows`` labelled rows that aren't held out: one of each of the
    ids of lowest hash. Equal texts count once per label."""
    found = known(labels, label)
    ids = first_ids(found.join(docs.select("doc_id").dropna().distinct(), "doc_id", "left_semi"), rows)
    chosen = _with_text(docs, found.join(ids, "doc_id"))
    sample = one_text_of_each(stage(chosen, f"labelled-{label}")).select("text", "label")
    return stage(sample, f"fit-{label}")

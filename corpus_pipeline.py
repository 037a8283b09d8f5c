"""A corpus pipeline of five stages; each works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgauge.llm.bpe import encode_documents
from tripgauge.llm.common import stage, table
from tripgauge.llm.exact import exact_dedup
from tripgauge.llm.mixing import mix
from tripgauge.llm.near import near_dedup
from tripgauge.llm.queries import TOXIC, VOCABULARY
from tripgauge.llm.toxicity import score_toxicity, toxicity_model


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the score that the numbered query calls toxic. The lexicon is learned
    from those of ``labels`` that aren't held out."""
    model = toxicity_model(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    score = "toxicity"
    while score in map(str.lower, docs.columns):
        score += "_"
    return score_toxicity(docs, model, score=score).filter(F.col(score) < TOXIC).drop(score)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup(docs, single=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts that share most of their five-word shingles."""
    return near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, their number and the digest of what they decode to."""
    encoded = encode_documents(
        docs.select("doc_id", "lang", "source", "text"), VOCABULARY, decoded_sha256="decoded_sha256"
    )
    return encoded.select(
        "doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), "decoded_sha256"
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]
# Learned weights and fingerprints can't be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{i}")
    return docs

"""The numbered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgauge.llm.bpe import token_digests
from tripgauge.llm.common import WORDS, held_out, table
from tripgauge.llm.exact import exact_groups
from tripgauge.llm.lm import score_texts
from tripgauge.llm.mixing import mix_plan
from tripgauge.llm.periodic import periodic_runs
from tripgauge.llm.quality import CUT, quality_model, score_quality
from tripgauge.llm.ranked import search
from tripgauge.llm.simhash import simhash_classes
from tripgauge.llm.suffix import remove_repeats
from tripgauge.llm.token_count import count_tokens
from tripgauge.llm.topk import quantised, top_k
from tripgauge.llm.toxicity import score_toxicity, toxicity_model
from tripgauge.llm.warc import archive, read_bundles

TOXIC = 0.3
VOCABULARY = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix_plan(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return plan.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_copies") * F.col("mix_size")).alias("taken"),
    )


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, index = archive(table(spark, sf_dir, "pages"))
    records = read_bundles(index, folder)

    def page(name: str):
        number = F.regexp_extract(name, "^urn:page:(-?[0-9]+)$", 1)
        return F.when(number != "", number.cast("long"))

    return records.select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
    )


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The result shows the digest of every text, so all are hashed in the one scan.
    groups = exact_groups(table(spark, sf_dir, "documents"), digest_all=True)
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash_classes(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    return _predicted(score_quality(docs, model), CUT)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return _predicted(score_toxicity(docs, model), TOXIC)


def _predicted(scored: DataFrame, cut: float) -> DataFrame:
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), 4, 2).alias("held_out"),
        "score",
        (F.col("score") >= cut).cast("int").alias("predicted"),
    )


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"), VOCABULARY)


def op11_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sized = docs.withColumn("n_bytes", F.octet_length("text").cast("long"))
    return count_tokens(sized, PIECES).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    )


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs(docs.withColumn("text", _with_loops(F.col("doc_id"), F.col("text"))))
    run = "struct<start:bigint,length:bigint,period:bigint>"
    # Runs come by start, then period, so the first of equal ones stays.
    most = F.reduce("runs", F.lit(None).cast(run), lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r
    ).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("most", most).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "most.*",
        F.expr("1000 * most.length div most.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def _with_loops(doc_id: Column, text: Column) -> Column:
    """The text of a tenth of the ids with a passage that repeats to the end, as the query has it.
    Without an id none is put in."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))
    n = F.size(words)
    a = F.pmod(g, n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    passage = F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))
    looped = F.concat(F.slice(words, F.lit(1), a), F.slice(F.flatten(passage), F.lit(1), n - a))
    return F.when((h % 10 == 0) & (n > 0), F.concat_ws(" ", looped)).otherwise(text)


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_topk": op2_topk,
    "op3_warc": op3_warc,
    "op4_lm": op4_lm,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_simhash": op6_simhash,
    "op7_repeats": op7_repeats,
    "op8_quality": op8_quality,
    "op9_toxicity": op9_toxicity,
    "op10_bpe": op10_bpe,
    "op11_ranked": op11_ranked,
    "op12_token_counts": op12_token_counts,
    "op13_periodic": op13_periodic,
}

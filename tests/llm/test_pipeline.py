"""The pipeline's stages against plain versions of their decisions, and every query on the
smallest tables."""

import collections

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.test_near import plain_classes
from tests.llm.test_operators import VOCABULARY
from tripgauge.llm import bpe, mixing
from tripgauge.llm.common import stage, table
from tripgauge.llm.near import SIMILARITY
from tripgauge.llm.oracle import ORACLE
from tripgauge.llm.queries import QUERIES, TOXIC
from tripgauge.llm.toxicity import toxicity_model

SMALL = "/root/testdata/sf0.001"
SEVERAL = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = table(spark, SEVERAL, "documents")
    kept, columns = docs, docs.columns
    rows = {r["doc_id"]: r for r in docs.collect()}
    for name, step in corpus_pipeline.STAGES:
        before = kept.collect()
        kept = stage(step(spark, kept, SEVERAL), "test")
        after = kept.collect()
        ids = [r["doc_id"] for r in after]
        if name == "toxicity":
            model = toxicity_model(docs, table(spark, SEVERAL, "labels"))
            want = [r["doc_id"] for r in before if model.score(r["text"]) < TOXIC]
        elif name == "exact dedup":
            first = {}
            for r in sorted(before):
                first.setdefault(" ".join((r["text"] or "").replace("\n", " ").split(" ")), r["doc_id"])
            want = list(first.values())
        elif name == "near dedup":
            first, _ = plain_classes([r["text"] for r in sorted(before)], SIMILARITY)
            want = [sorted(before)[i]["doc_id"] for i in first]
        elif name == "mixing":
            plan = mixing.mix_plan(spark.createDataFrame(before, docs.schema)).collect()
            want = [r["doc_id"] for r in plan for _ in range(r["mix_copies"])]
        else:
            want = [r["doc_id"] for r in before]
            codec = bpe.codec(bpe._vocabulary(VOCABULARY))
            for r in after[:50]:
                assert r["ids"] == codec.encode(rows[r["doc_id"]]["text"]).tolist() and r["n_tokens"] == len(r["ids"])
        assert collections.Counter(ids) == collections.Counter(want), name
        if name != "bpe":
            assert kept.columns == columns and all(r == rows[r["doc_id"]] for r in after)
    whole = corpus_pipeline.run(spark, SEVERAL)
    assert sorted(map(tuple, whole.select("doc_id", "decoded_sha256").collect())) == sorted(
        map(tuple, kept.select("doc_id", "decoded_sha256").collect())
    )


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    df = entry.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*columns).collect()]
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert got and sorted(got, key=repr) == sorted(want, key=repr)


def test_toxicity_stage_keeps_a_column_of_that_name(spark):
    docs = table(spark, SMALL, "documents").withColumn("Toxicity", F.lit("mine"))
    kept = corpus_pipeline.STAGES[0][1](spark, docs, SMALL)
    assert kept.columns == docs.columns and {r["Toxicity"] for r in kept.select("Toxicity").collect()} == {"mine"}


def test_all_are_registered():
    assert {n for n in entry.queries() if n.startswith("op")} == set(QUERIES) and len(QUERIES) == 13
    assert "pipeline" in entry.queries()

"""Helpers the operators share."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgauge.session import scratch_dir

# The space characters that separate words; everything else is part of a word.
SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: later steps start from
    the files, whatever becomes of the executors that made them."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id's decimal text leaves ``remainder``; null counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def without(docs: DataFrame, dropped: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """``docs`` less the rows whose ``keys`` are, one by one, the columns of a row of
    ``dropped``. A null key equals none. Names of the two may clash."""
    names = [f"k{i}" for i in range(len(keys))]
    own = {f"c{i}": F.col(f"`{c}`") for i, c in enumerate(docs.columns)}
    marked = docs.select(
        *(k.alias(n) for n, k in zip(names, keys, strict=True)), *(c.alias(n) for n, c in own.items())
    )
    return marked.join(dropped.toDF(*names), names, "left_anti").select(*own).toDF(*docs.columns)


def one_of_each(docs: DataFrame, rows: DataFrame, doc_id: Column, own: Column) -> DataFrame:
    """``docs`` with one row of each group: of the smallest ``doc_id``, null last, and of its
    texts that of the smallest digest. ``rows`` has ``doc_id, own, group`` of rows that belong to
    groups, ``own`` being a digest of the whole text; other rows of ``docs`` stay. Of rows
    equal in both any one stays. Counts combine on the map side; names may clash."""
    key = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "own")
    counted = rows.groupBy("group", "doc_id", "own").agg(F.count(F.lit(1)).alias("n"))
    first = counted.groupBy("group").agg(F.min(key).alias("first"), F.sum("n").alias("size")).filter("size > 1")
    judged = stage(
        counted.join(first, "group").select("doc_id", "own", (key == F.col("first")).alias("stays"), "n")
        .filter("NOT stays OR n > 1"),
        "copies",
    )

    def keys(i: Column, o: Column) -> list[Column]:
        # Without nulls, so that both joins below shuffle the same rows and share one shuffle.
        return [
            i.isNull().alias("k0"), F.coalesce(i.cast("string"), F.lit("")).alias("k1"), F.coalesce(o, F.lit("")).alias("k2")
        ]

    names = ["k0", "k1", "k2"]
    columns = {f"c{i}": F.col(f"`{c}`") for i, c in enumerate(docs.columns)}
    marked = docs.select(*keys(doc_id, own), *(c.alias(n) for n, c in columns.items()))
    out = judged.select(*keys(F.col("doc_id"), F.col("own")), "stays")
    rest = marked.join(out.select(*names), names, "left_anti").select(*columns)
    again = (
        marked.join(out.filter("stays").select(*names), names, "left_semi")
        .groupBy(*names).agg(F.first(F.struct(*columns)).alias("row")).select("row.*")
    )
    return rest.unionByName(again).toDF(*docs.columns)


def pieces_of(df: DataFrame, amount: Column, per_piece: int) -> int:
    """How many pieces of ``per_piece`` the sum of ``amount`` makes, 1 at least."""
    total = df.agg(F.sum(amount)).head()[0] or 0
    return max(1, math.ceil(total / per_piece))

"""Exact deduplication by progressive refinement.

Texts are told apart by their length, those that share one by a hash of their first
characters, and only those that share both by a hash of all their content. Every level
is a count per key that combines on the map side, so a hot group reaches the shuffle as
one row per task, and what goes on to the next level is a semi join that adaptive
execution splits where it is skewed. Only built-in expressions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgauge.llm.common import SPACES, one_of_each, stage, without

PREFIX_CHARS = 64


def normalised(text: Column) -> Column:
    """The text with every run of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def exact_groups(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    prefix_chars: int = PREFIX_CHARS,
    digest_all: bool = False,
    carry: Sequence[Column] = (),
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept`` and
    ``text_sha256`` of the normalised text.

    Of equal texts the smallest ``doc_id`` stays. The digest is null where length or
    prefix already make a text unique, unless ``digest_all``: then every text is
    hashed in the first scan and nothing is read twice. Rows that share a ``doc_id`` and
    a text are both kept or both dropped. A row with a null ``doc_id`` is kept only where
    its group has no other id, and names no ``keep_id`` then. Of further columns only
    those of ``carry`` come along, and no rows give no rows.
    """
    norm = normalised(F.col(text))
    digest = F.sha2(norm.cast("binary"), 256)
    narrow = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.octet_length(norm).cast("long").alias("len"),
        F.xxhash64(F.substring(norm, 1, prefix_chars)).alias("prefix"),
        *([digest.alias("text_sha256")] if digest_all else []),
        *carry,
    )
    rows = stage(narrow, "exact")

    same_length = _repeated(rows, ["len"])
    by_length = rows.join(same_length, "len", "left_semi")
    same_prefix = _repeated(by_length, ["len", "prefix"])
    if digest_all:
        survivors = by_length.join(same_prefix, ["len", "prefix"], "left_semi")
    else:
        full = docs.select(
            F.col(doc_id).alias("doc_id"),
            F.octet_length(norm).cast("long").alias("len"),
            F.xxhash64(F.substring(norm, 1, prefix_chars)).alias("prefix"),
            F.col(text).alias("content"),
            *carry,
        )
        survivors = full.join(same_prefix, ["len", "prefix"], "left_semi").withColumn(
            "text_sha256", F.sha2(normalised(F.col("content")).cast("binary"), 256)
        )
        survivors = stage(survivors.drop("content"), "exact-survivors")
    key = ["len", "prefix", "text_sha256"]
    groups = (
        survivors.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("group_size"), F.min("doc_id").alias("keep_id"))
        .filter("group_size > 1")
    )
    if digest_all:
        every = rows.join(groups, key, "left")
    else:
        singles = rows.join(same_prefix, ["len", "prefix"], "left_anti").withColumn(
            "text_sha256", F.lit(None).cast("string")
        )
        every = survivors.join(groups, key, "left").unionByName(
            singles.withColumns({
                "group_size": F.lit(None).cast("long"), "keep_id": F.lit(None).cast(rows.schema["doc_id"].dataType),
            })
        )
    alone = F.col("group_size").isNull()
    return every.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
        *[c for c in rows.columns if c not in ("doc_id", "len", "prefix", "text_sha256")],
    )


def _repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*keys)


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", single: bool = False) -> DataFrame:
    """``docs`` without the repeated texts, all columns as they were. A dropped row is known
    by its ``doc_id`` and a digest of its whole text as it was, so that another text of the
    same id stays. Repeats of a kept row and rows with a null ``doc_id`` stay as well, unless
    ``single``: then one row of each group stays, null ids last."""
    own = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    groups = exact_groups(docs.select(doc_id, text), text, doc_id, carry=(own.alias("own"),))
    if single:
        rows = groups.filter("group_size > 1").select("doc_id", "own", F.col("text_sha256").alias("group"))
        return one_of_each(docs, rows, F.col(doc_id), own)
    dropped = groups.filter("NOT kept").select("doc_id", "own").distinct()
    return without(docs, dropped, (F.col(doc_id), own))

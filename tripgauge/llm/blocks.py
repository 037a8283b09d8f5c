"""Texts dealt to blocks, for operators that work on many texts at once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgauge.llm.common import pieces_of


def text_blocks(docs: DataFrame, block_bytes: int, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, int]:
    """``doc_id, text, block`` and the number of blocks, of about ``block_bytes`` each."""
    size = F.octet_length(F.coalesce(text, F.lit(""))) + 1
    blocks = pieces_of(docs, size, block_bytes)
    block = F.pmod(F.xxhash64(doc_id, text), F.lit(blocks)).cast("int")
    narrow = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"), block.alias("block")
    )
    return narrow, blocks


def co_located(blocks: DataFrame, n: int, most_files: int = 4096) -> DataFrame:
    """The blocks as a table in the warehouse that is bucketed by block: text moves once, and
    rounds that are joined to it by block shuffle their own rows only."""
    name, files = f"tripgauge_blocks_{uuid.uuid4().hex}", max(1, min(n, most_files))
    writer = blocks.repartition(files, "block").write.bucketBy(files, "block").sortBy("block")
    writer.format("parquet").option("compression", "zstd").saveAsTable(name)
    return blocks.sparkSession.table(name)

"""Near-duplicates by SimHash and covering locality-sensitive hashing.

A fingerprint has a bit set where more than half of the hashes of the text's word shingles
have it. For radius r every bit position gets a non-zero vector of r + 1 bits, and every
non-zero vector v of r + 1 bits makes a table whose mask keeps the positions whose vector has
an odd product with v. Up to r differing positions span at most r dimensions, so some v is
orthogonal to all of them: its mask hides every difference, and the pair collides there for
certain. Nothing within the radius is missed, at 2^(r+1) - 1 tables.

Only distinct fingerprints enter the tables. The members of a bucket are compared as 64-bit
integers, and of the links among them a spanning forest is kept, never all pairs. A
bucket above ``BLOCK`` is cut into blocks that meet two by two in cells of their own, so
that a hot one is spread over many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgauge.llm.common import stage, without
from tripgauge.llm.components import components

SHINGLE = 3
RADIUS = 3
# Members of a bucket compared in one go.
BLOCK = 2048
# Up to this many members all neighbours in a bucket are compared at once.
SMALL = 6
# Entries of the tables that one task makes, and the share of fingerprints that tells large buckets.
ENTRIES = 1_000_000
SAMPLED = 16
# Links that one task joins to a forest.
LINKS = 50_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of a text as an unsigned integer, 0 without words."""
    from xxhash import xxh64_intdigest

    # On bytes, these lower and split by ASCII letters and spaces only.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxh64_intdigest(b" ".join(words), 42)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - shingle + 1].tolist()
    hashes = [xxh64_intdigest(line[a:b], 42) for a, b in zip(starts, ends[shingle - 1:].tolist(), strict=True)]
    return majority(np.array(hashes, np.uint64))


def majority(hashes: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[i:i + (1 << 16)].astype("<u8").view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    shingle: int = SHINGLE,
    carry: Sequence[Column] = (),
) -> DataFrame:
    """``doc_id, fp`` of every row, ``fp`` as a signed 64-bit integer, and what to ``carry``."""

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return docs.select(F.col(doc_id).alias("doc_id"), simhash(F.col(text)).alias("fp"), *carry)


def covering_masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """The masks of all tables, as signed 64-bit integers. Any vectors that aren't zero cover; where
    there are more than bits, those of the upper half leave every mask enough bits."""
    n = (1 << (radius + 1)) - 1
    if n >= 2 * bits:
        raise ValueError(f"a radius of {radius} is too large for {bits} bits")
    vectors = [1 + i % n if n <= bits else n - bits + 1 + i for i in range(bits)]
    masks = (sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, n + 1))
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def bucket_cells(distinct: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``cell, fp`` of each table's buckets, in partitions sorted by both. Buckets and cells are
    known by a 64-bit hash; two that meet are compared with each other for nothing.

    Large buckets are told from a sample of the fingerprints. They decide only who compares
    where: any two members of a bucket meet in some cell."""
    masks = covering_masks(radius)
    tasks = max(1, math.ceil(distinct.count() * len(masks) / ENTRIES))
    # Dealt before the tables multiply the rows; a number given is kept.
    dealt = distinct.select("fp").repartition(tasks, "fp")
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(masks)])
    entries = dealt.select("fp", F.explode(keys).alias("k"))
    sampled = dealt.filter(F.pmod(F.xxhash64("fp", F.lit(1)), F.lit(SAMPLED)) == 0).select(F.explode(keys).alias("k"))
    large = stage(
        sampled.groupBy("k").agg((F.count(F.lit(1)) * SAMPLED).alias("n")).filter(F.col("n") > block)
        .select("k", F.ceil(F.col("n") / block).cast("int").alias("blocks")),
        "large-buckets",  # of known size, so that the many entries are not dealt out to meet a few
    )
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    paired = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.xxhash64("k", _cell(F.col("mine"), other)))
    cells = entries.join(large, "k", "left").withColumn("mine", mine).select(
        F.explode(F.when(F.col("blocks").isNull(), F.array("k")).otherwise(paired)).alias("cell"), "fp"
    )
    return cells.repartition("cell").sortWithinPartitions("cell", "fp")


def near_links(distinct: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links ``a, b`` that join all of ``fp`` in ``distinct`` which differ in ``radius`` bits or
    fewer, directly or over others they are linked to as well."""
    return cell_links(bucket_cells(distinct, radius, block), radius)


def cell_links(cells: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``a, b`` that join all whose fingerprints differ in ``radius`` bits or fewer and that
    share a cell. ``cells`` has a cell, a fingerprint and, unless that is its own, a name, in
    partitions that are sorted by them and hold whole cells."""
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rows = batch.to_numpy(np.int64)
            if not len(rows):
                continue
            if rest is not None:
                rows = np.concatenate([rest, rows])
            # The last group may go on in the next batch.
            new = np.flatnonzero(rows[1:, 0] != rows[:-1, 0]) + 1
            cut = int(new[-1]) if len(new) else 0
            rest = rows[cut:]
            if cut:
                yield _links(rows[:cut], radius)
        if rest is not None:
            yield _links(rest, radius)

    found = stage(cells.mapInPandas(compare, "a long, b long").distinct(), "near-links")
    # Members of a large group meet in many tables; of their links each task keeps a forest.
    tasks = max(1, math.ceil(found.count() / LINKS))
    return found.repartition(tasks).mapInPandas(_spanning, "a long, b long")


def _spanning(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of each node to the smallest of those that the given links join it with."""
    above: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := above.setdefault(x, x)) != x:
            above[x] = above[up]
            x = above[x]
        return x

    for batch in batches:
        for a, b in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
            a, b = root(a), root(b)
            above[max(a, b)] = min(a, b)
    pairs = [(root(x), x) for x in list(above)]
    yield pd.DataFrame([p for p in pairs if p[0] != p[1]], columns=["a", "b"], dtype="int64")


def _cell(one: Column, other: Column) -> Column:
    """A number of the unordered pair of blocks."""
    low, high = F.least(one, other).cast("long"), F.greatest(one, other).cast("long")
    return F.shiftleft(high, 31).bitwiseOR(low)


def _links(rows: np.ndarray, radius: int) -> pd.DataFrame:
    """Links of names in rows of (cell, fingerprint, name) that are sorted by cell; without a name
    the fingerprint is one."""
    name = np.ascontiguousarray(rows[:, -1])
    bits = np.ascontiguousarray(rows[:, 1]).view(np.uint64)
    new = rows[1:, 0] != rows[:-1, 0]
    starts = np.concatenate([[0], np.flatnonzero(new) + 1, [len(rows)]])
    sizes = np.diff(starts)
    group = np.repeat(np.arange(len(sizes)), sizes)
    few = sizes <= SMALL
    small = np.flatnonzero(few[group])
    found = []
    g, x, y = group[small], bits[small], name[small]
    for step in range(1, min(SMALL, len(small))):
        near = (g[step:] == g[:-step]) & (np.bitwise_count(x[step:] ^ x[:-step]) <= radius) & (y[step:] != y[:-step])
        if near.any():
            found.append(np.column_stack([y[:-step][near], y[step:][near]]))
    for i in np.flatnonzero(~few):
        names, first = np.unique(name[starts[i]:starts[i + 1]].view(np.uint64), return_index=True)
        found.append(_forest(bits[starts[i]:starts[i + 1]][first], radius, names).view(np.int64))
    links = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    return pd.DataFrame({"a": links[:, 0], "b": links[:, 1]})


def _forest(bits: np.ndarray, radius: int, names: np.ndarray) -> np.ndarray:
    """Each of the distinct, sorted names that are linked, however far, with the smallest of
    them: buckets of many tables then give the same links. Each one reached is compared with those
    not reached yet, once."""
    links, left, rest = [], bits, names
    while len(left):
        first, queue = rest[0], [left[0]]
        left, rest = left[1:], rest[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(left ^ at) <= radius
            if near.any():
                reached = rest[near]
                links.append(np.column_stack([np.full(len(reached), first, np.uint64), reached]))
                queue.extend(left[near])
                left, rest = left[~near], rest[~near]
    return np.concatenate(links) if links else np.zeros((0, 2), np.uint64)


def simhash_classes(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    carry: Sequence[Column] = (),
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fp`` and ``component_id``, the smallest
    ``doc_id`` of all documents it is linked to, however far.

    Null and empty texts have fingerprint zero and link like any other. Rows without a
    ``doc_id`` take part in links and get a class, but give none its name; a class of
    such rows alone has a null one. Repeated rows are repeated in the result, of further
    columns only those of ``carry`` come along, and no rows give no rows."""
    prints = stage(fingerprints(docs, text, doc_id, shingle, carry), "fingerprints")
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = components(near_links(distinct.select("fp"), radius))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.join(named, "root").select("fp", "component_id")
    carried = [c for c in prints.columns if c not in ("doc_id", "fp")]
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id", *carried)


def simhash_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each class, that of the smallest ``doc_id``, all columns as
    they were. A dropped row is known by its ``doc_id`` and a hash of its text, so that
    another text of the same id stays. Rows with a null ``doc_id`` can't be told apart
    and stay."""
    own = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    classes = simhash_classes(docs.select(doc_id, text), text, doc_id, carry=(own.alias("own_hash"),))
    dropped = classes.filter("doc_id <> component_id").select("doc_id", "own_hash").distinct()
    return without(docs, dropped, (F.col(doc_id), own))

"""Exact top-k search by inner product in KD-trees.

Vectors are dealt to shards, and each shard builds one KD-tree: splits at the median of the
widest dimension, a tight bounding box around every leaf. What a box can score at best follows
from its corners. A search opens boxes best first and ends when the best one left is
below the k-th score known; a box that equals it is still opened, as ties go to smaller ids.
Queries search side by side: each takes its next best leaf, and a leaf is scored for all queries that
want it in one matrix product.

Two passes propagate the k-th score. In the first each query searches one shard. In the
second it takes the bound found there to all others. Queries travel to the shards and
stream past the tree in batches, so that a task holds one tree and one batch. The k best of
a query per shard are ranked at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripgauge.llm.common import stage

SHARD_ROWS = 16_384
LEAF_ROWS = 256
NO_BOUND = -(2**63)


class KDTree:
    """Median splits over ``vectors``; ``ids`` break ties. Integers up to a product sum of
    2^53 are exact in the floating point used; above that Python integers are."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.ids, self.vectors = ids, vectors
        self.leaves: list[np.ndarray] = []
        # How many leaves were scored for how many queries, and how many there were to score.
        self.opened = self.offered = 0
        if len(ids):
            self._split(np.arange(len(ids)), leaf_rows)
            self.low = np.array([vectors[rows].min(axis=0) for rows in self.leaves])
            self.high = np.array([vectors[rows].max(axis=0) for rows in self.leaves])

    def _split(self, rows: np.ndarray, leaf_rows: int) -> None:
        part = self.vectors[rows]
        spread = part.max(axis=0) - part.min(axis=0)
        widest = int(np.argmax(spread))
        if len(rows) <= leaf_rows or spread[widest] == 0:
            self.leaves.append(rows)
            return
        half = len(rows) // 2
        order = np.argpartition(part[:, widest], half)
        self._split(rows[order[:half]], leaf_rows)
        self._split(rows[order[half:]], leaf_rows)

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, bounds: np.ndarray) -> tuple:
        """Of the k best rows other than ``own`` that score at least its bound, for all queries: the
        number of the query, the score and the id."""
        none, n = -np.inf, len(queries)
        scores = np.full((n, k), none, queries.dtype)
        ids = np.zeros((n, k), np.int64)
        kth = bounds.astype(queries.dtype)
        if len(self.leaves) and n:
            # The best a box can give: each component at the corner that suits its sign. No box within
            # it can give more, so that leaves in this order are opened best first.
            best = np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T
            order = np.argsort(-best, axis=1, kind="stable")
            self.offered += best.size
            active = np.arange(n)
            for step in range(len(self.leaves)):
                leaf = order[active, step]
                wanted = (best[active, leaf] >= kth[active]).astype(bool)
                active, leaf = active[wanted], leaf[wanted]
                if not len(active):
                    break
                self.opened += len(active)
                for one in np.unique(leaf):
                    self._open(self.leaves[one], active[leaf == one], queries, own, k, scores, ids, kth)
        at, place = np.nonzero((scores > none) & (scores >= bounds[:, None]))
        return at, scores[at, place], ids[at, place]

    def _open(self, rows, asking, queries, own, k, scores, ids, kth) -> None:
        found = queries[asking] @ self.vectors[rows].T
        found[self.ids[rows][None, :] == own[asking][:, None]] = -np.inf
        better = (found >= kth[asking][:, None]).any(axis=1)
        asking, found = asking[better], found[better]
        if not len(asking):
            return
        found = np.concatenate([scores[asking], found], axis=1)
        named = np.concatenate([ids[asking], np.broadcast_to(self.ids[rows], (len(asking), len(rows)))], axis=1)
        first = np.lexsort((named, -found), axis=1)[:, :k]
        scores[asking] = np.take_along_axis(found, first, axis=1)
        ids[asking] = np.take_along_axis(named, first, axis=1)
        kth[asking] = np.maximum(kth[asking], scores[asking, -1])


def quantised(vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", scale: int = 64) -> DataFrame:
    """``vec_id, v``: floor(scale * x) of each component as long. Vectors that are null, or hold
    a null, NaN or infinite component, are left out; so are rows without an id."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return vectors.filter(F.col(vec_id).isNotNull() & x.isNotNull() & finite).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.floor(c * F.lit(float(scale)))).alias("v"),
    )


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 20, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's k best candidates other than itself,
    all of them where there are fewer. Both inputs: ``vec_id, v`` of integers. Shorter
    vectors count as if filled up with zeros; the empty one scores 0 with all. Rows that
    repeat an id are candidates each. Ties go to the smaller id."""
    shards = max(1, -(-candidates.count() // shard_rows))

    def dealt(salt: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(shards)).cast("int")

    data = candidates.select(
        dealt(1).alias("shard"), F.lit(0).alias("side"), "vec_id", "v", F.lit(NO_BOUND).alias("bound")
    )
    asked = queries.select(dealt(2).alias("home"), "vec_id", "v")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Sorted by shard, its vectors ahead of its queries."""
        shard, parts, tree = None, [], None
        for batch in batches:
            for (at, side), rows in batch.groupby(["shard", "side"], sort=True):
                if at != shard:
                    shard, parts, tree = at, [], None
                if side == 0:
                    parts.append(rows[["vec_id", "v"]])
                elif parts or tree:
                    if tree is None:
                        every = pd.concat(parts, ignore_index=True)
                        parts, tree = [], (every["vec_id"].to_numpy(np.int64), _matrix(every["v"]), {})
                    yield answers(rows, *tree)

    def answers(rows: pd.DataFrame, ids: np.ndarray, vectors: np.ndarray, trees: dict) -> pd.DataFrame:
        asking = _matrix(rows["v"])
        width = max(vectors.shape[1], asking.shape[1])
        top = [float(np.abs(x).max(initial=0)) for x in (vectors, asking)]
        kind = np.float64 if top[0] * top[1] * width < 2**53 and max(top) < 2**53 else object
        # One tree serves all batches, unless they differ in width or need larger numbers.
        if (width, kind) not in trees:
            trees[width, kind] = KDTree(ids, _wide(vectors, width).astype(kind))
        own = rows["vec_id"].to_numpy(np.int64)
        at, scores, found = trees[width, kind].search(_wide(asking, width).astype(kind), own, k, rows["bound"].to_numpy())
        return pd.DataFrame({"query_id": own[at], "vec_id": found, "score": scores.astype(np.int64)})

    def meet(wanted: DataFrame) -> DataFrame:
        """Queries against the shards that ``wanted`` sends them to."""
        rows = data.unionByName(wanted.select("shard", F.lit(1).alias("side"), "vec_id", "v", "bound"))
        sorted_ = rows.repartition(shards, "shard").sortWithinPartitions("shard", "side")
        return sorted_.mapInPandas(search, "query_id long, vec_id long, score long")

    first = stage(meet(asked.withColumn("shard", F.col("home")).withColumn("bound", F.lit(NO_BOUND))), "topk-first")
    found = first
    if shards > 1:
        bounds = first.groupBy("query_id").agg(
            F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(F.lit(NO_BOUND)).alias("bound")
        )
        others = (
            asked.join(bounds, F.col("vec_id") == F.col("query_id"), "left")
            .withColumn("bound", F.coalesce("bound", F.lit(NO_BOUND)))
            .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
            .filter("shard <> home")
        )
        found = first.unionByName(meet(others))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def _matrix(vectors: pd.Series) -> np.ndarray:
    """One row a vector, filled up with zeros to the longest, of one column at least."""
    lengths = vectors.map(len).to_numpy()
    width = max(1, int(lengths.max(initial=0)))
    if len(lengths) and (lengths == width).all():
        return np.stack(vectors.to_list()).astype(np.int64)
    out = np.zeros((len(vectors), width), np.int64)
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


def _wide(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))

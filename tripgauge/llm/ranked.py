"""Ranked lexical search by MaxScore with pair bounds.

Documents are dealt to shards as they are read; nothing but a shard's postings of the wanted
terms goes further. The index of a shard holds a list per term, with the largest impact in it,
and for neighbouring terms of a query, in order of frequency, the list of documents that hold both
with the largest sum of impacts any of them has. A document gets from two such terms at most the
larger of that sum and either's own maximum, which is less than both maxima together.

A query pairs its terms where that saves most. Terms and pairs whose bounds together stay below the
score to beat open no document; pairs that fit only when their common documents are looked at add
those; the rest are read in full. What is open is then scored from the largest bound down, and
dropped once its score with all that may still come is too low. The score to beat starts from the
best documents of a few shards. Bounds decide what is skipped, never a result: ties are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tripgauge.llm.common import stage

K = 50
# Bounds of a shard: what one task holds at a time. Places in a shard are 16-bit numbers.
SHARD_DOCS = 8192
SHARD_POSTINGS = 1_000_000
# Queries worked on at once; their words are known to every task.
QUERIES_AT_ONCE = 1000
# Shards that set the first score to beat.
FIRST_SHARDS = 4
# Lower-case letters and digits stay, A to Z are lowered, other ASCII parts terms; all else stays.
_FOLD = bytes(
    b if b >= 128 or chr(b).isalnum() and not chr(b).isupper() else b + 32 if chr(b).isupper() else 32
    for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


def search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = K,
    text: str = "text",
    doc_id: str = "doc_id",
    query_id: str = "item_id",
    query_text: str = "text",
) -> DataFrame:
    """``query_id, rank, doc_id, score`` of each query's ``k`` best documents of a score above 0.

    Every row of ``queries`` is a query of its own, every row of ``docs`` a document, repeated
    or not. Equal scores rank by ``doc_id``, null last. Texts that are null or without a term
    are no documents and find nothing. No rows on either side give no rows, and other columns
    of both take no part. ``queries`` is gone through ``QUERIES_AT_ONCE`` rows at a time, each time
    over all of ``docs``."""
    id_type = docs.schema[doc_id].dataType
    result = T.StructType([
        T.StructField("item_id", queries.schema[query_id].dataType), T.StructField("rank", T.IntegerType()),
        T.StructField("doc_id", id_type), T.StructField("score", T.LongType()),
    ])
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    wanted = queries.select(F.col(f"`{query_id}`").alias("item_id"), F.col(f"`{query_text}`").alias("text"))
    rows, found = wanted.toLocalIterator(), None
    while block := list(islice(rows, QUERIES_AT_ONCE)):
        part = _search_block(narrow, [(r["item_id"], sorted(set(terms_of(r["text"])))) for r in block], k, result)
        found = part if found is None else found.unionByName(part)
    return narrow.sparkSession.createDataFrame([], result) if found is None else found


def _search_block(docs: DataFrame, queries: list[tuple[object, list[bytes]]], k: int, result: T.StructType) -> DataFrame:
    names = sorted({t for _, terms in queries for t in terms})
    number = {t: i for i, t in enumerate(names)}
    postings = stage(_postings(docs, number), "postings")
    counts = {r["term"]: r for r in postings.groupBy("term").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_terms").alias("n_terms")).collect()}
    all_docs, all_terms = (counts[-1]["n_docs"], counts[-1]["n_terms"]) if -1 in counts else (0, 0)
    weights = {
        t: w for t, r in counts.items()
        if t >= 0 and (w := math.floor(1000 * math.log((2 * all_docs + 2) / (2 * r["n_docs"] + 1)))) > 0
    }
    # Terms from the most frequent down, known ones only.
    asked = [
        sorted((number[t] for t in terms if number[t] in weights), key=lambda t: (weights[t], t)) for _, terms in queries
    ]
    pairs = sorted({(min(p), max(p)) for terms in asked for p in zip(terms, terms[1:], strict=False)})
    index = stage(_index(postings, weights, pairs, all_docs, all_terms), "term-index")
    first = [r["shard"] for r in index.filter("a = -1").select("shard").orderBy("shard").limit(FIRST_SHARDS).collect()]
    floors = [1] * len(asked)
    if first:
        best = _hits(index.filter(F.col("shard").isin(first)), asked, weights, floors, k)
        rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))
        for r in best.withColumn("rank", rank).filter(F.col("rank") == k).select("q", "score").collect():
            floors[r["q"]] = max(1, r["score"])
    hits = _hits(index, asked, weights, floors, k)
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    ids = docs.sparkSession.createDataFrame(
        [(q, i) for q, (i, _) in enumerate(queries)],
        T.StructType([T.StructField("q", T.IntegerType()), T.StructField("item_id", result["item_id"].dataType)]),
    )
    # The queries of a block at most on the right side.
    return (
        hits.withColumn("rank", rank).filter(F.col("rank") <= k).join(F.broadcast(ids), "q")
        .select(*result.fieldNames())
    )


def _postings(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """A row per shard and wanted term: places and counts; and one per shard (``term`` -1)
    with the ids and lengths of its documents, in order of their ids."""
    schema = T.StructType([
        T.StructField("shard", T.LongType()), T.StructField("term", T.IntegerType()),
        T.StructField("n_docs", T.LongType()), T.StructField("n_terms", T.LongType()),
        T.StructField("docs", T.BinaryType()), T.StructField("counts", T.BinaryType()),
        T.StructField("ids", T.ArrayType(docs.schema["doc_id"].dataType)),
    ])
    kind = to_arrow_schema(schema)

    def shard_rows(shard: int, ids: list, sizes: list, found: list[np.ndarray]) -> pa.RecordBatch:
        id_type = kind.field("ids").type.value_type
        order = pc.sort_indices(pa.array(ids, id_type), null_placement="at_end").to_numpy()
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        held = np.fromiter((len(f) for f in found), np.int64, len(found))
        # Term and place in one number, so that equal ones are counted by one sort.
        keys = np.concatenate(found).astype(np.int64) << 16 | np.repeat(place, held)
        keys, counts = np.unique(keys, return_counts=True)
        terms, starts = np.unique(keys >> 16, return_index=True)
        ends = np.append(starts, len(keys))[1:]
        at, counts = (keys & 0xFFFF).astype("<u2"), counts.astype("<u4")
        spans = list(zip(starts.tolist(), ends.tolist(), strict=True))
        lengths = np.array(sizes, np.int64)[order]
        n = len(spans) + 1
        return pa.RecordBatch.from_pydict({
            "shard": [shard] * n,
            "term": [-1, *terms.tolist()],
            "n_docs": [len(ids), *(b - a for a, b in spans)],
            "n_terms": [int(lengths.sum()), *[0] * (n - 1)],
            "docs": [None, *(at[a:b].tobytes() for a, b in spans)],
            "counts": [lengths.astype("<u4").tobytes(), *(counts[a:b].tobytes() for a, b in spans)],
            "ids": [[ids[i] for i in order.tolist()], *[None] * (n - 1)],
        }, schema=kind)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        ids, sizes, found, held = [], [], [], 0
        get = number.get
        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                words = terms_of(text.as_py())
                if not words:
                    continue
                known = np.array([t for t in map(get, words) if t is not None], np.int32)
                ids.append(i)
                sizes.append(len(words))
                found.append(known)
                held += len(known)
                if len(ids) >= SHARD_DOCS or held >= SHARD_POSTINGS:
                    yield shard_rows(shard, ids, sizes, found)
                    shard, ids, sizes, found, held = shard + 1, [], [], [], 0
        if ids:
            yield shard_rows(shard, ids, sizes, found)

    return docs.mapInArrow(deal, schema)


def _index(postings: DataFrame, weights: dict[int, int], pairs: list[tuple[int, int]], all_docs: int, all_terms: int) -> DataFrame:
    """A row per shard and term ``a`` (``b`` -1) with its largest impact, documents and the part
    of their impacts that the weight multiplies; one per shard and pair with the largest joint
    impact and the common documents; and the shard's ids (``a`` -1)."""
    schema = T.StructType([
        T.StructField("shard", T.LongType()), T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()),
        T.StructField("top", T.LongType()), T.StructField("docs", T.BinaryType()), T.StructField("parts", T.BinaryType()),
        T.StructField("ids", postings.schema["ids"].dataType),
    ])
    kind = to_arrow_schema(schema)

    def build(table: pa.Table) -> pa.Table:
        term = table.column("term").to_numpy()
        counts = table.column("counts")
        main = int(np.flatnonzero(term == -1)[0])
        lengths = np.frombuffer(counts[main].as_py(), "<u4").astype(np.int64)
        lows = 20 * (50 + 50 * lengths * all_docs // all_terms)
        lists, places = {}, table.column("docs")
        for i in np.flatnonzero(term >= 0).tolist():
            if (t := int(term[i])) in weights:
                docs = np.frombuffer(places[i].as_py(), "<u2")
                tf = np.frombuffer(counts[i].as_py(), "<u4").astype(np.int64)
                lists[t] = docs, 1_000_000_000 * tf // (1000 * tf + lows[docs])
        rows = [(-1, -1, 0, None, None, table.column("ids")[main].as_py())]
        for t, (docs, parts) in lists.items():
            rows.append((t, -1, weights[t] * int(parts.max()), docs.tobytes(), parts.astype("<u4").tobytes(), None))
        for a, b in pairs:
            if a in lists and b in lists:
                common, i, j = _common(lists[a][0], lists[b][0])
                if len(common):
                    top = int((weights[a] * lists[a][1][i] + weights[b] * lists[b][1][j]).max())
                    rows.append((a, b, top, common.tobytes(), None, None))
        shard = table.column("shard")[0].as_py()
        return pa.Table.from_pydict(
            {"shard": [shard] * len(rows)} | {n: [r[c] for r in rows] for c, n in enumerate(kind.names[1:])}, schema=kind
        )

    return postings.groupBy("shard").applyInArrow(build, schema)


def _common(one: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of two sorted arrays that are in both, and where in each."""
    if len(one) > len(other):
        common, j, i = _common(other, one)
        return common, i, j
    at = np.searchsorted(other, one)
    at[at == len(other)] = 0
    i = np.flatnonzero(other[at] == one)
    return one[i], i, at[i]


def _hits(index: DataFrame, asked: list[list[int]], weights: dict[int, int], floors: list[int], k: int) -> DataFrame:
    """``q, doc_id, score`` of the ``k`` best of each shard that reach the score to beat."""
    schema = T.StructType([
        T.StructField("q", T.IntegerType()), T.StructField("doc_id", index.schema["ids"].dataType.elementType),
        T.StructField("score", T.LongType()),
    ])
    kind = to_arrow_schema(schema)

    def shard_hits(table: pa.Table) -> pa.Table:
        shard = Shard(weights)
        a, b, tops = (table.column(c).to_numpy() for c in ("a", "b", "top"))
        for i in range(len(a)):
            if a[i] < 0:
                ids = table.column("ids")[i].as_py()
            elif b[i] < 0:
                docs = np.frombuffer(table.column("docs")[i].as_py(), "<u2")
                parts = np.frombuffer(table.column("parts")[i].as_py(), "<u4").astype(np.int64)
                shard.lists[int(a[i])] = docs, parts * weights[int(a[i])], int(tops[i])
            else:
                shard.pairs[int(a[i]), int(b[i])] = np.frombuffer(table.column("docs")[i].as_py(), "<u2"), int(tops[i])
        shard.size = len(ids)
        found = [(q, doc, score) for q, terms in enumerate(asked) for doc, score in shard.best(terms, k, floors[q])]
        return pa.Table.from_pydict({
            "q": [q for q, _, _ in found], "doc_id": [ids[d] for _, d, _ in found], "score": [s for _, _, s in found],
        }, schema=kind)

    return index.groupBy("shard").applyInArrow(shard_hits, schema)


class Shard:
    """Lists of one shard: ``lists`` has documents, impacts and the largest of them by term, ``pairs``
    the common documents and the largest joint impact. ``opened`` counts the documents scored."""

    def __init__(self, weights: dict[int, int]):
        self.weights, self.lists, self.pairs, self.size, self.opened = weights, {}, {}, 0, 0

    def units(self, terms: list[int], end: int, listed: bool = False, paired: bool = True) -> list[tuple[int, tuple[int, ...]]]:
        """How to pair the first ``end`` of ``terms`` so that the sum of bounds is least: bound and
        terms of each pair or single one. ``listed`` bounds what pairs add to documents outside
        their lists. Pairs are neighbours, so the best pairing of one more term is that of the terms before
        with the term on its own, or of those before its neighbour with the two as a pair."""
        sums, last = [0], [()]
        for i, t in enumerate(terms[:end]):
            top = self.lists[t][2] if t in self.lists else 0
            sums.append(sums[-1] + top)
            last.append((top, (t,)) if top else ())
            if paired and top and i and (prior := terms[i - 1]) in self.lists:
                joint = 0 if listed else self.pairs.get((min(prior, t), max(prior, t)), (None, 0))[1]
                most = max(joint, top, self.lists[prior][2])
                if sums[i - 1] + most < sums[-1]:
                    sums[-1], last[-1] = sums[i - 1] + most, (most, (prior, t))
        units, i = [], len(sums) - 1
        while i > 0:
            if last[i]:
                units.append(last[i])
            i -= len(last[i][1]) if last[i] else 1
        self.sums = sums
        return units[::-1]

    def best(self, terms: list[int], k: int, floor: int, paired: bool = True) -> list[tuple[int, int]]:
        """The ``k`` best documents and scores of ``floor`` or more, ties to the first. ``terms``
        are those of a query from the most frequent down."""
        self.units(terms, len(terms), paired=paired)
        if self.sums[-1] < floor:
            return []
        cut = max(i for i, total in enumerate(self.sums) if total < floor)
        looked_up, lists = self.units(terms, cut, paired=paired), []
        if paired:
            self.units(terms, len(terms), listed=True)
            further = max(i for i, total in enumerate(self.sums) if total < floor)
            units, lists = self._with_lists(terms, further, floor)
            if sum(map(len, lists)) < sum(len(self.lists[t][0]) for t in terms[cut:further] if t in self.lists):
                cut, looked_up = further, units
            else:
                lists = []
        score, open_ = np.zeros(self.size, np.int64), np.zeros(self.size, bool)
        for t in terms[cut:]:
            if t in self.lists:
                docs, impacts, _ = self.lists[t]
                score[docs] += impacts
                open_[docs] = True
        for docs in lists:
            open_[docs] = True
        at = np.flatnonzero(open_)
        self.opened += len(at)
        part, rest = score[at], sum(bound for bound, _ in looked_up)
        for bound, unit in reversed(looked_up):
            at, part, floor = _reaching(at, part, rest, floor, k)
            for t in unit:
                docs, impacts, _ = self.lists[t]
                place = np.searchsorted(docs, at)
                place[place == len(docs)] = 0
                part = part + np.where(docs[place] == at, impacts[place], 0)
            rest -= bound
        at, part, floor = _reaching(at, part, 0, floor, k)
        order = np.lexsort((at, -part))[:k]
        return list(zip(at[order].tolist(), part[order].tolist(), strict=True))

    def _with_lists(self, terms: list[int], end: int, floor: int) -> tuple[list, list[np.ndarray]]:
        """Units of the first ``end`` terms, and the common documents that must be opened for the
        others to stay below ``floor``: those of the pairs that come to most together first."""
        units, total, gains = [], 0, []
        for bound, unit in self.units(terms, end, listed=True):
            docs, joint = self.pairs.get((min(unit), max(unit)), (None, 0)) if len(unit) == 2 else (None, 0)
            units.append((max(bound, joint), unit))
            total += max(bound, joint)
            if joint > bound:
                gains.append((joint - bound, len(units), docs))
        lists = []
        for gain, _, docs in sorted(gains, key=lambda g: g[:2], reverse=True):
            if total < floor:
                break
            total -= gain
            lists.append(docs)
        return units, lists


def _reaching(at: np.ndarray, part: np.ndarray, rest: int, floor: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents that may still reach the ``k`` best, and the score they have to beat."""
    if len(part) > k:
        floor = max(floor, int(np.partition(part, len(part) - k)[len(part) - k]))
    ok = part + rest >= floor
    return at[ok], part[ok], floor

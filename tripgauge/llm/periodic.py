"""Runs of words that repeat with a period, by minimizers at several scales.

A run is a stretch of words that equals itself shifted by its smallest period, at least
``TIMES`` periods long, which no neighbouring word extends. At the scale of length L the periods from L to 2L are
looked for. Grams of 2L words differ within one period, so of the L grams that start in a
window one has the smallest hash; a window one period later has it again. Sampled grams (those
that are the smallest of some window) with an equal gram L to 2L words on seed a run, which is
then extended word by word both ways. At ``TIMES`` periods or more every run holds two such windows, so
none is missed. Periods below ``SHORT`` are found by comparing all words with those so many
words on. Words are compared as numbers that stand for them exactly; only seeds rest on
64-bit hashes.

Documents are worked on side by side in arrays, some ``AT_ONCE`` bytes of text at a time.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

TIMES = 4
LEAST_WORDS = 6
# Periods below are scanned for directly; a power of two.
SHORT = 16
AT_ONCE = 2_000_000


def find_runs(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rows of document, start, length and period, in that order of sorting. ``words`` has a number
    per word, all documents one after another; ``ends`` is where each ends."""
    starts = np.concatenate([[0], ends[:-1]])
    sizes = ends - starts
    # No word equals one of another document.
    own = words * len(ends) + np.repeat(np.arange(len(ends)), sizes)
    found = [_scan(own, p) for p in range(1, min(SHORT, int(sizes.max(initial=0)) // TIMES + 1))]
    found = [np.concatenate([f for f in found if len(f)] or [np.zeros((0, 3), np.int64)])]
    scale, places, left = SHORT, np.arange(len(own)), sizes
    grams, width = None, 1
    while TIMES * scale <= left.max(initial=0):
        enough = left >= TIMES * scale
        if not enough.all():
            keep = np.repeat(enough, left)
            own, places, left = own[keep], places[keep], left[enough]
            grams = None if grams is None else grams[keep]
        grams = _mixed(own.astype(np.uint64)) if grams is None else grams
        while width < 2 * scale:
            grams = _mixed(grams * np.uint64(0x9E3779B97F4A7C15) + np.concatenate([grams[width:], grams[:1].repeat(width)]))
            width *= 2
        runs = _extended(own, *_seeds(grams, scale))
        runs[:, 0] = places[runs[:, 0]]
        found.append(runs)
        scale *= 2
    runs = np.concatenate(found)
    # A stretch with a period has its multiples as well: the smallest counts.
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[first]
    doc = np.searchsorted(ends, runs[:, 0], side="right")
    runs = np.column_stack([doc, runs[:, 0] - starts[doc], runs[:, 1:]])
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def _long_enough(start: np.ndarray, equal: np.ndarray, period: int) -> np.ndarray:
    """Start, length and period of stretches of ``equal`` words that equal those a period on."""
    length = equal + period
    ok = length >= max(LEAST_WORDS, TIMES * period)
    return np.column_stack([start[ok], length[ok], np.full(int(ok.sum()), period)])


def _scan(own: np.ndarray, period: int) -> np.ndarray:
    at = np.flatnonzero(own[:-period] == own[period:])
    if not len(at):
        return np.zeros((0, 3), np.int64)
    new = np.flatnonzero(np.diff(at) != 1) + 1
    edges = np.concatenate([[0], new, [len(at)]])
    return _long_enough(at[edges[:-1]], np.diff(edges), period)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _over_window(x: np.ndarray, size: int, least) -> np.ndarray:
    """``least`` of each window of ``size``, a power of two."""
    step = 1
    while step < size:
        x = least(x[:-step], x[step:])
        step *= 2
    return x


def _seeds(grams: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of sampled grams and how far on the next equal one is, from ``scale`` to twice it."""
    lowest = _over_window(grams, scale, np.minimum)
    pad = np.zeros(scale - 1, np.uint64)
    # A gram is sampled if one of the windows that hold it has it as the lowest.
    at = np.flatnonzero(_over_window(np.concatenate([pad, lowest, pad]), scale, np.maximum) == grams)
    at = at[np.argsort(grams[at], kind="stable")]
    step = np.diff(at)
    ok = (grams[at[1:]] == grams[at[:-1]]) & (step >= scale) & (step < 2 * scale)
    return at[:-1][ok], step[ok]


def _extended(own: np.ndarray, at: np.ndarray, period: np.ndarray) -> np.ndarray:
    found = []
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    edges = np.flatnonzero(np.concatenate([[True], np.diff(period) != 0, [True]])) if len(at) else []
    for i, j in zip(edges[:-1], edges[1:], strict=True):
        p = int(period[i])
        ahead, behind = own[p:], own[:-p]
        while i < j:
            seed = int(at[i])
            if behind[seed] != ahead[seed]:  # two grams met in their hash
                i += 1
                continue
            right = seed + _equal(behind[seed:], ahead[seed:])
            left = seed - _equal(behind[:seed][::-1], ahead[:seed][::-1])
            found.append((left, right - left + p, p))
            i += int(np.searchsorted(at[i:j], right))
    runs = np.array(found, np.int64).reshape(-1, 3)
    return runs[runs[:, 1] >= TIMES * runs[:, 2]]


def _equal(one: np.ndarray, other: np.ndarray) -> int:
    """How many first values agree, looked at in pieces that grow."""
    done, step = 0, 64
    while done < len(one):
        differ = one[done:done + step] != other[done:done + step]
        if differ.any():
            return done + int(differ.argmax())
        done, step = done + step, 2 * step
    return len(one)


def _runs_of(texts: list[str | None]) -> tuple[list[list[tuple[int, int, int]]], list[bytes]]:
    """The runs of each text, and its words without those a run repeats."""
    # On bytes, these split by ASCII spaces only.
    split = [(t or "").encode().split() for t in texts]
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    words = np.fromiter((numbers[w] for part in split for w in part), np.int64, int(sizes.sum()))
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    kept = {}
    for doc, *run in find_runs(words, np.cumsum(sizes)).tolist():
        runs[doc].append(tuple(run))
        mask = kept.setdefault(doc, np.ones(int(sizes[doc]), bool))
        mask[run[0] + run[2]:run[0] + run[1]] = False
    return runs, [b" ".join(compress(w, kept[i].tolist()) if i in kept else w) for i, w in enumerate(split)]


def periodic_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, runs, collapsed`` of each row: the runs as ``array<struct<start, length,
    period>>`` in words from 0, by start, then period, and the text's words joined by one space without
    those that a run repeats (all but its first period). Null and empty texts have no runs and
    collapse to ''. Repeated rows and rows without an id are rows like any other; no
    rows give no rows, and other columns don't come along."""
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    run_type = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    schema = narrow.select("doc_id").schema.add("runs", T.ArrayType(run_type)).add("collapsed", T.StringType())
    kind = to_arrow_schema(schema)

    def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        size, at = 0, 0
        for i, n in enumerate(batch.column("text")):
            size += 0 if not n.is_valid else len(n.as_buffer())
            if size >= AT_ONCE:
                yield batch.slice(at, i + 1 - at)
                size, at = 0, i + 1
        yield batch.slice(at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                runs, collapsed = _runs_of(piece.column("text").to_pylist())
                ends = np.cumsum([0, *map(len, runs)]).astype(np.int32)
                flat = np.array([r for of in runs for r in of], np.int64).reshape(-1, 3)
                item = kind.field("runs").type.value_type
                fields = pa.StructArray.from_arrays(
                    [pa.array(flat[:, c]) for c in range(3)], fields=[item.field(c) for c in range(3)]
                )
                lists = pa.ListArray.from_arrays(pa.array(ends), fields).cast(kind.field("runs").type)
                texts = pa.array(collapsed, pa.binary()).cast(kind.field("collapsed").type)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), lists, texts], schema=kind)

    return narrow.mapInArrow(run, schema)

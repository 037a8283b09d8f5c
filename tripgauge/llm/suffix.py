"""Removing byte strings that repeat anywhere in a corpus.

A byte goes when a string of ``length`` bytes that covers it also starts at another place. As
in prefix doubling, places are ranked by ever longer strings, and a place whose rank is
unique is out of all later rounds:

1. Anchors. Of the short grams in a window of ``length`` bytes the one with the least hash, the
   leftmost of equals, is the window's anchor. Equal windows have equal anchors, so a
   window whose anchor's gram occurs once is unique.
2. Stretches. The windows of one anchor lie side by side; the bytes they cover together are
   ranked as one string. Where that occurs again, each of its windows does.
3. Windows. What is left stands at the edges of repeated passages. These windows are ranked
   themselves, against each other and against one copy of every stretch that shares
   their anchor with another.

Each round counts keys over all blocks of text (``keycount``): a frequent key comes once from
each block, and of a group of copies one copy goes on. Sorting every position in each
round of plain doubling would shuffle tens of times the input; this shuffles less than it.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tripgauge.llm.blocks import co_located, text_blocks
from tripgauge.llm.common import stage
from tripgauge.llm.keycount import REQUEST, KeySpace, count_keys, mixed, replies_of, requests_table

LENGTH = 200
GRAM = 32
BLOCK_BYTES = 3 << 20
ANCHOR, STRETCH, WINDOW = 1, 2, 3
KEY_BYTES = 8
# Numbers that go with every byte are worked out for so many bytes at a time.
PIECE = 1 << 17

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


# Powers are kept as products of two short tables.
SHORT = 1 << 12
_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _power_tables(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of the base and of its inverse modulo 2^64, below ``SHORT`` and of its multiples up to
    ``n``, kept for the next block."""
    if not _powers or len(_powers[0][1]) <= n // SHORT:
        tables = []
        for base in (_BASE, _INVERSE):
            pair = []
            for step, count in ((base, SHORT), (pow(base, SHORT, 1 << 64), n // SHORT + 1)):
                t = np.full(count, step, np.uint64)
                t[0] = 1
                pair.append(np.multiply.accumulate(t))
            tables.append(tuple(pair))
        _powers[:] = tables
    return _powers


def _power(tables: tuple[np.ndarray, np.ndarray], at: np.ndarray) -> np.ndarray:
    low, high = tables
    return low[at & (SHORT - 1)] * high[at >> SHORT.bit_length() - 1]


class BlockBytes:
    """The bytes of a block's texts in a row, and the hash of any stretch of them."""

    def __init__(self, texts: pa.ChunkedArray, length: int, gram: int):
        texts = texts.combine_chunks().cast(pa.large_binary())
        texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
        ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.data = raw[ends[0]:ends[-1]]
        self.bounds = ends - ends[0]
        self.length, self.gram = length, gram
        n = len(self.data)
        power, self.inverse = _power_tables(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        for a in range(0, n, PIECE):
            b = min(n, a + PIECE)
            part = self.sums[a + 1:b + 1]
            np.cumsum(_byte_values()[self.data[a:b]] * _power(power, np.arange(a, b)), out=part)
            part += self.sums[a]
        # Windows that lie in one text.
        room = np.maximum(np.diff(self.bounds) - length + 1, 0)
        whole = np.zeros(n + 1, np.int8)
        np.add.at(whole, self.bounds[:-1], (room > 0).astype(np.int8))
        np.add.at(whole, self.bounds[:-1] + room, -(room > 0).astype(np.int8))
        self.starts = np.flatnonzero(np.cumsum(whole[:n], dtype=np.int8))

    def hash(self, at: np.ndarray, size) -> np.ndarray:
        out, sizes = np.empty(len(at), np.uint64), np.broadcast_to(size, len(at))
        for i in range(0, len(at), PIECE):
            x, n = at[i:i + PIECE], sizes[i:i + PIECE]
            out[i:i + PIECE] = mixed((self.sums[x + n] - self.sums[x]) * _power(self.inverse, x) + n.astype(np.uint64))
        return out

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the stretches of windows with one anchor each: the anchor, the first and the last
        window."""
        if not len(self.starts):
            return (np.zeros(0, np.int64),) * 3
        n, span = len(self.data) - self.gram + 1, self.length - self.gram + 1
        anchors, firsts, lasts = [], [], []
        of_last, at_last = -1, -2
        for i in range(0, len(self.starts), PIECE):
            at = self.starts[i:i + PIECE]
            of = self._least(int(at[0]), min(n, int(at[-1]) + span))[at - at[0]]
            new = np.flatnonzero((np.diff(of, prepend=of_last) != 0) | (np.diff(at, prepend=at_last) != 1))
            anchors.append(of[new])
            firsts.append(at[new])
            # The window before each first one is the last of its stretch.
            lasts.append(np.where(new > 0, at[new - 1], at_last))
            of_last, at_last = int(of[-1]), int(at[-1])
        last = np.append(np.concatenate(lasts)[1:], at_last)
        return np.concatenate(anchors), np.concatenate(firsts), last

    def _least(self, start: int, end: int) -> np.ndarray:
        """Of every window from ``start`` on whose grams begin before ``end``, the anchor."""
        at, span = np.arange(start, end), self.length - self.gram + 1
        # The hash leads, the place breaks ties to the left.
        low = (self.hash(at, self.gram) & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
        windows, reach = len(low) - span + 1, 1
        while reach * 2 <= span:
            low = np.minimum(low[:-reach], low[reach:])
            reach *= 2
        if reach < span:
            low = np.minimum(low[:windows], low[span - reach: span - reach + windows])
        return (low & np.uint64(0xFFFFFFFF)).astype(np.int64)


class Stretches:
    """The first round of a block: anchors and stretches with their keys."""

    def __init__(self, texts: pa.ChunkedArray, space: KeySpace, length: int, gram: int):
        self.bytes = b = BlockBytes(texts, length, gram)
        anchor, self.first, self.last = b.anchors()
        grams = space.reduce(b.hash(anchor, gram))
        whole = space.reduce(b.hash(self.first, self.last - self.first + length))
        self.grams, self.gram, self.gram_counts = np.unique(grams, return_inverse=True, return_counts=True)
        self.wholes, self.first_of, self.whole, self.whole_counts = np.unique(
            whole, return_index=True, return_inverse=True, return_counts=True
        )

    def judge(self, told: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Which stretches repeat as a whole, and the windows that must be ranked themselves."""
        grams, _ = replies_of(told, ANCHOR)
        wholes, own = replies_of(told, STRETCH)
        if not len(self.first):
            return np.zeros(0, bool), np.zeros(0, np.int64)
        n_gram, n_whole = grams[self.gram], wholes[self.whole]
        repeats = n_whole > 1
        once = np.zeros(len(self.first), bool)
        once[self.first_of] = True
        # A repeated stretch stands for its copies, if its anchor occurs elsewhere as well.
        speaks = repeats & once & own[self.whole] & (n_gram > n_whole)
        sent = (~repeats & (n_gram > 1)) | speaks
        sizes = (self.last - self.first + 1)[sent]
        at = np.repeat(self.first[sent] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        return repeats, at


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text``): ``n_bytes, n_removed, n_spans`` (runs of
    removed bytes), ``kept_sha256`` and ``kept``, the bytes that stay. Nulls count as empty
    texts, and matches never cross texts. Repeated rows, null ids included, are texts
    of their own and so repeats of each other. Strings are told apart by 64-bit hashes."""
    blocks, n = text_blocks(docs.select("doc_id", "text"), block_bytes)
    # Written once by block: all rounds read it without moving text again.
    by_block = co_located(blocks, n)
    space = KeySpace.for_keys(n * block_bytes // 64, KEY_BYTES)

    def first_round(table: pa.Table) -> pa.Table:
        s = Stretches(table["text"], space, length, gram)
        block = table["block"][0].as_py()
        return requests_table(
            space.pack(ANCHOR, block, s.grams, s.gram_counts) + space.pack(STRETCH, block, s.wholes, s.whole_counts)
        )

    def second_round(table: pa.Table, told: pa.Table) -> pa.Table:
        if not table.num_rows or not told.num_rows:
            return requests_table([])
        s = Stretches(table["text"], space, length, gram)
        _, at = s.judge(told)
        keys, counts = np.unique(space.reduce(s.bytes.hash(at, length)), return_counts=True)
        return requests_table(space.pack(WINDOW, table["block"][0].as_py(), keys, counts))

    requests = by_block.groupBy("block").applyInArrow(first_round, REQUEST)
    ranked = stage(count_keys(requests), "repeats-anchors").filter("block >= 0")
    asked = by_block.groupBy("block").cogroup(ranked.groupBy("block")).applyInArrow(second_round, REQUEST)
    windows = stage(count_keys(asked), "repeats-windows").filter("block >= 0")

    id_type = docs.schema["doc_id"].dataType.simpleString()
    id_arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type]

    def cut(table: pa.Table, told: pa.Table) -> pa.Table:
        rows, ids = [], pa.array([], id_arrow)
        if table.num_rows:
            s = Stretches(table["text"], space, length, gram)
            b = s.bytes
            gone = _removed(s, told, space)
            ids = table["doc_id"].combine_chunks().cast(id_arrow)
            for x, y in zip(b.bounds[:-1], b.bounds[1:], strict=True):
                g = gone[x:y]
                kept = b.data[x:y][~g].tobytes()
                spans = int(np.count_nonzero(np.diff(g.astype(np.int8), prepend=0) == 1))
                rows.append((len(g), int(np.count_nonzero(g)), spans, hashlib.sha256(kept).hexdigest(), kept))
        columns = list(zip(*rows, strict=True)) or [()] * 5
        types = [pa.int64()] * 3 + [pa.string(), pa.binary()]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        return pa.table([ids, *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=names)

    told = ranked.unionByName(windows)
    return by_block.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        cut, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )


def _removed(s: Stretches, told: pa.Table, space: KeySpace) -> np.ndarray:
    """Which bytes of a block a repeated window covers."""
    b = s.bytes
    edges = np.zeros(len(b.data) + 1, np.int32)
    if len(s.first) and told.num_rows:
        repeats, at = s.judge(told)
        np.add.at(edges, s.first[repeats], 1)
        np.add.at(edges, s.last[repeats] + b.length, -1)
        if len(at):
            totals, _ = replies_of(told, WINDOW)
            _, key = np.unique(space.reduce(b.hash(at, b.length)), return_inverse=True)
            again = at[totals[key] > 1]
            np.add.at(edges, again, 1)
            np.add.at(edges, again + b.length, -1)
    return np.cumsum(edges[:-1], dtype=np.int32) > 0

"""Counting keys over all blocks of a corpus, and telling every block the counts of its own.

A block of texts makes many small keys: hashes of n-grams or of byte strings. As rows they
would be too many to shuffle, so a block packs its distinct keys, sorted and cut into buckets
by their leading bits, into one row per bucket. The rows of a bucket meet in a task, which
adds up equal keys and answers each block with an array in the order of its keys. However
frequent a key is, it comes once from each block.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BUCKET_KEYS = 1 << 20
LEAST_BITS = 7

REQUEST = "kind int, bucket int, block int, keys binary, counts binary, size int"
REPLY = "kind int, bucket int, block int, totals binary, size int, owner binary"


@dataclass(frozen=True)
class KeySpace:
    """Keys are 64-bit hashes: ``bits`` lead to the bucket, ``width`` bytes tell keys of a bucket
    apart. Two keys are confused with a chance of 2^-(bits + 8 width), or 2^-64."""

    bits: int
    width: int

    @classmethod
    def for_keys(cls, expected: int, width: int) -> KeySpace:
        return cls(max(LEAST_BITS, math.ceil(math.log2(max(1, expected / BUCKET_KEYS)))), width)

    def reduce(self, hashes: np.ndarray) -> np.ndarray:
        """Keys as told apart: leading bits that don't count are cut off."""
        spare = 64 - self.bits - 8 * self.width
        return hashes >> np.uint64(spare) if spare > 0 else hashes

    def _shift(self) -> np.uint64:
        return np.uint64(min(64 - self.bits, 8 * self.width))

    def pack(self, kind: int, block: int, keys: np.ndarray, counts: np.ndarray) -> list[tuple]:
        """Request rows of one block's reduced keys, which are distinct and sorted."""
        rows = []
        for bucket, part in self.buckets(keys):
            low = keys[part] & ((np.uint64(1) << self._shift()) - np.uint64(1))
            packed = smallest(counts[part])
            rows.append((kind, bucket, block, packed_keys(low), packed.tobytes(), packed.itemsize))
        return rows

    def buckets(self, keys: np.ndarray) -> list[tuple[int, slice]]:
        if not len(keys):
            return []
        bucket = (keys >> self._shift()).astype(np.int64)
        starts = np.flatnonzero(np.diff(bucket, prepend=-1))
        return [
            (int(bucket[a]), slice(int(a), int(b)))
            for a, b in zip(starts, [*starts[1:], len(keys)], strict=True)
        ]


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as the steps from one to the next, in as many bytes as the largest takes: all
    first bytes, then all second ones. Leading bytes are small, and so shrink."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    width = max(1, -(-int(steps.max(initial=0)).bit_length() // 8))
    return squeezed(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes())


def unpacked(data: bytes, n: int) -> np.ndarray:
    columns = np.frombuffer(unsqueezed(data), np.uint8).reshape(-1, n)
    out = np.zeros((n, 8), np.uint8)
    out[:, : len(columns)] = columns.T
    return np.cumsum(out.view("<u8").ravel(), dtype=np.uint64)


def squeezed(data: bytes) -> bytes:
    """Counts are mostly small and alike, so that replies shrink to a fraction."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(data) if data else b""


def unsqueezed(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data) if data else b""


def smallest(counts: np.ndarray) -> np.ndarray:
    top = counts.max(initial=0)
    return counts.astype(np.min_scalar_type(int(top)).newbyteorder("<"))


def unsigned(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{size}")


def requests_table(rows: list[tuple]) -> pa.Table:
    names = [c.split()[0] for c in REQUEST.split(", ")]
    types = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32()]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def count_keys(requests: DataFrame) -> DataFrame:
    """Replies to ``requests``: for each row the totals of its keys over all blocks, in their order,
    and a bit per key that is set in one row only, for the block that owns it. A row of
    block -1 has the number of keys with a count above zero as its only total."""

    def add_up(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        rows = table.to_pydict()
        sizes = [len(c) // s for c, s in zip(rows["counts"], rows["size"], strict=True)]
        keys = [unpacked(k, n) for k, n in zip(rows["keys"], sizes, strict=True)]
        counts = np.concatenate([unsigned(c, s) for c, s in zip(rows["counts"], rows["size"], strict=True)])
        every = np.concatenate(keys)
        distinct, first, place = np.unique(every, return_index=True, return_inverse=True)
        sums = np.bincount(place, weights=counts, minlength=len(distinct)).astype(np.uint64)
        own = np.zeros(len(every), bool)
        own[first] = True
        totals, at, out = sums[place], 0, []
        for part in keys:
            end = at + len(part)
            packed = smallest(totals[at:end])
            out.append((squeezed(packed.tobytes()), packed.itemsize, squeezed(np.packbits(own[at:end]).tobytes())))
            at = end
        known = np.array([np.count_nonzero(sums)], "<u8")
        out.append((squeezed(known.tobytes()), 8, b""))
        kind, bucket = rows["kind"][0], rows["bucket"][0]
        n = len(out)
        return pa.table({
            "kind": pa.array([kind] * n, pa.int32()), "bucket": pa.array([bucket] * n, pa.int32()),
            "block": pa.array([*rows["block"], -1], pa.int32()),
            "totals": pa.array([o[0] for o in out], pa.binary()),
            "size": pa.array([o[1] for o in out], pa.int32()),
            "owner": pa.array([o[2] for o in out], pa.binary()),
        })

    return requests.groupBy("kind", "bucket").applyInArrow(add_up, REPLY)


def replies_of(table: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Totals and ownership of a block's keys of one kind, in the order of the keys."""
    rows = sorted(
        (b, t, s, o)
        for k, b, t, s, o in zip(*(table[c].to_pylist() for c in ("kind", "bucket", "totals", "size", "owner")),
                                 strict=True)
        if k == kind
    )
    totals = [unsigned(unsqueezed(t), s).astype(np.int64) for _, t, s, _ in rows]
    owner = [
        np.unpackbits(np.frombuffer(unsqueezed(o), np.uint8), count=len(t)).astype(bool)
        for t, (_, _, _, o) in zip(totals, rows, strict=True)
    ]
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    return np.concatenate(totals), np.concatenate(owner)


def mixed(h: np.ndarray) -> np.ndarray:
    """Bits of 64-bit integers well mixed, wrapping around."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))

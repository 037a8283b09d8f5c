"""WARC archives in seekable Zstandard bundles.

A bundle is a run of independent Zstandard frames, each holding some records, and a seek
table in a skippable frame at the end, as the seekable format has it. Any decompressor
reads a bundle from front to back; a reader that knows the table opens one frame. Beside the
bundles an index maps every record to its frame and its offset in there.

Records are written by Spark tasks straight to the shared folder, under a name that
holds the attempt. Which files count is what the index says, and Spark commits that as
one table: a lost or repeated task leaves files nobody refers to.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from contextlib import ExitStack

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgauge.llm.common import pieces_of, stage
from tripgauge.session import scratch_dir

# Raw bytes in a frame and compressed bytes in a bundle, about.
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 256 << 20
# Raw bytes of records that one task reads back, about.
READ_BYTES = 64 << 20
# Payloads below this are never stored as a revisit.
LEAST_REVISIT = 100

# Magic numbers of the skippable frame and of the seek table's footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
DATE = "2026-01-01T00:00:00Z"

_INDEX = (
    "record_id string, bundle string, frame long, frame_start long, frame_size long, "
    "record_start long, record_size long"
)


def open_folder(uri: str):
    """File system and path of a folder, by any scheme pyarrow knows."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def record(record_id: str, url: str, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC record. A revisit holds no payload, only the digest and size of it."""
    body = b"" if refers_to else payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to else 'response'}",
        f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Payload-Length: {len(payload)}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(body)}",
    ]
    if refers_to:
        lines.insert(6, f"WARC-Refers-To: <{refers_to}>")
        lines.insert(7, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers by lower-case name, and the block, of the record at the start of ``data``."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    return headers, rest[: int(headers["content-length"])]


class BundleWriter:
    """Writes records into frames and frames into one file."""

    def __init__(self, file, frame_bytes: int = FRAME_BYTES):
        import zstandard

        self.file, self.frame_bytes = file, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=3)
        self.frames: list[tuple[int, int]] = []
        self.pending: list[tuple[str, bytes]] = []
        self.size = self.at = 0

    def add(self, record_id: str, data: bytes) -> list[tuple]:
        """Index rows (record, frame, its start and size, start and size within) of a frame
        that this record filled, if it did."""
        self.pending.append((record_id, data))
        self.size += len(data)
        return self.flush() if self.size >= self.frame_bytes else []

    def flush(self) -> list[tuple]:
        if not self.pending:
            return []
        packed = self.compressor.compress(b"".join(d for _, d in self.pending))
        rows, inside = [], 0
        for record_id, data in self.pending:
            rows.append((record_id, len(self.frames), self.at, len(packed), inside, len(data)))
            inside += len(data)
        self.file.write(packed)
        self.frames.append((len(packed), self.size))
        self.at += len(packed)
        self.pending, self.size = [], 0
        return rows

    def close(self) -> list[tuple]:
        rows = self.flush()
        entries = b"".join(struct.pack("<II", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.file.write(struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer)
        self.file.close()
        return rows


def seek_table(file) -> list[tuple[int, int, int]]:
    """Start, compressed and raw size of every frame, from the footer of an open bundle."""
    size = file.size()
    file.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table at the end of the bundle")
    width = 12 if flags & 0x80 else 8
    file.seek(size - 9 - n * width)
    data = file.read(n * width)
    frames, at = [], 0
    for i in range(n):
        packed, raw = struct.unpack_from("<II", data, i * width)
        frames.append((at, packed, raw))
        at += packed
    return frames


def read_record(folder: str, bundle: str, frame: int, record_start: int, record_size: int) -> tuple[dict, bytes]:
    """One record, by what the index says of it: only its frame is read."""
    import zstandard

    system, path = open_folder(folder)
    with system.open_input_file(f"{path}/{bundle}") as file:
        start, packed, raw = seek_table(file)[frame]
        file.seek(start)
        data = zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=raw)
    return parse_record(data[record_start:record_start + record_size])


def plan_records(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``page_id, url, html`` with ``digest`` and ``refers_to``, the page whose payload this one
    repeats. Groups are counted on digests, combined on the map side; of payloads below
    ``least`` bytes, or of pages without an id, none refers to another. Null pages are empty
    payloads. Repeated rows of one page are each a record, all of them responses where
    their page is the first of its payload."""
    body = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", "html", F.sha2(body, 256).alias("digest"))
    first = (
        rows.filter(F.octet_length(body) >= least)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("digest", "first_id")
    )
    # The join is on narrow rows; the pages themselves move once, by their own id.
    again = (
        rows.select("page_id", "digest").join(first, "digest").filter("page_id > first_id")
        .select("page_id", "digest", F.col("first_id").alias("refers_to")).distinct()
    )
    return rows.join(again, ["page_id", "digest"], "left")


def write_bundles(
    planned: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES
) -> DataFrame:
    """Write one record per row below ``folder``; the index of all records, as a table that
    is written when this returns."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        context = TaskContext.get()
        system, path = open_folder(folder)
        system.create_dir(path)
        writer, name, part, names = None, "", 0, _INDEX_NAMES
        for batch in batches:
            rows: list[tuple] = []
            for page, url, html, digest, first in batch.itertuples(index=False, name=None):
                if writer is None:
                    name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{part:04d}.warc.zst"
                    file = system.open_output_stream(f"{path}/{name}", compression=None)
                    writer, part = BundleWriter(file, frame_bytes), part + 1
                own, whole = record_name(page), (html or "").encode()
                data = record(own, url or "", whole, digest, None if pd.isna(first) else record_name(first))
                rows += [(r[0], name, *r[1:]) for r in writer.add(own, data)]
                if writer.at >= bundle_bytes:
                    rows += [(r[0], name, *r[1:]) for r in writer.close()]
                    writer = None
            yield pd.DataFrame(rows, columns=names)
        if writer is not None:
            yield pd.DataFrame([(r[0], name, *r[1:]) for r in writer.close()], columns=names)

    ordered = planned.select(
        F.col("page_id").cast("string"), F.regexp_replace("url", r"[\r\n]", " ").alias("url"), "html", "digest",
        F.col("refers_to").cast("string"),
    )
    return stage(ordered.mapInPandas(write, _INDEX), "warc-index")


_INDEX_NAMES = [c.split()[0] for c in _INDEX.split(", ")]


def record_name(page: str | None) -> str:
    return f"urn:page:{page}" if page is not None and not pd.isna(page) else f"urn:uuid:{uuid.uuid4()}"


def read_bundles(index: DataFrame, folder: str) -> DataFrame:
    """Every record of the bundles that ``index`` names: ``record_id, record_type, refers_to,
    payload_bytes, payload_digest, payload``. A task opens a bundle, reads its seek table once
    and then one frame after the other. Digests of responses are made anew from what
    was read and must be those of the header."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        system, path = open_folder(folder)
        unpack = zstandard.ZstdDecompressor()
        with ExitStack() as opened:
            name, file, frames = None, None, []
            for batch in batches:
                for (bundle, frame), part in batch.groupby(["bundle", "frame"], sort=True):
                    if bundle != name:
                        opened.close()
                        file = opened.enter_context(system.open_input_file(f"{path}/{bundle}"))
                        name, frames = bundle, seek_table(file)
                    start, packed, raw = frames[frame]
                    file.seek(start)
                    yield records_of(part, unpack.decompress(file.read(packed), max_output_size=raw))

    def records_of(part: pd.DataFrame, data: bytes) -> pd.DataFrame:
        rows = []
        for at, size in zip(part["record_start"], part["record_size"], strict=True):
            headers, payload = parse_record(data[at:at + size])
            digest = headers["warc-payload-digest"].removeprefix("sha256:")
            refers = headers.get("warc-refers-to")
            if not refers and hashlib.sha256(payload).hexdigest() != digest:
                raise ValueError(f"digest of {headers['warc-record-id']} differs")
            rows.append((
                headers["warc-record-id"].strip("<>"), headers["warc-type"],
                refers and refers.strip("<>"), int(headers["warc-payload-length"]), digest,
                None if refers else payload,
            ))
        return pd.DataFrame(rows, columns=names)

    names = ["record_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    schema = "record_id string, record_type string, refers_to string, payload_bytes long, " \
             "payload_digest string, payload binary"
    # Tasks by the bytes they will read, not by those of the index; each gets a stretch of frames.
    tasks = pieces_of(index, F.col("record_size"), READ_BYTES)
    by_frame = index.repartitionByRange(tasks, "bundle", "frame").sortWithinPartitions("bundle", "frame", "record_start")
    return by_frame.mapInPandas(read, schema)


def archive(pages: DataFrame, folder: str | None = None) -> tuple[str, DataFrame]:
    """Write all ``pages``; the folder of the bundles and the index."""
    spark: SparkSession = pages.sparkSession
    folder = folder or scratch_dir(spark, "warc")
    return folder, write_bundles(plan_records(pages), folder)

"""WARC archives as seekable Zstandard bundles.

Every task writes its records to bundles of its own in the shared folder: records are grouped
into independent Zstandard frames, a seek table in a skippable frame closes the file, and an
index row per record gives bundle, frame and the record's place inside the frame. The index
is a table that Spark commits, so a bundle left behind by a failed attempt is in no index.
One record is read by seeking to its frame; all are read frame by frame.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import stored

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 64 << 20
DEDUPE_BYTES = 1000
LEVEL = 3
# Fixed values of the seekable format and of the archive format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


# --- records -----------------------------------------------------------------


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(identifier: str) -> int | None:
    value = identifier.removeprefix("<urn:page:").removesuffix(">")
    return None if value == "none" else int(value)


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
    is_revisit: bool,
) -> bytes:
    """One archive record: an HTTP response, or the head of one for a revisit."""
    head = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        b"Content-Length: %d\r\n\r\n" % len(payload)
    )
    block = head if is_revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if is_revisit else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if is_revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return VERSION + b"\r\n" + lines + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Archive fields, HTTP fields and payload of one record."""

    def fields(lines: bytes) -> dict[str, str]:
        pairs = (line.split(": ", 1) for line in lines.decode().split("\r\n")[1:])
        return {k: v for k, v in pairs}

    head, rest = data.split(b"\r\n\r\n", 1)
    warc = fields(head)
    block = rest[: int(warc["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    return warc, fields(http), payload


# --- bundles -----------------------------------------------------------------


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The closing skippable frame: compressed and whole size of every frame."""
    entries = b"".join(struct.pack("<II", *f) for f in frames)
    body = entries + struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(file, size: int) -> list[tuple[int, int]]:
    """``(position, compressed size)`` of every frame of a bundle."""
    file.seek(size - 9)
    count, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE_MAGIC or flags:
        raise ValueError("not a seekable bundle")
    file.seek(size - 9 - 8 * count)
    sizes = struct.iter_unpack("<II", file.read(8 * count))
    out, at = [], 0
    for packed_size, _ in sizes:
        out.append((at, packed_size))
        at += packed_size
    return out


class Bundle:
    """Writes one bundle; ``add`` gives a record's frame and its place in the frame."""

    def __init__(self, folder: str):
        files, path = pafs.FileSystem.from_uri(folder)
        files.create_dir(path, recursive=True)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.file = files.open_output_stream(f"{path}/{self.name}", compression=None)
        self.codec = zstandard.ZstdCompressor(level=LEVEL)
        self.frames: list[tuple[int, int]] = []
        self.parts: list[bytes] = []
        self.pending = self.size = 0

    def add(self, data: bytes) -> tuple[int, int]:
        place = len(self.frames), self.pending
        self.parts.append(data)
        self.pending += len(data)
        self.size += len(data)
        if self.pending >= FRAME_BYTES:
            self._flush()
        return place

    def _flush(self) -> None:
        if self.parts:
            packed = self.codec.compress(b"".join(self.parts))
            self.file.write(packed)
            self.frames.append((len(packed), self.pending))
            self.parts, self.pending = [], 0

    def close(self) -> None:
        self._flush()
        self.file.write(seek_table(self.frames))
        self.file.close()


def open_bundle(folder: str, name: str):
    files, path = pafs.FileSystem.from_uri(folder)
    file = files.open_input_file(f"{path}/{name}")
    return file, read_seek_table(file, file.size())


def frame(file, frames: list[tuple[int, int]], number: int) -> bytes:
    at, size = frames[number]
    file.seek(at)
    return zstandard.ZstdDecompressor().decompress(file.read(size))


# --- operator ----------------------------------------------------------------


def decide(pages: DataFrame, least: int = DEDUPE_BYTES) -> DataFrame:
    """Pages with ``digest``, ``refers_to`` and ``is_revisit``.

    Of equal payloads of ``least`` bytes or more, the row with the largest page_id is the
    response. Digests are counted map-side, so a payload with very many copies is one row a
    task before it is joined back. Null page_ids count as smaller than any other; rows that
    share the largest page_id are all responses.
    """
    payload = F.coalesce(pages["html"], F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long"), "url", payload.alias("payload"), F.sha1(payload).alias("digest")
    )
    largest = (
        rows.where(F.octet_length("payload") >= least)
        .groupBy("digest")
        .agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND largest IS NOT NULL")
        .drop("n")
    )
    revisit = F.col("largest").isNotNull() & ~F.col("largest").eqNullSafe(F.col("page_id"))
    return rows.join(largest, "digest", "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(revisit, F.col("largest")).alias("refers_to"),
        F.coalesce(revisit, F.lit(False)).alias("is_revisit"),
    )


def write_bundles(decided: DataFrame, folder: str) -> DataFrame:
    """Write all records below ``folder``; the stored index
    ``(record_id, bundle, frame, start, length)``."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bundle = None
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                bundle = bundle or Bundle(folder)
                page_id, refers_to = (
                    None if pd.isna(x) else int(x) for x in (row.page_id, row.refers_to)
                )
                data = record(
                    page_id, row.url, row.payload, row.digest, refers_to, row.is_revisit
                )
                out.append((record_id(page_id), bundle.name, *bundle.add(data), len(data)))
                if bundle.size >= BUNDLE_BYTES:
                    bundle.close()
                    bundle = None
            yield pd.DataFrame(out, columns=["record_id", "bundle", "frame", "start", "length"])
        if bundle:
            bundle.close()

    # ids as text: pandas would turn long ids with nulls into floats
    rows = decided.withColumn("page_id", F.col("page_id").cast("string")).withColumn(
        "refers_to", F.col("refers_to").cast("string")
    )
    return stored(
        rows.mapInPandas(
            write, "record_id string, bundle string, frame int, start long, length long"
        ),
        "warc-index",
    )


def read_bundles(index: DataFrame, folder: str) -> DataFrame:
    """The records an index lists, each frame decompressed once: ``page_id, url, payload_bytes,
    payload_digest, record_type, refers_to`` and the ``payload`` itself (null for a revisit)."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name = number = file = frames = data = None
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if row.bundle != name:
                    if file:
                        file.close()
                    (file, frames), name, number = open_bundle(folder, row.bundle), row.bundle, None
                if row.frame != number:
                    data, number = frame(file, frames, row.frame), row.frame
                warc, http, payload = parse(data[row.start : row.start + row.length])
                kind = warc["WARC-Type"]
                written = warc["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response" and hashlib.sha1(payload).hexdigest() != written:
                    raise ValueError(f"{row.record_id}: the payload was damaged")
                refers = page_of(warc["WARC-Refers-To"]) if kind == "revisit" else None
                out.append(
                    (
                        page_of(warc["WARC-Record-ID"]), warc.get("WARC-Target-URI"),
                        int(http["Content-Length"]), written, kind, refers,
                        payload if kind == "response" else None,
                    )
                )
            yield pd.DataFrame(
                out,
                columns=["page_id", "url", "payload_bytes", "payload_digest", "record_type",
                         "refers_to", "payload"],
            ).astype({"page_id": "Int64", "refers_to": "Int64"})
        if file:
            file.close()

    tasks = max(1, index.select("bundle").distinct().count())
    return (
        index.repartition(tasks, "bundle")
        .sortWithinPartitions("bundle", "frame", "start")
        .mapInPandas(
            read,
            "page_id long, url string, payload_bytes long, payload_digest string, "
            "record_type string, refers_to long, payload binary",
        )
    )


def page_archive(pages: DataFrame) -> DataFrame:
    """Write all pages to bundles in the shared folder and read the archives back.

    A null html is an empty payload; an empty table writes no bundle and gives no rows.
    Columns other than page_id, url and html are not read.
    """
    folder = scratch_path(pages.sparkSession, "bundles")
    index = write_bundles(decide(pages), folder)
    return read_bundles(index, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )

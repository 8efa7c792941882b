"""WARC archives: a writer that records equal payloads once, and a splittable reader.

Each task writes one file of gzip members, one member for each record. Files have
names of their own for every attempt; only the files that finished tasks name in
the manifest belong to the archive, so a task that runs again leaves no double.

The reader cuts every file into byte ranges. A task scans its range for gzip magic,
takes a candidate for a record only if its first decoded bytes are WARC headers,
reads members one after the other from there, and owns the records that start
inside its range, also when they end behind it.

Files are reached through ``pyarrow.fs``, which takes local and object-store URIs.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator, Mapping

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkq.plans.staging import new_path, stage

MAGIC = b"\x1f\x8b\x08"
# Fixed value: the profile that the WARC 1.1 standard names for repeated payloads.
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RANGE = 4 << 20
TASK = 64 << 20
READ = 1 << 17
# Payload bytes of a batch handed on.
HELD = 4 << 20
# What every record begins with.
VERSION = b"WARC/1."


# --- records --------------------------------------------------------------------


def record_id(row: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, row)}>"


def encode_record(headers: Mapping[str, str], payload: bytes) -> bytes:
    """One gzip member with one record."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    head += f"Content-Length: {len(payload)}\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + payload + b"\r\n\r\n") + packer.flush()


def decode_record(data: bytes) -> tuple[dict[str, str], bytes] | None:
    """Headers and payload of an inflated member, or None if it is no record."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    if not gap or not data.startswith(VERSION):
        return None
    headers = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            return None
        headers[name.strip().lower()] = value.strip()
    length = headers.get("content-length", "")
    if not length.isdigit() or int(length) > len(rest):
        return None
    return headers, rest[: int(length)]


def _open(path: str):
    files, inner = pafs.FileSystem.from_uri(path if "://" in path else _uri(path))
    return files, inner


def _uri(path: str) -> str:
    """Hadoop writes local paths as file:/x; arrow wants file:///x."""
    return "file://" + path.removeprefix("file:")


def clean(value: str | None) -> str:
    """A header value has no line breaks."""
    return " ".join((value or "").split())


# --- writing --------------------------------------------------------------------


def with_revisits(pages: DataFrame, least: int = 1000) -> DataFrame:
    """Adds payload, digest (hex SHA-1), payload_bytes, record_type and refers_to.

    Of equal payloads of at least ``least`` bytes the row of the largest page_id is
    the response (all rows, if it comes twice); the others refer to it. Rows without
    page_id refer to one that has it; where none has, all are responses. Columns of
    the same names are replaced.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = (
        pages.select("page_id", "url", payload.alias("payload"))
        .withColumn("payload_bytes", F.length("payload").cast("long"))
        .withColumn("digest", F.sha1("payload"))
    )
    # Staged, so that Spark knows its size and may split a digest that many rows share.
    firsts = stage(
        rows.where(F.col("payload_bytes") >= least)
        .groupBy("digest")
        .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & F.col("first").isNotNull())
        .drop("n"),
        "payloads",
    )
    repeated = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(firsts, "digest", "left").select(
        *rows.columns,
        F.when(repeated, "revisit").otherwise("response").alias("record_type"),
        F.when(repeated, F.col("first")).alias("refers_to"),
    )


def write_archive(records: DataFrame, folder: str, files: int | None = None) -> DataFrame:
    """Write the rows of ``with_revisits`` below ``folder``; returns the manifest
    (path, size, records), itself staged so that nothing is written again."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        store, inner = _open(path)
        out, size, count = None, 0, 0
        for row in _rows(batches):
            if out is None:
                store.create_dir(inner.rpartition("/")[0], recursive=True)
                out = store.open_output_stream(inner, compression=None)
            member = encode_record(
                _headers(row), b"" if row["record_type"] == "revisit" else row["payload"]
            )
            out.write(member)
            size += len(member)
            count += 1
        if out is not None:
            out.close()
            yield pa.record_batch(
                [pa.array([path]), pa.array([size], pa.int64()), pa.array([count], pa.int64())],
                ["path", "size", "records"],
            )

    if files is not None:
        records = records.repartition(files)
    return stage(records.mapInArrow(write, "path string, size long, records long"), "manifest")


def _rows(batches: Iterator[pa.RecordBatch], at_once: int = 256) -> Iterator[dict]:
    for batch in batches:
        for i in range(0, batch.num_rows, at_once):
            yield from batch.slice(i, at_once).to_pylist()


def _headers(row: Mapping) -> dict[str, str]:
    page, revisit = row["page_id"], row["record_type"] == "revisit"
    digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
    headers = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": record_id(f"{page}/{row['digest']}"),
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": clean(row["url"]),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "text/html; charset=utf-8",
        "Page-Payload-Length": str(row["payload_bytes"]),
    }
    if page is not None:
        headers["Page-Id"] = str(page)
    if revisit:
        headers["WARC-Profile"] = REVISIT
        headers["WARC-Refers-To"] = record_id(f"{row['refers_to']}/{row['digest']}")
        headers["Refers-To-Page-Id"] = str(row["refers_to"])
    return headers


# --- reading --------------------------------------------------------------------


class Window:
    """The part of a file looked at, read on in pieces of ``READ`` bytes."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size
        self.start, self.data = 0, b""

    def piece(self, at: int) -> bytes:
        """Some bytes from ``at`` on; empty at the end of the file."""
        if not self.start <= at < self.start + len(self.data):
            self.start, self.data = at, self.file.read_at(READ, at) if at < self.size else b""
        return self.data[at - self.start :]

    def find(self, pattern: bytes, at: int, end: int) -> int | None:
        """The first place of ``pattern`` that begins in ``at:end``."""
        while at < end:
            if self.start <= at < self.start + len(self.data):
                found = self.data.find(pattern, at - self.start)
                if found >= 0:
                    at = self.start + found
                    return at if at < end else None
                # The pattern may begin on the last bytes held.
                at = max(at, self.start + len(self.data) - len(pattern) + 1)
            if at + len(pattern) > self.size:
                return None
            self.start, self.data = at, self.file.read_at(READ, at)
            if len(self.data) < len(pattern):
                return None
        return None


def _inflate(window: Window, at: int) -> tuple[bytes, int] | None:
    """The member at ``at`` and where it ends; None if the bytes there are no record.

    A candidate is given up as soon as its first bytes are not those of a record.
    """
    unpack = zlib.decompressobj(31)
    parts: list[bytes] = []
    position, shown = at, b""
    try:
        while not unpack.eof:
            piece = window.piece(position)
            if not piece:
                return None
            parts.append(unpack.decompress(piece))
            position += len(piece)
            if len(shown) < len(VERSION):
                shown = b"".join(parts)[: len(VERSION)]
                if not VERSION.startswith(shown):
                    return None
    except zlib.error:
        return None
    return b"".join(parts), position - len(unpack.unused_data)


def scan_range(file, size: int, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, headers and payload of the records that start in ``start:end``."""
    window = Window(file, size)
    at: int | None = start
    while (at := window.find(MAGIC, at, end)) is not None:
        member = _inflate(window, at)
        record = decode_record(member[0]) if member else None
        if record:
            yield at, *record
        at = member[1] if record else at + 1


RECORD = "path string, offset long, headers map<string,string>, payload binary, payload_digest string"


def read_archive(manifest: DataFrame, range_bytes: int = RANGE) -> DataFrame:
    """The records of the files in ``manifest`` (path, size), read by byte ranges.

    ``payload_digest`` is the hex SHA-1 of the payload; a revisit, which has none,
    gives the digest of its header. Header names are in lower case.
    """
    ranges = manifest.where("size > 0").select(
        "path",
        "size",
        F.explode(
            F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(range_bytes).cast("long"))
        ).alias("start"),
    )
    context = manifest.sparkSession.sparkContext
    total = manifest.agg(F.sum("size")).first()[0] or 0
    # A task takes one range or several, up to TASK bytes of them.
    tasks = max(context.defaultParallelism, total // TASK, 1)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            store, inner = _open(row["path"])
            with store.open_input_file(inner) as file:
                held: list[tuple] = []
                size = 0
                for found in scan_range(file, row["size"], row["start"], row["start"] + range_bytes):
                    held.append((row["path"], *found))
                    size += len(found[2])
                    if size > HELD:
                        yield _batch(held)
                        held, size = [], 0
                if held:
                    yield _batch(held)

    return ranges.repartition(int(tasks)).mapInArrow(read, RECORD)


def _digest(headers: Mapping[str, str], payload: bytes) -> str:
    if headers.get("warc-type") != "revisit":
        return hashlib.sha1(payload).hexdigest()
    return base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    path, offset, headers, payload = zip(*rows)
    return pa.record_batch(
        [
            pa.array(path, pa.string()),
            pa.array(offset, pa.int64()),
            pa.array([list(h.items()) for h in headers], pa.map_(pa.string(), pa.string())),
            pa.array(payload, pa.binary()),
            pa.array([_digest(h, p) for h, p in zip(headers, payload)], pa.string()),
        ],
        ["path", "offset", "headers", "payload", "payload_digest"],
    )


def header(name: str) -> Column:
    return F.element_at("headers", name.lower())


def round_trip(spark: SparkSession, pages: DataFrame, range_bytes: int = RANGE) -> DataFrame:
    """Write ``pages`` as an archive in the shared folder and read its records back."""
    manifest = write_archive(with_revisits(pages), new_path(spark, "warc"))
    return read_archive(manifest, range_bytes)

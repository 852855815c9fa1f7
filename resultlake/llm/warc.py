"""WARC archives with an index that is written first (operator 8).

Every task writes its pages as records to an archive file of its own name and returns
the index rows of the files it has closed: file, offset, length, URL and digest. Only
the index says which files count, so what a lost task leaves behind is never read.
Reading starts from the index: selected records are dealt out by file and stretch of
the file, sorted by offset, coalesced into byte ranges and read in one request each.

Of records with equal payloads of ``least`` bytes or more the one with the smallest
page_id holds it as a response; the others are revisits of it. A null html is an empty
payload, a null url is recorded as ``urn:page:<page_id>``. Rows with the same page_id
and payload are all responses if that id is the smallest; a row without an id is a
revisit where any other row has its payload. Repeated rows have a record each. Files
are opened through Arrow by the URI of the folder, which all executors must reach.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resultlake.llm.common import small, text_batches
from resultlake.session import stage

LEAST_BYTES = 100
# A task's file is closed at this size and another begun.
ROLL_BYTES = 1 << 30
# Records of one stretch of a file are read by one task; gaps up to this are read over.
STRETCH, GAP, RANGE = 2 << 20, 64 << 10, 8 << 20
DATE = "1970-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = (
    "file string, offset long, length long, url string, digest string, "
    "page_id long, record_type string, refers_to long, payload_bytes long"
)


def _file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def _header_value(text: str) -> str:
    """One line, whatever the text holds."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record(page_id, url, payload: bytes, digest: str, size: int, refers_to, revisit: bool) -> bytes:
    """A whole record, its end included."""
    block = HTTP % size + (b"" if revisit else payload)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_header_value(url) if url else f'urn:page:{page_id}'}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"X-Page-Id: {'' if page_id is None else page_id}",
        f"X-Payload-Length: {size}",
    ]
    if revisit:
        lines += [
            f"WARC-Profile: {PROFILE}",
            f"WARC-Refers-To: {_record_id(refers_to, digest)}",
            f"X-Refers-To-Page: {refers_to}",
        ]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def _write(batches, folder: str, compress: bool, roll: int):
    system, root = _file_system(folder)
    system.create_dir(root, recursive=True)
    out, name, at, rows = None, "", 0, []
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = [f.split(" ")[0] for f in INDEX.split(", ")]

    def listed():
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    try:
        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    name, at = f"{uuid.uuid4().hex}.warc{'.gz' if compress else ''}", 0
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                revisit = r["revisit"]
                raw = record(r["page_id"], r["url"], r["payload"], r["digest"], r["payload_bytes"], r["refers_to"], revisit)
                raw = gzip.compress(raw, 6, mtime=0) if compress else raw
                out.write(raw)
                rows.append(
                    (f"{folder}/{name}", at, len(raw), r["url"], r["digest"], r["page_id"],
                     "revisit" if revisit else "response", r["refers_to"], r["payload_bytes"])
                )
                at += len(raw)
                if at >= roll:
                    out.close()
                    out = None
                    yield listed()
                    rows = []
        if out is not None:
            out.close()
            out = None
            yield listed()
    finally:
        if out is not None:
            out.close()


def write_archives(
    pages: DataFrame, folder: str, least: int = LEAST_BYTES, compress: bool = False, roll: int = ROLL_BYTES
) -> DataFrame:
    """Write ``pages (page_id, url, html)`` to archives under ``folder``; returns their
    staged index."""
    text_batches(pages.sparkSession)
    html = F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b""))
    full = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        html.alias("payload"),
        F.sha2(html, 256).alias("digest"),
        F.octet_length(html).cast("long").alias("payload_bytes"),
    )
    large = stage(full.select("page_id", "digest", "payload_bytes").where(F.col("payload_bytes") >= least), "digests")
    shared = (
        large.groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null")
        .select("digest", "first")
    )
    again = stage(
        large.join(shared, "digest")
        .where(~F.col("page_id").eqNullSafe(F.col("first")))
        .select(F.col("page_id").alias("again_id"), F.col("digest").alias("again_digest"), "first")
        .distinct(),
        "revisits",
    )
    same = F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("digest") == F.col("again_digest"))
    typed = full.join(small(again), same, "left").select(
        "page_id",
        "url",
        F.when(F.col("first").isNull(), F.col("payload")).otherwise(F.lit(b"")).alias("payload"),
        "digest",
        "payload_bytes",
        F.col("first").alias("refers_to"),
        F.col("first").isNotNull().alias("revisit"),
    )
    return stage(typed.mapInArrow(partial(_write, folder=folder, compress=compress, roll=roll), INDEX), "warc-index")


def _ranges(batches):
    """Sorted index rows, coalesced: lists of (offset, length) of one file."""
    file, part, end = None, [], 0
    for batch in batches:
        for f, at, length in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if part and (f != file or at - end > GAP or at + length - part[0][0] > RANGE):
                yield file, part
                part = []
            file, end = f, at + length
            part.append((at, length))
    if part:
        yield file, part


_READ = (
    "page_id long, url string, record_type string, payload_digest string, payload_bytes long, "
    "refers_to long, payload binary"
)


def _read(batches, payloads: bool):
    names = [f.split(" ")[0] for f in _READ.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    opened, source = None, None
    try:
        for file, part in _ranges(batches):
            if file != opened:
                if source is not None:
                    source.close()
                system, path = _file_system(file)
                opened, source = file, system.open_input_file(path)
            first, (last, size) = part[0][0], part[-1]
            block = source.read_at(last + size - first, first)
            rows = []
            for at, length in part:
                raw = block[at - first : at - first + length]
                headers, payload = parse(gzip.decompress(raw) if file.endswith(".gz") else raw)
                digest, kind = headers["WARC-Payload-Digest"].removeprefix("sha256:"), headers["WARC-Type"]
                if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"payload of the record at {at} of {file} does not have its digest")
                size_of = len(payload) if kind == "response" else int(headers["X-Payload-Length"])
                page, refers = headers["X-Page-Id"], headers.get("X-Refers-To-Page")
                rows.append(
                    (int(page) if page else None, headers["WARC-Target-URI"], kind, digest, size_of,
                     int(refers) if refers else None, payload if payloads else None)
                )
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
    finally:
        if source is not None:
            source.close()


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that rows ``(file, offset, length)`` of an index name, read back and
    checked against their digests."""
    wanted = index.select("file", "offset", "length", F.floor(F.col("offset") / STRETCH).alias("stretch"))
    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = wanted.repartition(parts, "file", "stretch").sortWithinPartitions("file", "offset")
    return dealt.select("file", "offset", "length").mapInArrow(partial(_read, payloads=payloads), _READ)

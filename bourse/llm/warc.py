"""WARC archives: writer and sequential reader.

Writer: every page is one record in its own gzip member.  Of records with
equal payloads of at least ``min_bytes`` the one with the largest page_id is a
``response``, the others are ``revisit`` records that refer to it and carry
the HTTP head only.  Tasks write archives of about ``ARCHIVE_BYTES`` payload
under names of their own attempt; only archives that a finished task lists in
the manifest are read, so a lost or repeated task leaves nothing in the result.
The folder may be any URI that pyarrow's file systems open.

Reader: archives are spread over tasks and each is read from its start in
chunks by incremental zlib decompression.  One member is one record: header
lines, Content-Length framing and the block and payload digests are verified.
A record is at most as large as its page; nothing else is held in memory.

Defined results: null html is an empty payload; a null url has no target URI;
rows that repeat with the largest page_id are all responses; a null page_id
never is referred to; an empty table gives no archive and no record; a broken
archive or a wrong digest raises ``WarcError`` with path and offset; other
columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import scratch, written

ARCHIVE_BYTES = 32 << 20
CHUNK = 1 << 18
DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BROADCAST_REVISITS = 200_000
LEVEL = 6


class WarcError(ValueError):
    pass


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, date: str = DATE) -> bytes:
    """One uncompressed WARC record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:x-page:{page_id}>"), ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if refers_to is not None:
        head += [("WARC-Refers-To", f"<urn:x-page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    head += [("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("WARC-Block-Digest", f"sha1:{digest(block)}"),
             ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return "WARC/1.1\r\n{}\r\n\r\n".format("\r\n".join(f"{k}: {v}" for k, v in head)).encode() + block + b"\r\n\r\n"


def members(stream, path: str = "") -> Iterator[tuple[int, bytes]]:
    """(offset, content) of each gzip member of a binary stream."""
    at, pending = 0, b""
    while True:
        pending = pending or stream.read(CHUNK)
        if not pending:
            return
        unzip, out, used = zlib.decompressobj(wbits=31), [], 0
        while not unzip.eof:
            if not pending:
                pending = stream.read(CHUNK)
                if not pending:
                    raise WarcError(f"{path}: member at {at} is cut off")
            try:
                out.append(unzip.decompress(pending))
            except zlib.error as e:
                raise WarcError(f"{path}: member at {at}: {e}") from e
            used += len(pending) - len(unzip.unused_data)
            pending = unzip.unused_data
        yield at, b"".join(out)
        at += used


def parse_record(content: bytes, where: str = "") -> dict:
    """Header fields, payload length, digests and payload of a record."""
    head, sep, rest = content.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not sep or not lines[0].startswith("WARC/"):
        raise WarcError(f"{where}: no record header")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    try:
        size = int(fields["content-length"])
    except (KeyError, ValueError):
        raise WarcError(f"{where}: no Content-Length") from None
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise WarcError(f"{where}: block of {len(rest) - 4} bytes, Content-Length {size}")
    if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha1:{digest(block)}":
        raise WarcError(f"{where}: wrong block digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, said = fields.get("warc-type"), fields.get("warc-payload-digest", "")
    if kind == "revisit":  # the payload is elsewhere; the head kept says how long it was
        length, found = next((int(v) for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")) if k.lower() == b"content-length"), 0), said
        payload = b""
    else:
        length, found = len(payload), f"sha1:{digest(payload)}"
    if said and said != found:
        raise WarcError(f"{where}: wrong payload digest")
    return {"record_type": kind, "record_id": fields.get("warc-record-id"), "url": fields.get("warc-target-uri"), "date": fields.get("warc-date"),
            "refers_to": fields.get("warc-refers-to"), "payload_bytes": length, "payload_digest": found.removeprefix("sha1:"), "payload": payload}


def _write(folder: str, archive_bytes: int):
    def run(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        out, path, size, count, n = None, "", 0, 0, 0
        done = []
        try:
            for batch in batches:
                for page_id, url, page, refers_to in zip(*(batch.column(c) for c in ("page_id", "url", "html", "refers_to"))):
                    if out is None:
                        path = f"{base}/{name}-{n}.warc.gz"
                        out, size, count, n = store.open_output_stream(path, compression=None), 0, 0, n + 1
                    payload = (page.as_py() or "").encode()
                    zipper = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    out.write(zipper.compress(record(page_id.as_py(), url.as_py(), payload, refers_to.as_py())) + zipper.flush())
                    size, count = size + len(payload), count + 1
                    if size >= archive_bytes:
                        out.close()
                        done.append((f"{folder}/{path.rpartition('/')[2]}", count))
                        out = None
        finally:
            if out is not None:
                out.close()
        if out is not None:
            done.append((f"{folder}/{path.rpartition('/')[2]}", count))
        cols = list(zip(*done)) or [(), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64())], names=["path", "records"])
    return run


def _read(with_payload: bool):
    names = ["path", "offset", "record_type", "record_id", "url", "date", "refers_to", "payload_bytes", "payload_digest"] + ["payload"] * with_payload
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()] + [pa.binary()] * with_payload

    def run(batches):
        from pyarrow import fs

        def out(rows):
            cols = list(zip(*rows)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

        for batch in batches:
            for uri in batch.column("path").to_pylist():
                store, path = fs.FileSystem.from_uri(uri)
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for offset, content in members(stream, uri):
                        r = parse_record(content, f"{uri}: record at {offset}") | {"path": uri, "offset": offset}
                        rows.append([r[k] for k in names])
                        held += len(r["payload"]) if with_payload else 100
                        if held >= 8 << 20:
                            yield out(rows)
                            rows, held = [], 0
                yield out(rows)
    return run


def mark_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, refers_to) of every page; refers_to is the page
    whose response holds the payload, or null for a response."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")).withColumn("key", F.sha2(F.encode("html", "UTF-8"), 256))
    narrow = rows.where((F.octet_length("html") >= min_bytes) & F.col("page_id").isNotNull()).select("page_id", "key")
    # one row per payload and task before the shuffle; payloads of one page drop out
    shared = narrow.groupBy("key").agg(F.max("page_id").alias("last"), F.min("page_id").alias("first")).where("first < last").select("key", "last")
    shared = written(shared, "shared-payloads")
    n = shared.count()
    out = rows.join(F.broadcast(shared) if n <= BROADCAST_REVISITS else shared, "key", "left")
    far = (F.octet_length("html") >= min_bytes) & (F.col("page_id") < F.col("last"))
    return out.select("page_id", "url", "html", F.when(far, F.col("last")).alias("refers_to"))


def write_warc(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the archives; returns the manifest (path, records)."""
    folder = folder or scratch(pages.sparkSession, "warc")
    return written(mark_revisits(pages, min_bytes).mapInArrow(_write(folder, archive_bytes), "path string, records long"), "manifest")


def read_warc(spark: SparkSession, paths: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the archives listed in ``paths`` (path)."""
    n = max(1, min(paths.count(), 100_000))
    kinds = ("path string, offset long, record_type string, record_id string, url string, date string, refers_to string, "
             "payload_bytes long, payload_digest string" + ", payload binary" * with_payload)
    return paths.select("path").repartition(n).mapInArrow(_read(with_payload), kinds)


def round_trip(pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write all pages, read them back: (page_id, payload_bytes,
    payload_digest, record_type, refers_to) from the archives."""
    records = read_warc(pages.sparkSession, write_warc(pages, folder, min_bytes), with_payload=False)

    def page(c: str):
        return F.regexp_extract(c, r"^<urn:x-page:(-?\d+)>$", 1).try_cast("long")

    return records.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))

"""WARC archives: record writer and splittable reader.

Writing: payload digests are grouped first (digests only, no pages), then every
page is written as one gzip member per record: the smallest page of a payload as
``response``, its repeats as ``revisit`` records that carry the payload's length
in the HTTP header and its digest, but no payload. A task attempt writes files
of its own name; the returned manifest lists those of the attempts that
succeeded, so a repeated task leaves no doubt and no half file is read.

Reading: files are cut into byte ranges. A task scans its range for the gzip
magic, takes a place for a record only if the member there decodes to a WARC
header, and owns exactly the records that start inside its range, reading past
the end for the last one.

Files are reached through ``pyarrow.fs`` under the shared folder, so any file
system it knows will do. Defined results: null html is an empty payload; null
url becomes ``about:blank``; null page_id is written as ``null`` and read back as
null (it never stands before a known id); rows that repeat a page_id are records
of their own, and of equal pages with equal ids one is the response; payloads
under ``min_payload`` bytes are always responses; an empty table gives an empty
manifest and no records.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealstream.session import unique_dir

MIN_PAYLOAD, FILE_BYTES, SPLIT_BYTES, LEVEL = 100, 64 << 20, 8 << 20, 4
_MAGIC = b"\x1f\x8b\x08"
_PREFIX = "urn:page:"


def classify(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """page_id, copy (number among equal rows), refers_to for pages whose payload repeats an earlier one."""
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    d = pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha2(body, 256).alias("digest")).filter(
        F.octet_length(body) >= min_payload)
    first = d.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1").select("digest", "refers_to")
    return d.join(first, "digest").select("page_id", "digest", "refers_to").distinct()


def _record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{_PREFIX}{'null' if page_id is None else page_id}>", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~-._') if url else 'about:blank'}",
            f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{_PREFIX}{refers_to}>"]
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n") + z.flush()


def write_warc(pages: DataFrame, folder: str | None = None, min_payload: int = MIN_PAYLOAD, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write all pages; returns the manifest (path, n_bytes, n_records), written in the shared folder."""
    spark = pages.sparkSession
    folder = folder or unique_dir(spark, "llm", "warc")
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    p = p.withColumn("digest", F.sha2("html", 256))
    repeats = classify(pages, min_payload)
    later = repeats.filter("page_id != refers_to OR (page_id IS NULL AND refers_to IS NOT NULL)")
    rows = p.join(later.select(F.col("page_id").alias("id"), F.col("digest").alias("dg"), "refers_to"),
                  F.expr("page_id <=> id AND digest = dg"), "left").select("page_id", "url", "html", "digest", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = path = None
        size = n = 0

        def line() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"path": [path], "n_bytes": [size], "n_records": [n]},
                                              pa.schema([("path", pa.string()), ("n_bytes", pa.int64()), ("n_records", pa.int64())]))

        store, root = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        for batch in batches:
            for x in batch.to_pylist():
                if out is None:
                    store.create_dir(root, recursive=True)
                    path, size, n = f"{root}/part-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(path, compression=None, buffer_size=1 << 20)
                data = _record(x["page_id"], x["url"], x["html"].encode("utf-8", "replace"), x["digest"], x["refers_to"])
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= file_bytes:
                    out.close()
                    out = None
                    yield line()
        if out is not None:
            out.close()
            yield line()

    manifest = rows.mapInArrow(run, "path string, n_bytes long, n_records long")
    where = f"{folder.rstrip('/')}-manifest"
    manifest.write.parquet(where)
    return spark.read.schema("path string, n_bytes long, n_records long").parquet(where).withColumn("folder", F.lit(folder))


class _Window:
    """Bytes of a file from ``at`` on, read in pieces as they are needed."""

    def __init__(self, file, at: int, size: int, piece: int = 1 << 20):
        self.file, self.base, self.size, self.piece, self.data = file, at, size, piece, b""

    def need(self, upto: int) -> bool:
        """Have bytes up to absolute place ``upto`` in memory; False at the end of the file."""
        while self.base + len(self.data) < upto:
            at = self.base + len(self.data)
            got = self.file.read_at(min(self.piece, self.size - at), at) if at < self.size else b""
            if not got:
                return False
            self.data += got
        return True

    def drop(self, upto: int) -> None:
        if upto - self.base >= self.piece:
            self.data = self.data[upto - self.base:]
            self.base = upto


def _header(w: _Window, at: int) -> bool:
    """Whether a gzip member that starts with a WARC header begins at ``at``."""
    w.need(at + 4096)
    try:
        return zlib.decompressobj(31).decompress(w.data[at - w.base:at - w.base + 4096], 64).startswith(b"WARC/1.")
    except zlib.error:
        return False


def _member(w: _Window, at: int) -> tuple[bytes, int]:
    """The member at ``at`` in full, and the place after it."""
    z, out = zlib.decompressobj(31), []
    while not z.eof:
        w.drop(at)  # what is read of a long record is not kept as bytes of the file too
        if not w.need(at + 1):
            raise ValueError("archive ends inside a record")
        piece = w.data[at - w.base:]
        out.append(z.decompress(piece))
        at += len(piece) - len(z.unused_data)
    return b"".join(out), at


def _parse(record: bytes) -> dict:
    head, _, block = record.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}
    block = block[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["warc-type"]
    stated = re.search(rb"(?i)content-length:\s*(\d+)", http)
    digest = hashlib.sha256(payload).hexdigest() if kind == "response" else fields["warc-payload-digest"].split(":", 1)[1]

    def page(name: str):
        value = fields.get(name, "").strip("<>").removeprefix(_PREFIX)
        return int(value) if re.fullmatch(r"-?\d+", value) else None

    return {"page_id": page("warc-record-id"), "url": fields.get("warc-target-uri"), "record_type": kind,
            "payload_bytes": len(payload) if kind == "response" else int(stated[1]), "payload_digest": digest,
            "refers_to": page("warc-refers-to"), "payload": payload}


def records_in(file, size: int, start: int, end: int) -> Iterator[bytes]:
    """Records whose first byte lies in [start, end)."""
    w, at, sure = _Window(file, start, size), start, False
    while at < end:
        if not sure:
            w.drop(at)
            if not w.need(at + 1):
                return
            w.need(min(end, at + (1 << 20)) + len(_MAGIC))
            k = w.data.find(_MAGIC, at - w.base)
            if k < 0 or w.base + k >= end:
                nxt = max(at + 1, w.base + len(w.data) - len(_MAGIC) + 1)
                if nxt >= end or nxt >= size:
                    return
                at = nxt
                continue
            at = w.base + k
        if not _header(w, at):
            at, sure = at + 1, False
            continue
        data, at = _member(w, at)
        yield data
        w.drop(at)
        sure = w.need(at + 3) and w.data[at - w.base:at - w.base + 3] == _MAGIC


def read_warc(spark: SparkSession, manifest: DataFrame, split_bytes: int = SPLIT_BYTES, payload: bool = True) -> DataFrame:
    """One row per record of the files in ``manifest`` (folder, path, n_bytes): page_id, url, record_type,
    payload_bytes, payload_digest, refers_to and, if asked for, payload. Ranges are dealt out evenly."""
    splits = manifest.select("folder", "path", "n_bytes", F.explode(F.expr(f"sequence(0L, n_bytes - 1, {split_bytes}L)")).alias("start"))
    splits = splits.repartition(max(1, spark.sparkContext.defaultParallelism * 2), "path", "start")
    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long" + ", payload binary" * payload
    fields = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("refers_to", pa.int64())] + [("payload", pa.binary())] * payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.to_pylist():
                folder = x["folder"]
                store, _ = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
                rows, held = [], 0
                with store.open_input_file(x["path"]) as file:
                    for record in records_in(file, x["n_bytes"], x["start"], min(x["start"] + split_bytes, x["n_bytes"])):
                        r = _parse(record)
                        held += len(record) if payload else 512
                        rows.append(r if payload else {k: v for k, v in r.items() if k != "payload"})
                        if held >= 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, fields)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, fields)

    return splits.mapInArrow(run, schema)

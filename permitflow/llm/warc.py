"""Operator 3: WARC archives: parallel writer and splittable reader.

An archive is a run of gzip members, one for each record, as the format asks. The writer makes one archive for each
task, under a name of its own for each attempt, and returns a manifest that names only what the winning attempts wrote.

The reader deals archives out as byte ranges. A task looks in its range for the gzip magic, takes each hit as a
candidate and inflates it: a true member starts with a WARC header, holds exactly the bytes that its Content-Length
states and ends with the right CRC. A record belongs to the range that it starts in, wherever it ends; after a
member the next one is tried first, without a search. Payloads are hashed while they are inflated, so a record of
any length takes little memory unless its payload is asked for. (UTF-8 payloads cannot hold the magic, so no member
can stand inside another's stored block.)

Defined results: a null payload is empty; a null id or URL leaves its field out and reads back as null; control
characters and blanks in URLs are percent-escaped. Equal payloads with repeated or null ids: the least id is the
response, nulls last, then the first in the archives. Empty tables give no archive and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .batches import default_parallelism
from .storage import Scratch, ship

MAGIC = b"\x1f\x8b\x08"
DATE = "2024-01-01T00:00:00Z"
ID_FIELD = "Source-Row-Id"
_CHUNK = 1 << 20
_PIECE = 1 << 18  # inflated bytes that are held at a time


def _filesystem(uri: str):
    """(file system, path) of a URI that Arrow can open: local, HDFS, S3, GCS, ..."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def payload_digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(row_id, url: str | None, payload: bytes, digest: str | None = None) -> bytes:
    """One record as a gzip member: a response with its HTTP head and the payload."""
    digest = digest or payload_digest(payload)
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    fields = [("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{row_id} {url} {digest}')}>"),
              ("WARC-Date", DATE), ("WARC-Target-URI", None if url is None else quote(url, safe="!#$%&'()*+,-./:;=?@[]_~")),
              ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"),
              (ID_FIELD, row_id), ("Content-Length", len(block) + len(payload))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return b"".join([pack.compress(head.encode()), pack.compress(block), pack.compress(payload), pack.compress(b"\r\n\r\n"), pack.flush()])


def write_archives(pages: DataFrame, folder: str, scratch: Scratch, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html") -> DataFrame:
    """Write a record for each row; the manifest (path, records, bytes) of the archives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get()
        system, root = _filesystem(folder)
        system.create_dir(root, recursive=True)
        name = f"{part.partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        records = size = 0
        out = None
        try:
            for batch in batches:
                for row_id, url, payload in zip(*(c.to_pylist() for c in batch.columns)):
                    out = out or system.open_output_stream(f"{root}/{name}", compression=None)
                    data = record_bytes(row_id, url, (payload or "").encode("utf-8"))
                    out.write(data)
                    records, size = records + 1, size + len(data)
        finally:
            if out:
                out.close()
        if records:
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [records], "bytes": [size]})

    source = pages.select(F.col(id_col).cast("bigint"), F.col(url_col).cast("string"), F.col(payload_col).cast("string"))
    return scratch.write(source.mapInArrow(run, "path string, records bigint, bytes bigint"), "manifest")


def archives_in(spark: SparkSession, *paths: str) -> DataFrame:
    """A manifest (path, bytes) of archives that are already there; only their names and sizes are read."""
    return spark.read.format("binaryFile").load(list(paths)).select("path", F.col("length").alias("bytes"))


class _Window:
    """Forward reading of an open file round a position."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.data = file, size, 0, b""

    def get(self, start: int, length: int) -> bytes:
        end = min(start + length, self.size)
        if start < self.at or end > self.at + len(self.data):
            self.file.seek(start)
            self.data, self.at = self.file.read(max(end - start, min(_CHUNK, self.size - start))), start
        return self.data[start - self.at:end - self.at]


def _record(window: _Window, start: int, keep: bool) -> tuple[int, dict] | None:
    """(end, fields) of the record whose member starts at ``start``; None if no valid record does."""
    inflate, at = zlib.decompressobj(31), start
    head, rest, body = bytearray(), None, 0
    sha, http, payload, kept = hashlib.sha1(), bytearray(), 0, []
    fields: dict = {}
    try:
        while not inflate.eof:
            raw = inflate.unconsumed_tail
            if not raw:
                raw = window.get(at, 1 << 16)
                at += len(raw)
            data = inflate.decompress(raw, _PIECE)
            if not raw and not data and not inflate.eof:
                return None
            if rest is None:  # a head may have any length; other bytes than a record's are turned down at once
                seen = len(head)
                head += data
                if not head.startswith(b"WARC/"[:len(head)]):
                    return None
                cut = head.find(b"\r\n\r\n", max(0, seen - 3))
                if cut < 0:
                    continue
                lines = head[:cut].decode("utf-8").split("\r\n")[1:]
                fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
                rest = int(fields["content-length"])
                is_http = fields.get("content-type", "").startswith("application/http")
                data = bytes(head[cut + 4:])
            body += len(data)
            data = data[:max(0, rest - (body - len(data)))]
            if is_http and http is not None:
                seen = len(http)
                http += data
                cut = http.find(b"\r\n\r\n", max(0, seen - 3))
                if cut < 0:
                    continue
                data, http = bytes(http[cut + 4:]), None
            sha.update(data)
            payload += len(data)
            if keep:
                kept.append(data)
        at -= len(inflate.unused_data)
    except (zlib.error, UnicodeDecodeError, KeyError, ValueError):
        return None
    if rest is None or body != rest + 4:
        return None
    fields |= {"bytes": payload, "digest": base64.b32encode(sha.digest()).decode(), "payload": b"".join(kept) if keep else None}
    return at, fields


def read_records(archives: DataFrame, split_bytes: int = 8 << 20, keep_payload: bool = False) -> DataFrame:
    """Records of a manifest's (path, bytes) archives: path, offset, row_id, target_uri, warc_type, payload_bytes,
    payload_digest (computed), declared_digest and, if asked for, payload."""
    spark = archives.sparkSession
    ship(spark)
    kinds = [("path", pa.string()), ("offset", pa.int64()), ("row_id", pa.int64()), ("target_uri", pa.string()), ("warc_type", pa.string()),
             ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("declared_digest", pa.string()), ("payload", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns)):
                system, name = _filesystem(path)
                with system.open_input_file(name) as file:
                    window, at, end = _Window(file, size), start, min(start + split_bytes, size)
                    while at < end:
                        found = _record(window, at, keep_payload) if window.get(at, 3) == MAGIC else None
                        if found is None:  # look for the next candidate; a magic may straddle two chunks
                            chunk = window.get(at + 1, _CHUNK)
                            hit = chunk.find(MAGIC)
                            at = at + 1 + hit if hit >= 0 else at + max(1, len(chunk) - 2)
                            continue
                        after, f = found
                        row_id = f.get(ID_FIELD.lower())
                        rows.append((path, at, None if row_id is None else int(row_id), f.get("warc-target-uri"), f.get("warc-type"),
                                     f["bytes"], f["digest"], f.get("warc-payload-digest", "").removeprefix("sha1:") or None, f["payload"]))
                        held += f["bytes"] if keep_payload else 0
                        at = after
                        if len(rows) >= 1000 or held > 16 * _CHUNK:
                            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, (_, k) in zip(zip(*rows), kinds)], [n for n, _ in kinds])
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, (_, k) in zip(zip(*rows), kinds)], [n for n, _ in kinds])

    ranges = archives.filter("bytes > 0").select("path", "bytes", F.explode(F.expr(f"sequence(0L, bytes - 1, {split_bytes}L)")).alias("start"))
    schema = ("path string, offset bigint, row_id bigint, target_uri string, warc_type string, payload_bytes bigint, "
              "payload_digest string, declared_digest string, payload binary")
    out = ranges.repartition(default_parallelism(spark), "path", "start").mapInArrow(run, schema)
    return out if keep_payload else out.drop("payload")


def mark_revisits(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Adds record_type and refers_to: of equal payloads of at least ``least_bytes`` the least id is the response.

    ``records`` is a written table. Only payloads found twice or more are joined back, by digest and length.
    """
    key = ["payload_digest", "payload_bytes"]
    order = F.struct(F.col("row_id").isNull().alias("none"), "row_id", "path", "offset")
    groups = (records.filter(F.col("payload_bytes") >= least_bytes).groupBy(*key).agg(F.count("*").alias("k"), F.min(order).alias("first"))
              .filter("k > 1").drop("k"))
    revisit = F.col("first").isNotNull() & ~((F.col("first.path") == F.col("path")) & (F.col("first.offset") == F.col("offset")))
    return (records.join(groups, key, "left")
            .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(revisit, F.col("first.row_id"))).drop("first"))


def archive_pages(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to archives in the shared folder, read them back, mark the revisits.

    Fails if not as many records are read as the manifest says were written.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    manifest = write_archives(pages, scratch.path("archives"), scratch)
    records = scratch.write(read_records(manifest), "records")
    written, read = manifest.agg(F.sum("records")).first()[0] or 0, records.count()
    if read != written:
        raise RuntimeError(f"{read} records read of {written} written in {scratch.root}")
    return mark_revisits(records, least_bytes)

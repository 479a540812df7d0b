"""WARC archives: deduplicating writer and splittable reader.

The writer makes one gzip member per record, so archives can be read from any
byte on. Each task writes files of its own to the shared folder; the names
come back as rows and are fixed in a written table, so a repeated or lost task
leaves no record twice: files of attempts that did not count are not listed.

The reader deals byte ranges of the listed files to tasks. A task looks for
gzip magic from the start of its range, takes a candidate for a member only
if it decodes to a WARC header, and reads on past the range's end to complete
the last record that starts inside it. Memory holds one record and one buffer, so a
very long payload is held whole, once. An empty table writes no file and reads back as no row;
only the named columns are read, whatever others are called.
"""

from __future__ import annotations

import base64
import io
import os
import uuid
import zlib
from collections.abc import Iterable, Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.llm._util import rows, stage
from comptoir.session import new_subdir

MAGIC = b"\x1f\x8b\x08"
BUFFER = 1 << 20  # read at a time
STEP = 1 << 14  # decoded at a time
MIN_REVISIT = 1000  # shorter payloads are always written whole
SPLIT = 32 << 20
DATE = datetime(2024, 1, 1)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:page")


def open_shared(path: str, mode: str):
    """A file of the shared folder: local paths directly, others by pyarrow's file systems."""
    local = path[5:] if path.startswith("file:") else path
    if "://" not in local:
        local = "/" + local.lstrip("/") if path.startswith("file:") else local
        if "w" in mode:
            os.makedirs(os.path.dirname(local), exist_ok=True)
        return open(local, mode)
    from pyarrow import fs
    system, name = fs.FileSystem.from_uri(path)
    return system.open_output_stream(name, compression=None) if "w" in mode else system.open_input_file(name)


# -- writing --------------------------------------------------------------

def _line(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record_id(page: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, str(page))}>"


def record(page: object, uri: str | None, payload: bytes | None, size: int, sha1: str, refers_to: object, revisit: bool) -> bytes:
    """A gzip member with one response or revisit record of an HTML page."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page)),
            ("WARC-Date", DATE.strftime("%Y-%m-%dT%H:%M:%SZ")), ("WARC-Target-URI", _line(uri) if uri else f"urn:page:{page}"),
            ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()),
            ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if page is not None:
        head.append(("Page-ID", str(page)))
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to)), ("Refers-To-Page-ID", str(refers_to))]
    raw = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode("utf-8", "replace") + b"\r\n" + block + b"\r\n\r\n"
    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
    return gz.compress(raw) + gz.flush()


def revisits(pages: DataFrame, id_col: str, payload: str) -> DataFrame:
    """``id``, ``uri`` etc. of ``pages`` with ``size``, ``sha1`` and ``first``: the
    largest id among the records of an equal payload, where there are several."""
    d = pages.withColumn("_data", F.coalesce(F.col(payload).cast("binary"), F.lit(b"")))
    d = d.withColumn("size", F.octet_length("_data").cast("long")).withColumn("sha1", F.sha1("_data"))
    same = d.where(F.col("size") >= MIN_REVISIT).groupBy(F.col("sha1").alias("_sha1")).agg(F.max(id_col).alias("first"), F.count("*").alias("_n"))
    return d.join(same.where("_n > 1").drop("_n"), F.col("sha1") == F.col("_sha1"), "left").drop("_sha1")


def write(pages: DataFrame, folder: str, id_col: str = "page_id", uri: str = "url", payload: str = "html") -> DataFrame:
    """Write a record per row below ``folder``; returns the written table of
    (path, size, records).

    Null payloads are empty. Of records with equal payloads of ``MIN_REVISIT``
    bytes or more the largest id is the response and the others are revisits; rows
    that repeat the largest id are all responses, rows without an id revisits of it."""
    d = revisits(pages.select(F.col(id_col).alias("id"), F.col(uri).alias("uri"), F.col(payload).alias("payload")), "id", "payload")
    d = d.select("id", "uri", "_data", "size", "sha1", "first", (F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))).alias("revisit"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{folder}/part-{uuid.uuid4().hex}.warc.gz"
        out, size, n = None, 0, 0
        for b in rows(batches, 256):
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                out = out or open_shared(path, "wb")
                member = record(*r)
                out.write(member)
                size, n = size + len(member), n + 1
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "size": [size], "records": [n]})

    return stage(d.mapInArrow(run, "path string, size long, records long"), "warc-files")


# -- reading --------------------------------------------------------------

class Window:
    """The bytes of a file from a moving position on, read forward once."""

    def __init__(self, f, start: int):
        f.seek(start)
        self.f, self.base, self.data = f, start, b""

    def more(self) -> bool:
        data = self.f.read(BUFFER)
        self.data += data
        return bool(data)

    def forget(self, before: int) -> None:
        """Drop what lies before a position, now and then."""
        if before - self.base >= BUFFER:
            self.data, self.base = self.data[before - self.base:], before

    def find(self, start: int, end: int) -> int | None:
        """The first place in [start, end) with gzip magic."""
        while True:
            k = self.data.find(MAGIC, start - self.base)
            if k >= 0:
                return self.base + k if self.base + k < end else None
            start = max(start, self.base + len(self.data) - len(MAGIC) + 1)
            if start >= end or not self.more():
                return None
            self.forget(start)

    def member(self, start: int) -> tuple[bytes, int] | None:
        """The content and the end of the record member at ``start``; None if what
        stands there doesn't decode to a WARC header, or not to its end."""
        z, out, at = zlib.decompressobj(31), io.BytesIO(), start - self.base
        try:
            while not z.eof:
                piece = self.data[at:at + STEP]
                if not piece and not self.more():
                    return None
                out.write(z.decompress(piece))
                at += len(piece)
                if out.tell() >= 5 and out.getbuffer()[:5] != b"WARC/":
                    return None
        except zlib.error:
            return None
        return (out.getvalue(), self.base + at - len(z.unused_data)) if out.tell() >= 5 else None


def members(f, start: int, end: int) -> Iterator[bytes]:
    """The record members that start in [start, end)."""
    w, at = Window(f, start), start
    while (at := w.find(at, end)) is not None:
        found = w.member(at)
        if found is None:
            at += 1
            continue
        yield found[0]
        at = found[1]
        w.forget(at)
        if at >= end:
            return


def _headers(raw: bytes) -> list[tuple[str, str]]:
    out = []
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out.append((name.strip().lower(), value.strip()))
    return out


def parse(raw: bytes) -> Iterator[tuple[dict, dict, bytes]]:
    """(WARC headers, HTTP headers, payload) of each record in a member."""
    while raw.startswith(b"WARC/"):
        head, _, rest = raw.partition(b"\r\n\r\n")
        h = dict(_headers(head))
        n = int(h.get("content-length", 0))
        block, raw = rest[:n], rest[n:].lstrip(b"\r\n")
        http, payload = {}, block
        if h.get("content-type", "").startswith("application/http"):
            top, _, payload = block.partition(b"\r\n\r\n")
            http = dict(_headers(top))
        yield h, http, payload


def hex_digest(value: str | None) -> str | None:
    """Lower-case hex of a labelled digest in base 32 or hex."""
    name, _, d = (value or "").rpartition(":")
    if not d:
        return None
    return base64.b32decode(d).hex() if name.lower() == "sha1" and len(d) == 32 else d.lower()


RECORDS = "record_type string, record_id string, refers_to string, target_uri string, payload_digest string, headers map<string,string>, http_headers map<string,string>, payload binary"


def read(files: DataFrame, split_bytes: int = SPLIT) -> DataFrame:
    """The records of the archives listed in ``files`` (path, size): type, ids, URI,
    labelled payload digest as hex, headers (names lower-case) and the payload
    (empty for revisits)."""
    spans = files.where("size > 0").select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    spans = stage(spans.withColumn("end", F.col("start") + split_bytes), "warc-spans")
    n = spans.count()
    spans = spans.repartition(max(1, n), "path", "start") if n > 1 else spans

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(x, pa.string()) for x in ("record_type", "record_id", "refers_to", "target_uri", "payload_digest")]
                           + [("headers", pa.map_(pa.string(), pa.string())), ("http_headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])
        for b in batches:
            for path, start, end in zip(*(c.to_pylist() for c in b.columns), strict=True):
                with open_shared(path, "rb") as f:
                    held, size = [], 0
                    for raw in members(f, start, end):
                        for h, http, payload in parse(raw):
                            held.append((h.get("warc-type"), h.get("warc-record-id"), h.get("warc-refers-to"), h.get("warc-target-uri"),
                                         hex_digest(h.get("warc-payload-digest")), list(h.items()), list(http.items()), payload))
                            size += len(payload)
                        if len(held) >= 1000 or size >= 4 << 20:
                            yield _batch(held, schema)
                            held, size = [], 0
                    if held:
                        yield _batch(held, schema)

    return spans.mapInArrow(run, RECORDS)


def _batch(held: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


def archive_folder(spark: SparkSession) -> str:
    return new_subdir(spark, "warc")


def round_trip(pages: DataFrame, split_bytes: int = SPLIT, id_col: str = "page_id", uri: str = "url", payload: str = "html") -> DataFrame:
    """Write the archives, read them back, and tell per record what was read."""
    files = write(pages, archive_folder(pages.sparkSession), id_col, uri, payload)
    return read(files, split_bytes)

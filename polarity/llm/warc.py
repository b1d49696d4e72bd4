"""WARC archives of pages and a salvage reader (operator 7).

Tasks write gzip-per-record archives into the shared folder; a manifest,
committed with the stage, lists those that count.  The reader checks every
record; after a failed check it searches for the next valid gzip member or
version line, goes on from there, and logs the bytes in between as a gap.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polarity.llm.tables import written

ARCHIVE_BYTES = 16 << 20
LEAST_REVISIT = 1000
LEVEL = 4

# Fixed values of the format.
TYPES = ("warcinfo", "response", "resource", "request", "metadata", "revisit", "conversion", "continuation")
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
STAMP = "2024-01-01T00:00:00Z"

MANIFEST = "path string, records bigint, bytes bigint"
RECORDS = ("kind string, archive string, offset bigint, length bigint, problem string, page_id bigint, uri string, "
           "record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary")


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system that tasks reach under a Spark path."""
    scheme, colon, rest = uri.partition(":")
    if not colon:
        return fs.LocalFileSystem(), uri
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    if scheme == "file":
        rest = "//" + "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{scheme}:{rest}")


def with_types(pages: DataFrame) -> DataFrame:
    """(page_id, uri, digest, size, refers_to, payload) of every page.

    Of pages with equal payloads of at least 1000 bytes the largest page_id
    is the response and the others refer to it, with no payload of their own.
    Repeated rows of that page_id are all responses.  Null html is empty.
    """
    html = F.coalesce(pages["html"].cast("string"), F.lit(""))
    base = pages.select(pages["page_id"].cast("bigint").alias("page_id"), pages["url"].cast("string").alias("uri"),
                        F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).cast("bigint").alias("size"),
                        html.alias("html"))
    shared = (base.filter(F.col("size") >= LEAST_REVISIT)
              .groupBy(F.col("digest").alias("d"), F.col("size").alias("s"))
              .agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    first = F.col("last").isNull() | F.col("page_id").eqNullSafe(F.col("last"))
    return (base.join(shared, (F.col("digest") == F.col("d")) & (F.col("size") == F.col("s")), "left")
            .select("page_id", "uri", "digest", "size", F.when(~first, F.col("last")).alias("refers_to"),
                    F.when(first, F.col("html")).alias("payload")))


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one record per page; returns the manifest (written, so done).

    Every attempt of a task writes files of its own names, and only those of
    the attempt that ended well are in the manifest: a lost executor leaves
    strays, never doubles."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(folder)
        store.create_dir(root, recursive=True)
        task = TaskContext.get()
        name = f"{root}/pages-{task.partitionId():05d}-{task.taskAttemptId()}"
        out, path, done = None, "", []
        for batch in batches:
            for row in batch.to_pylist():
                if out is not None and size >= archive_bytes:
                    out.close()
                    done.append((path, records, size))
                    out = None
                if out is None:
                    path = f"{name}-{len(done):04d}.warc.gz"
                    out, records = store.open_output_stream(path, compression=None), 0
                    size = _put(out, _member(_info()))
                size += _put(out, _member(_record(row)))
                records += 1
        if out is not None:
            out.close()
            done.append((path, records, size))
        prefix = folder[:len(folder) - len(root)] if folder.endswith(root) else ""
        yield pa.RecordBatch.from_arrays(
            [pa.array([prefix + d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()),
             pa.array([d[2] for d in done], pa.int64())], names=["path", "records", "bytes"])

    return written(with_types(pages).mapInArrow(write, MANIFEST))


def _put(out, data: bytes) -> int:
    out.write(data)
    return len(data)


def _member(record: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def _assembled(head: list[tuple[str, str]], block: bytes) -> bytes:
    head = [*head, ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode()
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def _info() -> bytes:
    return _assembled([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:x-archive:info>"), ("WARC-Date", STAMP),
                       ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")


def _record(row: dict) -> bytes:
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", row["uri"] or f"urn:x-page:{row['page_id']}")
    head = [("WARC-Type", "response" if row["payload"] is not None else "revisit"),
            ("WARC-Record-ID", f"<urn:x-page:{row['page_id']}>"), ("WARC-Date", STAMP), ("WARC-Target-URI", uri),
            ("WARC-Payload-Digest", f"sha1:{row['digest']}"), ("X-Payload-Length", str(row["size"])),
            ("Content-Type", "application/http; msgtype=response")]
    answer = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['size']}\r\n\r\n".encode()
    if row["payload"] is None:
        head += [("WARC-Refers-To", f"<urn:x-page:{row['refers_to']}>"), ("WARC-Profile", PROFILE)]
        return _assembled(head, answer)
    return _assembled(head, answer + row["payload"].encode())


def read_archives(spark: SparkSession, paths: list[str], with_payload: bool = False) -> DataFrame:
    """Records and gaps of the archives.

    kind ``record``: its place, type, page, payload length and digest (of the
    full payload, for revisits too).  kind ``gap``: a run of bytes that no
    valid record holds, with the first problem met there.  warcinfo records
    are checked and left out.  No archives: an empty result."""
    if not paths:
        return spark.createDataFrame([], RECORDS)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                archive = batch.column(0)[i].as_py()
                content = batch.column(1)[i].as_buffer()
                rows = [dict(r, archive=archive) for r in salvage(content, with_payload)]
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema([(n, {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[t])
                        for n, t in (c.split() for c in RECORDS.split(", "))])
    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInArrow(read, RECORDS)


class Broken(Exception):
    """A check failed."""


def salvage(data: bytes | memoryview, with_payload: bool = False) -> Iterator[dict]:
    """Records of one archive in order, and the gaps between them."""
    data = memoryview(data).cast("B")
    at, gap, problem = 0, None, ""
    while at < len(data):
        try:
            parts, end = _unit(data, at)
        except Broken as why:
            if gap is None:
                gap, problem = at, str(why)
            at = _next_start(data, at + 1)
            continue
        if gap is not None:
            yield _gap(gap, at, problem)
            gap = None
        for head, block in parts:
            if head["warc-type"] in ("response", "revisit"):
                yield _row(head, block, at, end - at, with_payload)
        at = end
    if gap is not None:
        yield _gap(gap, len(data), problem)


START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")


def _next_start(data: memoryview, at: int) -> int:
    found = START.search(data, at)
    return found.start() if found else len(data)


def _unit(data: memoryview, at: int) -> tuple[list, int]:
    """The gzip member or plain record at ``at``, checked, and its end."""
    if data[at:at + 2] == b"\x1f\x8b":
        plain, end = _unzipped(data, at)
        parts, here = [], 0
        while here < len(plain):
            head, block, here = _parsed(memoryview(plain), here)
            parts.append((head, block))
        if not parts:
            raise Broken("empty member")
        return parts, end
    head, block, end = _parsed(data, at)
    return [(head, block)], end


def _unzipped(data: memoryview, at: int, step: int = 1 << 16) -> tuple[bytes, int]:
    unpacker, out, here = zlib.decompressobj(31), [], at
    try:
        while not unpacker.eof:
            if here >= len(data):
                raise Broken("member cut short")
            out.append(unpacker.decompress(data[here:here + step]))
            here = min(here + step, len(data))
    except zlib.error as why:
        raise Broken(f"bad member: {why}") from None
    return b"".join(out), here - len(unpacker.unused_data)


# An empty line ends a header; a version line before it starts another record.
HEAD_END = re.compile(rb"\r\n(?:\r\n|WARC/1\.[01]\r\n)")


def _parsed(data: memoryview, at: int) -> tuple[dict, memoryview, int]:
    """Header fields (lower-case names) and block of the record at ``at``."""
    if not re.match(rb"WARC/1\.[01]\r\n", data[at:at + 10]):
        raise Broken("no version line")
    found = HEAD_END.search(data, at)
    if not found or found.group() != b"\r\n\r\n":
        raise Broken("header without end")
    top, stop = bytes(data[at:found.start()]), found.start() - at
    head = {}
    for line in top.split(b"\r\n")[1:]:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon:
            raise Broken("header line without colon")
        head[name.strip().lower()] = value.strip()
    size = head.get("content-length", "")
    if not size.isdigit() or head.get("warc-type") not in TYPES:
        raise Broken("header lacks a length or a known type")
    begin = at + stop + 4
    block = data[begin:begin + int(size)]
    end = begin + int(size) + 4
    if len(block) < int(size) or data[end - 4:end] != b"\r\n\r\n":
        raise Broken("block of wrong length")
    said = head.get("warc-block-digest", "")
    if said and said != f"sha1:{hashlib.sha1(block).hexdigest()}":
        raise Broken("block digest differs")
    return head, block, end


def _row(head: dict, block: memoryview, at: int, length: int, with_payload: bool) -> dict:
    body = bytes(block)
    body = body[body.find(b"\r\n\r\n") + 4:]
    response = head["warc-type"] == "response"
    return {"kind": "record", "offset": at, "length": length, "page_id": _page(head.get("warc-record-id", "")),
            "uri": head.get("warc-target-uri"), "record_type": head["warc-type"],
            "payload_bytes": len(body) if response else int(head.get("x-payload-length", 0)),
            "payload_digest": hashlib.sha1(body).hexdigest() if response
            else head.get("warc-payload-digest", "").removeprefix("sha1:"),
            "refers_to": _page(head.get("warc-refers-to", "")),
            "payload": body if response and with_payload else None}


def _page(urn: str) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?\d+)>", urn)
    return int(found[1]) if found else None


def _gap(at: int, end: int, problem: str) -> dict:
    return {"kind": "gap", "offset": at, "length": end - at, "problem": problem}

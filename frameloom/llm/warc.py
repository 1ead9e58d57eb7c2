"""WARC archives: a writer with revisit records and a sequential reader.

An archive holds one gzip member per record. The reader goes through it once, in blocks: each member is inflated
incrementally and in bounded steps, its header says how long the content block is, and digests are computed as the bytes pass.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hot_salt, salted_join, shared_dir, written

BLOCK = 1 << 18
#: An archive is closed once it is this long, so no reader task grows with the table.
ARCHIVE_BYTES = 8 << 20
DATE = "1970-01-01T00:00:00Z"


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One gzip member. A revisit's block has the HTTP header of the response it repeats, Content-Length included, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": (url or "").replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        "WARC-Block-Digest": _sha1(block),
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
    }
    if refers_to is not None:
        head |= {"WARC-Refers-To": f"<urn:page:{refers_to}>", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return gzip.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def plan_revisits(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = 1000) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): of pages with equal payloads of at least `least` bytes, all but the largest page_id refer to that one.

    Only (digest, page_id) of repeated payloads are aggregated; a payload that many pages share is spread by salting.
    Null payloads are empty; a page without an id is never referred to; repeated rows of the largest page_id are all responses.
    """
    data: Column = F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("payload"), F.sha1(data).alias("digest"), F.octet_length(data).alias("_n"))
    long = rows.where(F.col("_n") >= least).select("page_id", "digest")
    last = long.groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("_c")).where("_c > 1").select("digest", "last")
    joined = salted_join(rows, last, "digest", hot_salt(long, "digest"), F.struct("page_id", "url"), "left")
    repeats = (F.col("_n") >= least) & F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return joined.select("page_id", "url", "payload", "digest", F.when(repeats, F.col("last")).alias("refers_to"))


def write_archives(plan: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the records of plan_revisits() under folder (a URI that pyarrow opens) and returns (path, records, bytes) of each archive.

    A task that runs again writes files of other names; only those of the attempt that counted are in the result, which is a written table.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, top = _open(folder)
        store.create_dir(top, recursive=True)
        out, name, n, size = None, "", 0, 0
        for b in batches:
            for r in b.itertuples(index=False):
                if out is None:
                    name, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{top}/{name}", compression=None)
                data = record(None if pd.isna(r.page_id) else int(r.page_id), r.url, r.payload.encode(), r.digest, None if pd.isna(r.refers_to) else int(r.refers_to))
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= archive_bytes:
                    out.close()
                    out = None
                    yield pd.DataFrame([(f"{folder}/{name}", n, size)], columns=["path", "records", "bytes"])
        if out is not None:
            out.close()
            yield pd.DataFrame([(f"{folder}/{name}", n, size)], columns=["path", "records", "bytes"])

    text = plan.withColumn("page_id", F.col("page_id").cast("string")).withColumn("refers_to", F.col("refers_to").cast("string"))
    return written(text.mapInPandas(write, "path string, records long, bytes long"), "archives")


def inflated(stream) -> Iterator[tuple[bytes, bool]]:
    """(bytes, whether the gzip member ends here) of a stream that is read in blocks; no more than BLOCK bytes are inflated at once. A cut or damaged member raises."""
    inflate, data, begun = zlib.decompressobj(31), b"", False
    while True:
        data = data or stream.read(BLOCK)
        if not data:
            if begun:
                raise EOFError("the last gzip member is cut")
            return
        out, begun = inflate.decompress(data, BLOCK), True
        data = inflate.unconsumed_tail
        if inflate.eof:
            data, inflate, begun = inflate.unused_data, zlib.decompressobj(31), False
            yield out, True
        else:
            yield out, False


def _fields(lines: list[str]) -> dict[str, str]:
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}


def records(stream) -> Iterator[dict]:
    """Header fields (lower-case names), payload and payload_bytes of each record: one a gzip member, framed by Content-Length and checked against its digests as its bytes pass."""
    head, fields, left, block, tail, payload, check, own = b"", None, 0, None, b"", [], None, b""
    for data, end in inflated(stream):
        if fields is None:
            head += data
            at = head.find(b"\r\n\r\n")
            if at < 0 and not end:
                continue
            version, *lines = head[: max(at, 0)].decode().split("\r\n")
            if not version.startswith("WARC/"):
                raise ValueError("not a WARC record")
            fields, data, head = _fields(lines), head[at + 4 :], b""
            left, block, check, own, tail, payload = int(fields["content-length"]), hashlib.sha1(), hashlib.sha1(), b"", b"", []
            http = None
        part, data = data[:left], data[left:]
        left -= len(part)
        block.update(part)
        tail += data
        if http is None:  # the content block's own header
            own += part
            at = own.find(b"\r\n\r\n")
            if at >= 0:
                http, part = _fields(own[:at].decode("utf-8", "replace").split("\r\n")[1:]), own[at + 4 :]
        if http is not None:
            check.update(part)
            payload.append(part)
        if end:
            if left or tail != b"\r\n\r\n":
                raise ValueError("the content block is not as long as its header says")
            name = lambda h: "sha1:" + base64.b32encode(h.digest()).decode()
            if fields.get("warc-block-digest", name(block)) != name(block):
                raise ValueError("block digest differs")
            if fields["warc-type"] == "response" and fields.get("warc-payload-digest", name(check)) != name(check):
                raise ValueError("payload digest differs")
            size = sum(map(len, payload))
            yield fields | {"payload": b"".join(payload), "payload_bytes": int((http or {}).get("content-length", size))}
            fields = None


def read_archives(archives: DataFrame, tasks: int | None = None) -> DataFrame:
    """(page_id, url, record_type, payload, payload_bytes, payload_digest in hex, refers_to) of every record of archives' paths. Each archive is read by one task, in order."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = lambda v: v[len("<urn:page:") : -1] or None
        for b in batches:
            for path in b["path"]:
                store, at = _open(path)
                rows, size = [], 0
                with store.open_input_stream(at, compression=None) as stream:
                    for f in records(stream):
                        refers = f.get("warc-refers-to")
                        rows.append((number(f["warc-record-id"]), f["warc-target-uri"], f["warc-type"], f["payload"], f["payload_bytes"], base64.b32decode(f["warc-payload-digest"][5:]).hex(), refers and number(refers)))
                        size += len(f["payload"]) + 500
                        if size >= 16 * BLOCK:
                            yield pd.DataFrame(rows, columns=names)
                            rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    names = ["page_id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to"]
    spread = archives.select("path").repartition(tasks or max(1, archives.count()))
    out = spread.mapInPandas(read, "page_id string, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to string")
    return out.withColumn("page_id", F.col("page_id").cast("long")).withColumn("refers_to", F.col("refers_to").cast("long"))


def new_folder(spark) -> str:
    """A new folder for archives in the shared folder; a bare path gets the scheme that pyarrow asks for."""
    path = shared_dir(spark)
    if path.startswith("file:/") and not path.startswith("file://"):
        return "file://" + path[len("file:") :]
    return path if "://" in path else "file://" + os.path.abspath(path)

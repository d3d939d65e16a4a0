"""WARC archives with an index first: every record's file, offset, length, URL and digest.

Writing yields the index; reading selects index rows, sorts them by file and offset and reads neighbouring ranges at once.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.session import new_scratch, write_stage

#: Ranges that lie at most GAP bytes apart are read at once, up to READ bytes.
GAP, READ = 64 << 10, 8 << 20
#: Payload bytes of an archive file, about.
FILE_BYTES = 256 << 20
LEAST_REVISIT = 0

INDEX = "page_id long, url string, digest string, record_type string, file string, offset long, length long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"

_DATE = "2000-01-01T00:00:00Z"


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(text: str | None) -> str:
    """A header value on one line; control characters and non-ASCII bytes as percent escapes."""
    from urllib.parse import quote

    return quote(text or "", safe="".join(chr(c) for c in range(0x21, 0x7F) if c != 0x25))


def _record(page_id: int | None, url: str | None, payload: bytes, winner: int | None) -> tuple[bytes, str, str]:
    """A record as a gzip member of its own, its digest and type. A revisit holds the HTTP head alone, with the full payload's length."""
    digest, kind = _digest(payload), "response" if winner is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if winner is not None else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {_DATE}", f"WARC-Target-URI: {_header(url)}",
        "Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha1:{digest}", f"X-Page-ID: {'' if page_id is None else page_id}",
    ]
    if winner is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_record_id(winner)}", f"X-Refers-To-Page: {winner}"]
    head.append(f"Content-Length: {len(block)}")
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(raw) + pack.flush(), digest, kind


def parse(raw: bytes) -> dict:
    """Fields of one record; raises if its payload does not have its digest."""
    stream = io.BytesIO(zlib.decompress(raw, 31))
    if not stream.readline().startswith(b"WARC/"):
        raise ValueError("no WARC record here")
    head = {}
    while (line := stream.readline().strip(b"\r\n")):
        name, _, value = line.decode().partition(": ")
        head[name] = value
    block = stream.read(int(head["Content-Length"]))
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and _digest(payload) != digest:
        raise ValueError(f"damaged payload of {head['WARC-Record-ID']}")
    number = lambda x: int(x) if x else None
    return {
        "page_id": number(head["X-Page-ID"]), "payload_bytes": sizes[0], "payload_digest": digest, "record_type": kind,
        "refers_to": number(head.get("X-Refers-To-Page")), "payload": payload if kind == "response" else None,
    }


def _store(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if ":/" in folder else f"file://{folder}")


def write_archives(pages: DataFrame, page_id: Column, url: Column, html: Column, folder: str | None = None, least: int = LEAST_REVISIT, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row and return the index (written beside the archives).

    The payload is the UTF-8 text, a null one empty. Of equal payloads of at least ``least`` bytes the row with the largest id is the response and
    the others revisit it; rows of equal id and payload are all responses if that id is the largest. Null ids rank lowest and only revisit.
    Each task attempt writes a file of its own name and the index lists the successful ones only, so lost executors leave unread files, not
    wrong rows. Duplicates are found by one aggregation and joined by digest; the split of a hot digest is the adaptive join's.
    ``folder`` must be shared by all executors, as the default is.
    """
    spark = pages.sparkSession
    folder = (folder or new_scratch(spark, "warc")).rstrip("/")
    rows = pages.select(page_id.cast("long").alias("page_id"), url.cast("string").alias("url"), F.coalesce(html.cast("string"), F.lit("")).alias("payload"))
    keyed = rows.withColumn("sha", F.sha1(F.col("payload").cast("binary")))
    twice = (
        keyed.where(F.octet_length("payload") >= least).groupBy("sha").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("winner")).where("n > 1 and winner is not null").select("sha", "winner")
    )
    marked = keyed.join(twice, "sha", "left").select("page_id", "url", "payload", F.when(~F.col("winner").eqNullSafe(F.col("page_id")), F.col("winner")).alias("winner"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        for batch in batches:
            index: list[tuple] = []
            for page, link, payload, winner in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if out is None or at >= file_bytes:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                raw, digest, kind = _record(page, link, payload.encode(), winner)
                out.write(raw)
                index.append((page, link, digest, kind, name, at, len(raw)))
                at += len(raw)
            if index:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*index, strict=True), _INDEX_TYPES, strict=True)], names=_INDEX_NAMES)
        if out is not None:
            out.close()

    index = write_stage(marked.mapInArrow(write, INDEX), "warc-index")
    return index.withColumn("file", F.concat(F.lit(f"{folder}/"), "file"))


_INDEX_NAMES = [x.split()[0] for x in INDEX.split(", ")]
_INDEX_TYPES = [{"long": pa.int64(), "string": pa.string()}[x.split()[1]] for x in INDEX.split(", ")]


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of some index rows: page_id, url, payload_bytes, payload_digest, record_type, refers_to and payload.

    Rows are dealt and sorted by file and offset; a task reads runs of near ranges at once (GAP, READ). payload is null for revisits, and for all unless asked
    for; every response is checked against its digest. A row listed twice is read twice; no rows, no records.
    """
    chosen = index.select("file", "offset", "length", "url")
    placed = chosen.repartitionByRange(F.col("file"), F.col("offset")).sortWithinPartitions("file", "offset")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, source = None, None
        for batch in batches:
            rows = list(zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True))
            low = 0
            while low < len(rows):
                file, start, length, _ = rows[low]
                high, stop = low + 1, start + length
                while high < len(rows) and rows[high][0] == file and rows[high][1] <= stop + GAP and rows[high][1] + rows[high][2] - start <= READ:
                    stop = max(stop, rows[high][1] + rows[high][2])
                    high += 1
                if opened != file:
                    if source is not None:
                        source.close()
                    store, path = _store(file)
                    opened, source = file, store.open_input_file(path)
                raw = memoryview(source.read_at(stop - start, start))
                found = [parse(raw[a - start: a - start + n]) | {"url": link} for _, a, n, link in rows[low:high]]
                if not payloads:
                    found = [x | {"payload": None} for x in found]
                yield pa.RecordBatch.from_pylist(found, schema=_RECORD_SCHEMA)
                low = high
        if source is not None:
            source.close()

    return placed.mapInArrow(read, RECORD)


_RECORD_SCHEMA = pa.schema([(x.split()[0], {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[x.split()[1]]) for x in RECORD.split(", ")])

"""WARC archives of captures, written and read back as one nested row per capture.

A capture is a request, a response and a metadata record. The response has a record id of its
own and the other two name it as ``WARC-Concurrent-To``; assembling joins them over that. Of
captures with equal payloads one keeps it, the rest become revisit records, which name the
payload's digest and the target that has it.

Archives are gzip files with one member per record, of bounded size, in the shared folder. The
manifest names those that finished tasks wrote; files of attempts that failed are never read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import attach, read_file, stored, write_file
from strata.scratch import scratch_path

# Bytes of records, before compression, after which a task starts its next archive.
ARCHIVE_BYTES = 16_000_000
FILES_A_TASK = 4
# Bytes given to a record's decompressor at once: a few at first, more for a long record.
_WINDOW, _LARGEST_WINDOW = 4 << 10, 1 << 20
CAPTURED_AT = "1970-01-01T00:00:00Z"

# Names that the format prescribes.
_VERSION = "WARC/1.1"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = (
    "record_id string, type string, concurrent_to string, target_uri string, "
    "payload_digest string, payload_bytes long, refers_to_uri string, fields string, "
    "payload binary"
)
_NAMES = [f.split()[0] for f in _RECORD.split(", ")]


# --- writing ----------------------------------------------------------------------------


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def record(kind: str, headers: dict[str, str], block: bytes) -> bytes:
    """One record as a gzip member."""
    lines = [_VERSION, f"WARC-Type: {kind}"]
    lines += [f"{k}: {v}" for k, v in headers.items() if v]
    lines.append(f"Content-Length: {len(block)}")
    whole = "\r\n".join(lines).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(whole) + packer.flush()


def capture_records(
    page_id: int | None, url: str | None, payload: bytes, original: str | None, revisit: bool
) -> list[bytes]:
    """Request, response or revisit, and metadata of one capture."""
    own, uri = f"<urn:uuid:{uuid.uuid4()}>", _uri(url)
    common = {"WARC-Date": CAPTURED_AT, "WARC-Target-URI": uri}
    host, path = re.match(r"(?:[a-z]+://)?([^/]*)(.*)", uri, re.S).groups()
    asked = f"GET {path or '/'} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()
    answered = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    answer = {
        **common,
        "WARC-Record-ID": own,
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}",
    }
    if revisit:
        answer |= {"WARC-Profile": _REVISIT, "WARC-Refers-To-Date": CAPTURED_AT}
        answer["WARC-Refers-To-Target-URI"] = _uri(original)
    fields = b"" if page_id is None else f"pageId: {page_id}\r\n".encode()
    return [
        record(
            "request",
            {
                **common,
                "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
                "WARC-Concurrent-To": own,
                "Content-Type": "application/http; msgtype=request",
            },
            asked,
        ),
        record(
            "revisit" if revisit else "response",
            answer,
            answered if revisit else answered + payload,
        ),
        record(
            "metadata",
            {
                **common,
                "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
                "WARC-Concurrent-To": own,
                "Content-Type": "application/warc-fields",
            },
            fields,
        ),
    ]


def _uri(url: str | None) -> str:
    """A header value: white space and control characters escaped."""
    return re.sub(
        r"[\x00-\x20\x7f-\x9f  ]",
        lambda m: "".join(f"%{b:02X}" for b in m[0].encode("utf-8")),
        url or "",
    )


def write_archives(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html); returns the manifest (path, captures).

    Of pages with equal payloads of at least ``min_bytes`` that of the smallest page_id is a
    response and the rest revisit it; all others are responses. A missing html is an empty
    payload. A page without page_id revisits if it can and is never what others revisit; pages
    that share page_id and payload are responses alike. A missing url is an empty target.
    """
    folder = scratch_path(pages.sparkSession, "archives")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("sha1"),
    )
    known = F.col("page_id").isNotNull()
    groups = rows.groupBy("sha1").agg(
        F.min(F.when(known, F.struct("page_id", "url"))).alias("first"),
        F.count("*").alias("_size"),
    )
    met = attach(rows, stored(groups, "payload-groups"), ["sha1"], ["page_id", "url"])
    enough = F.octet_length("payload") >= min_bytes
    later = F.col("first").isNotNull() & ~F.col("first.page_id").eqNullSafe(F.col("page_id"))
    met = met.select(
        "page_id",
        "url",
        "payload",
        F.col("first.url").alias("original"),
        (enough & later).alias("revisit"),
    )
    names = met.columns

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, size, captures = [], 0, 0
        for batch in batches:
            columns = [batch[c].to_pylist() for c in names]
            for page_id, url, body, original, revisit in zip(*columns, strict=True):
                members += capture_records(page_id, url, body, original, revisit)
                size += len(body) + 2000
                captures += 1
                if size >= ARCHIVE_BYTES:
                    yield _archive(folder, members, captures)
                    members, size, captures = [], 0, 0
        if members:
            yield _archive(folder, members, captures)

    return stored(met.mapInArrow(write, "path string, captures long"), "archive-manifest")


def _archive(folder: str, members: list[bytes], captures: int) -> pa.RecordBatch:
    path = write_file(folder, "captures.warc.gz", b"".join(members))
    return pa.RecordBatch.from_pylist([{"path": path, "captures": captures}])


# --- reading ----------------------------------------------------------------------------


def parse_records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a gzip file with one member per record."""
    view, at = memoryview(archive), 0
    while at < len(view):
        unpacker, parts, window = zlib.decompressobj(31), [], _WINDOW
        while not unpacker.eof:
            some = view[at : at + window]
            if not some:
                raise ValueError("a record breaks off")
            parts.append(unpacker.decompress(some))
            # What lies behind the member is copied by the decompressor, so windows are small.
            at += len(some) - len(unpacker.unused_data)
            window = min(2 * window, _LARGEST_WINDOW)
        whole = b"".join(parts)
        head, _, block = whole.partition(b"\r\n\r\n")
        version, *lines = head.decode("utf-8").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
        yield headers, block[: int(headers["content-length"])]


def _row(headers: dict[str, str], block: bytes, keep_payload: bool) -> dict:
    kind = headers["warc-type"]
    row = dict.fromkeys(_NAMES)
    row |= {
        "record_id": headers["warc-record-id"],
        "type": kind,
        "concurrent_to": headers.get("warc-concurrent-to"),
        "target_uri": headers.get("warc-target-uri"),
        "refers_to_uri": headers.get("warc-refers-to-target-uri"),
        "payload_digest": headers.get("warc-payload-digest", "").removeprefix("sha1:") or None,
    }
    if kind == "response":
        body = block.partition(b"\r\n\r\n")[2]
        row |= {"payload_bytes": len(body), "payload_digest": payload_digest(body)}
        row["payload"] = body if keep_payload else None
    elif kind == "metadata":
        row["fields"] = block.decode("utf-8")
    return row


def read_archives(manifest: DataFrame, keep_payload: bool = False) -> DataFrame:
    """Every record of the archives, digests and lengths taken from the payloads themselves."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, _ARROW[n]) for n in _NAMES])
        for batch in batches:
            for path in batch["path"].to_pylist():
                rows = []
                for headers, block in parse_records(read_file(path)):
                    rows.append(_row(headers, block, keep_payload))
                    if len(rows) >= (100 if keep_payload else 3000):
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    # A row of the manifest is little to move but much to read, so tasks go by number of files.
    tasks = -(-manifest.count() // FILES_A_TASK) or 1
    return manifest.select("path").repartition(tasks, "path").mapInArrow(read, _RECORD)


_ARROW = {n: pa.string() for n in _NAMES} | {"payload_bytes": pa.int64(), "payload": pa.binary()}


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: response or revisit, with its request and metadata.

    Requests and metadata find it by their concurrent-to identifier. A capture whose request or
    metadata is missing has null there; records that name no capture are left out.
    """

    def part(kind: str, *columns: str) -> DataFrame:
        return records.where(F.col("type") == kind).select(
            F.col("concurrent_to").alias("capture_id"), F.struct("record_id", *columns).alias(kind)
        )

    answers = records.where(F.col("type").isin("response", "revisit")).select(
        F.col("record_id").alias("capture_id"),
        F.struct(
            "type", "target_uri", "payload_digest", "payload_bytes", "refers_to_uri", "payload"
        ).alias("response"),
    )
    return answers.join(part("request", "target_uri"), "capture_id", "left").join(
        part("metadata", "fields"), "capture_id", "left"
    )


def captures(manifest: DataFrame) -> DataFrame:
    """Per page what the archives say: page_id, payload_bytes and payload_digest of the full
    payload, record_type, and for revisits the page_id of the response they refer to."""
    # Stored, as assembling looks at the records three times.
    nested = assemble(stored(read_archives(manifest), "records"))
    page_id = F.regexp_extract("metadata.fields", r"pageId: (-?\d+)", 1).try_cast("bigint")
    flat = nested.select(
        page_id.alias("page_id"),
        F.col("response.type").alias("record_type"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.payload_bytes").alias("own_bytes"),
    )
    flat = stored(flat, "captures")
    groups = flat.groupBy("payload_digest").agg(
        F.min(F.when(F.col("record_type") == "response", F.col("page_id"))).alias("first"),
        F.max("own_bytes").alias("full_bytes"),
        F.count("*").alias("_size"),
    )
    met = attach(flat, stored(groups, "captured-payloads"), ["payload_digest"], ["page_id"])
    return met.select(
        "page_id",
        F.col("full_bytes").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        F.when(F.col("record_type") == "revisit", F.col("first")).alias("refers_to"),
    )

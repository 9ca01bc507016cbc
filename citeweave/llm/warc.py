"""Web archives: write captures as WARC records, read them back, assemble transactions.

A capture is a response (or a revisit, when an equal payload is stored elsewhere), its request
and its metadata; the latter two name the first in WARC-Concurrent-To.  Each task writes one
file of gzip members, one per record, and reports it in a manifest; readers go by the manifest,
so files of lost tasks are never read.  Records are assembled by the identifier of their
capture with partial aggregates, so a capture with any number of records stays one small row.

Defined results: null html is an empty payload; payloads under 100 bytes are always responses;
rows that repeat the smallest page_id of a payload are responses too; null url and page_id come
back null; records without a capture are left out of transactions; of several requests or
metadata records of a capture the one with the smallest identifier is shown, and their number.
An empty table gives no files and no captures.  Other columns are left out.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.llm.files import new_folder, new_name, opened
from citeweave.llm.words import binary, slices
from citeweave.session import materialize

#: Smaller payloads are stored again rather than referred to.
MIN_REVISIT = 100
DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "folder string, name string, n_records long"
_RECORD = (
    "kind string, record_id string, concurrent_to string, target_uri string, date string, "
    "payload_digest string, payload_bytes long, page_id long, block binary"
)


def record_bytes(kind: str, record_id: str, headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record as a gzip member."""
    named = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", DATE), *headers, ("Content-Length", str(len(block)))]
    lines = "".join(f"{name}: {_one_line(value)}\r\n" for name, value in named if value is not None)
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    whole = b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"
    return packer.compress(whole) + packer.flush()


def _one_line(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def capture_bytes(page_id: int | None, url: str | None, html: bytes | None, digest: str, first: int | None) -> bytes:
    """The three records of a capture; a revisit if `first` is another page."""
    payload, response_id = html or b"", _new_id()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    about = [("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if first is None or first == page_id:
        main = record_bytes("response", response_id, about, http + payload)
    else:
        main = record_bytes("revisit", response_id, [*about, ("WARC-Profile", _PROFILE)], http)
    near = [("WARC-Concurrent-To", response_id), ("WARC-Target-URI", url)]
    host, _, path = (url or "").partition("://")[2].partition("/")
    get = f"GET /{_one_line(path)} HTTP/1.1\r\nHost: {_one_line(host)}\r\n\r\n".encode()
    fields = b"" if page_id is None else f"page_id: {page_id}\r\n".encode()
    return b"".join(
        [
            main,
            record_bytes("request", _new_id(), [*near, ("Content-Type", "application/http; msgtype=request")], get),
            record_bytes("metadata", _new_id(), [*near, ("Content-Type", "application/warc-fields")], fields),
        ]
    )


def _new_id() -> str:
    return f"<urn:uuid:{uuid.uuid4()}>"


def read_records(source: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a file of gzip members, one record in memory at a time."""
    rest = b""
    while rest or (rest := source.read(1 << 20)):
        member, parts = zlib.decompressobj(31), []
        while not member.eof:
            parts.append(member.decompress(rest))
            rest = member.unused_data if member.eof else source.read(1 << 20)
            if not member.eof and not rest:
                raise ValueError("the archive ends inside a record")
        head, _, after = b"".join(parts).partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")[1:]
        headers = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines)}
        yield headers, after[: int(headers["content-length"])]


def write_archives(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write three records per page (page_id, url, html); the manifest of the files."""
    place = folder or new_folder(pages.sparkSession, "warc")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    hashed = pages.select("page_id", "url", "html", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("size"))
    equal = (
        hashed.where(F.col("size") >= MIN_REVISIT)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_page"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "first_page")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = opened(place)
        sink, n, name = None, 0, ""
        for batch in slices(batches, "html"):
            if sink is None:
                system.create_dir(path, recursive=True)
                name = new_name(TaskContext.get().partitionId(), ".warc.gz")
                sink = system.open_output_stream(f"{path}/{name}", compression=None)
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url")]
            others = [batch.column(c).to_pylist() for c in ("digest", "first_page")]
            for row in zip(*columns, binary(batch.column("html")), *others, strict=True):
                sink.write(capture_bytes(*row))
                n += 3
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_pydict({"folder": [place], "name": [name], "n_records": [n]})

    captures = hashed.join(equal, "digest", "left").select("page_id", "url", "html", "digest", "first_page")
    return materialize(captures.mapInArrow(write, _MANIFEST), "warc-manifest")


def read_archives(manifest: DataFrame, with_blocks: bool = False) -> DataFrame:
    """A row per record of the manifest's files, a file per task.

    `payload_bytes` and `payload_digest` of a response are taken from its payload, which must
    bear out the digest in its header; a revisit has the digest of its header.  `block` is null
    unless asked for.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = opened(row["folder"])
                with system.open_input_stream(f"{path}/{row['name']}", compression=None) as source:
                    yield from _batched(source)

    def _batched(source: BinaryIO) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for headers, block in read_records(source):
            rows.append(_row(headers, block, with_blocks))
            size += 500 + len(block) * with_blocks
            if size > 8 << 20:
                yield pa.RecordBatch.from_pylist(rows, schema=_record_schema())
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_record_schema())

    return manifest.select("folder", "name").repartition(max(1, manifest.count())).mapInArrow(read, _RECORD)


def _record_schema() -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in _RECORD.split(", "))])


def _row(headers: dict[str, str], block: bytes, with_block: bool) -> dict:
    kind = headers["warc-type"]
    row = {
        "kind": kind,
        "record_id": headers["warc-record-id"],
        "concurrent_to": headers.get("warc-concurrent-to"),
        "target_uri": headers.get("warc-target-uri"),
        "date": headers.get("warc-date"),
        "payload_digest": headers.get("warc-payload-digest", "").removeprefix("sha256:") or None,
        "block": block if with_block else None,
    }
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        found = hashlib.sha256(payload).hexdigest()
        if found != row["payload_digest"]:
            raise ValueError(f"{row['record_id']}: the payload doesn't bear out its digest")
        row["payload_bytes"] = len(payload)
    elif kind == "metadata":
        fields = dict(line.split(": ", 1) for line in block.decode().split("\r\n") if ": " in line)
        row["page_id"] = int(fields["page_id"]) if "page_id" in fields else None
    return row


def transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: (capture_id, capture, request, metadata, n_requests, n_metadata).

    `capture` is the response or revisit; request and metadata records find it through their
    concurrent-to identifiers.
    """
    shown = ("record_id", "kind", "target_uri", "date", "payload_digest", "payload_bytes", "page_id", "block")

    def of(*kinds: str) -> Column:
        return F.when(F.col("kind").isin(*kinds), F.struct(*shown))

    grouped = records.groupBy(F.coalesce("concurrent_to", "record_id").alias("capture_id")).agg(
        F.min(of("response", "revisit")).alias("capture"),
        F.min(of("request")).alias("request"),
        F.min(of("metadata")).alias("metadata"),
        F.count_if(F.col("kind") == "request").alias("n_requests"),
        F.count_if(F.col("kind") == "metadata").alias("n_metadata"),
    )
    return grouped.where("capture IS NOT NULL")


def resolved(captures: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) with revisits resolved by digest."""
    flat = captures.select(
        F.col("metadata.page_id").alias("page_id"),
        F.col("capture.payload_bytes").alias("own_bytes"),
        F.col("capture.payload_digest").alias("payload_digest"),
        F.col("capture.kind").alias("record_type"),
    )
    stored = (
        flat.where("record_type = 'response'")
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("original"), F.max("own_bytes").alias("bytes"))
    )
    revisit = F.col("record_type") == "revisit"
    return flat.join(stored, "payload_digest", "left").select(
        "page_id",
        F.coalesce("own_bytes", "bytes").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        F.when(revisit, F.col("original")).alias("refers_to"),
    )

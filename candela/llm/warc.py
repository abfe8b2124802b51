"""Operator 5: web archives, written and assembled into one nested row per capture.

Writing: every page becomes a request record, a response record (or a revisit
record that refers to the response with the same payload) and a metadata record,
each in a gzip member of its own and tied together by ``WARC-Concurrent-To``.
Reading: records are parsed one at a time and joined through those identifiers.

Null payloads are empty ones. A null page id is written without an id and reads
back as null; it counts as smaller than any id. Rows that share both the payload
and its largest page id are all responses. An empty table writes no archive.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from candela.llm import text as tx

NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Copies of a payload are dealt over this many parts when they look up their response.
SALT = 16
READ_BYTES = 1 << 20


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(kind: str, key: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{kind}/{key}')}>"


def _member(kind: str, record_id: str, headers: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    """One record as one gzip member."""
    lines = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", DATE), *headers, ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(head.encode()) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def capture_members(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, serial: str, level: int = 1) -> list[bytes]:
    """The three records of a capture. ``refers_to``: the page whose response this one revisits, else None."""
    key = f"{serial}" if page_id is None else f"{page_id}/{serial}"
    target = [("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]"))] if url else []
    main, digest = _record_id("capture", key), digest32(payload)
    concurrent = ("WARC-Concurrent-To", main)
    host = (url or "").partition("://")[2].partition("/")[0]
    request = f"GET / HTTP/1.1\r\nHost: {quote(host)}\r\n\r\n".encode()
    described = [("WARC-Payload-Digest", f"sha1:{digest}")]
    status = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    if refers_to is None:
        kind, block, extra = "response", status + payload, []
    else:
        kind, block, extra = "revisit", status, [("WARC-Profile", REVISIT_PROFILE)]
    fields = [("payload-bytes", len(payload))] + ([("page-id", page_id)] if page_id is not None else []) + ([("refers-to-page", refers_to)] if refers_to is not None else [])
    notes = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return [
        _member("request", _record_id("request", key), [*target, concurrent, ("Content-Type", "application/http; msgtype=request")], request, level),
        _member(kind, main, [*target, *described, *extra, ("Content-Type", "application/http; msgtype=response")], block, level),
        _member("metadata", _record_id("metadata", key), [*target, concurrent, ("Content-Type", "application/warc-fields")], notes, level),
    ]


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """page_id, url, html and ``refers_to``: the largest page id with the same payload, null for that page itself.

    Only ids and digests meet: digests are pre-aggregated, and the copies of a
    payload look their response up in SALT parts.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"),
    )
    digests = rows.select("page_id", F.sha1(F.col("html").cast("binary")).alias("digest"), F.octet_length("html").alias("size")).where(F.col("size") >= min_bytes)
    shared = digests.groupBy("digest").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n")).where("n > 1")
    spread = shared.select("digest", "response", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    copies = digests.withColumn("salt", F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(SALT)).cast("int"))
    revisits = (
        copies.join(spread, ["digest", "salt"])
        .where("response is not null and (page_id is null or page_id < response)")
        .select(F.col("page_id").alias("id"), F.col("digest").alias("of"), F.col("response").alias("refers_to"))
        .distinct()
    )
    found = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    return found.join(revisits, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("of")), "left").select("page_id", "url", "html", "refers_to")


def write_archives(captures: DataFrame, folder: str, level: int = 1) -> list[tuple[str, int]]:
    """Writes one archive for each partition with rows; (file, captures) of each comes back.

    A file is written under another name and moved when whole, so a task that
    is run again or twice leaves one complete file.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        name, count, out = f"captures-{part:06d}.warc.gz", 0, None
        system, path = tx.open_folder(folder)
        hidden = f"{path}/{tx.temporary_name(name)}"
        for batch in batches:
            if out is None and batch.num_rows:
                out = system.open_output_stream(hidden, compression=None)
            ids, urls, refers = (batch.column(i).to_pylist() for i in (0, 1, 3))
            for page_id, url, html, target in zip(ids, urls, tx.binary(batch.column(2)), refers):
                for member in capture_members(page_id, url, html or b"", target, f"{part}.{count}", level):
                    out.write(member)
                count += 1
        if out is not None:
            out.close()
            system.move(hidden, f"{path}/{name}")
            yield pa.RecordBatch.from_pydict({"file": [name], "captures": [count]})

    return [(r.file, r.captures) for r in tx.map_arrow(captures, write, "file string, captures long").collect()]


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of each record; holds one record at a time."""
    rest = b""
    while True:
        unpack, parts = zlib.decompressobj(31), []
        while not unpack.eof:
            rest = rest or stream.read(READ_BYTES)
            if not rest:
                break
            parts.append(unpack.decompress(rest))
            rest = unpack.unused_data
        if not unpack.eof:
            if any(parts):
                raise ValueError("the archive ends within a record")
            return
        head, _, body = b"".join(parts).partition(b"\r\n\r\n")
        lines = head.decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        yield headers, body[: int(headers["content-length"])]


RECORD = "warc_type string, record_id string, capture string, uri string, digest string, size long, head string, payload binary"


def read_archives(spark: SparkSession, folder: str, files: list[tuple[str, int]]) -> DataFrame:
    """A row for each record of the archives; ``capture`` is the response's or revisit's identifier.

    A response's payload is checked against its digest; ``size`` is its length in bytes.
    """

    schema = tx.arrow_schema(RECORD)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = tx.open_folder(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with system.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for headers, block in read_records(stream):
                        http = headers.get("content-type", "").startswith("application/http")
                        head, _, payload = block.partition(b"\r\n\r\n") if http else (block, b"", b"")
                        held = headers["warc-type"] == "response"
                        digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
                        if held and digest and digest != digest32(payload):
                            raise ValueError(f"payload of {headers['warc-record-id']} does not match its digest")
                        rows.append({
                            "warc_type": headers["warc-type"],
                            "record_id": headers["warc-record-id"],
                            "capture": headers.get("warc-concurrent-to", headers["warc-record-id"]),
                            "uri": headers.get("warc-target-uri"),
                            "digest": digest,
                            "size": len(payload) if held else None,
                            "head": head.decode("utf-8", "replace"),
                            "payload": payload if held else None,
                        })
                        size += len(block)
                        if size > 8 * READ_BYTES or len(rows) >= 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return tx.map_arrow(tx.one_task_each(spark, files, "file string, captures long"), read, RECORD)


def assemble(records: DataFrame, payloads: bool = True) -> DataFrame:
    """One nested row per capture: request, response (or revisit) and metadata, joined by concurrent-to.

    Without ``payloads`` the bodies stay where they were read. A capture without a
    request or metadata record has null there; one without its response or
    revisit record still gives a row, with a null ``response``.
    """
    side = lambda kinds, *names: F.first(F.when(F.col("warc_type").isin(*kinds), F.struct(*names)), ignorenulls=True)
    body = ("payload",) if payloads else ()
    return records.groupBy("capture").agg(
        side(("request",), "record_id", "uri", "head").alias("request"),
        side(("response", "revisit"), "warc_type", "record_id", "uri", "digest", "size", "head", *body).alias("response"),
        side(("metadata",), "record_id", "head").alias("metadata"),
    )


def _note(name: str):
    return F.regexp_extract(F.col("metadata.head"), rf"(?m)^{name}: ([0-9-]+)\r?$", 1).try_cast("long")


def round_trip(pages: DataFrame, payloads: bool = True) -> DataFrame:
    """Pages to archives in the shared folder and back: one nested row per capture, with the metadata's fields."""
    spark = pages.sparkSession
    folder = tx.output_folder(spark, "warc")
    files = write_archives(with_revisits(pages), folder)
    captures = assemble(read_archives(spark, folder, files), payloads)
    return captures.select("*", _note("page-id").alias("page_id"), _note("refers-to-page").alias("refers_to"), F.coalesce("response.size", _note("payload-bytes")).alias("payload_bytes"))


def capture_report(pages: DataFrame) -> DataFrame:
    captures = round_trip(pages, payloads=False)
    return captures.select(
        "page_id",
        "payload_bytes",
        F.col("response.digest").alias("payload_digest"),
        F.col("response.warc_type").alias("record_type"),
        "refers_to",
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture_report(spark.read.parquet(f"{sf_dir}/pages.parquet"))

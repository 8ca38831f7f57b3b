"""WARC archives: a writer of gzip members and a splittable reader.

Writing: each task streams its rows into one ``.warc.gz`` file, one gzip member a record, on the shared storage that
the given folder lies on. File names carry the attempt, and the manifest, itself a table written by Spark, names
the files of the attempts that counted, so a retried or speculative task leaves nothing that is read. Of records
with equal payloads (by SHA-1) the one with the largest page_id is the response and the others are revisits
that refer to it; they keep the payload's digest and length but not its bytes. The equal payloads are found on
narrow rows (digest, page_id), with partial aggregation before the shuffle; pages move once, on page_id.

Reading: a file is cut into byte ranges. A task scans its range for the gzip magic, takes a position for a
member only if it inflates to a WARC header, and then follows the chain of members. It owns the records that start
inside its range and reads past its end to finish the last. A record is decoded alone, so memory is bounded by
the largest record.

Defined cases: null html is an empty payload; a null url leaves the target out. Pages without page_id cannot be
named and are left out; of rows that repeat a page_id the one with the largest (html, url) counts. Empty payloads are
equal to each other. Extra columns are ignored. An empty table gives no archive and an empty result.
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
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm.tables import shared_path

SPLIT_BYTES = 8 << 20
SCAN_BYTES = 1 << 18
MAX_TASKS = 20_000  # beyond that many ranges a task reads several
GZIP_LEVEL = 6
MAGIC = b"\x1f\x8b\x08"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
RECORD_SCHEMA = ("page_id bigint, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, "
                 "url string, file string, at bigint, intact boolean")


def _filesystem(uri: str):
    """(file system, path) of a URI or absolute path."""
    from pyarrow import fs

    if re.match(r"file:/(?!/)", uri):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def plan_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, digest, refers_to): refers_to is null for responses."""
    rows = pages.where(F.col("page_id").isNotNull()).select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).alias("html"))
    if rows.groupBy("page_id").count().where("count > 1").limit(1).count():
        rows = rows.groupBy("page_id").agg(F.max(F.struct("html", "url")).alias("r")).select("page_id", "r.url", "r.html")
    narrow = rows.where(F.octet_length("html") >= min_bytes).select("page_id", F.unhex(F.sha1("html")).alias("digest"))
    shared = (narrow.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
              .where("n > 1").drop("n"))
    revisits = (narrow.join(shared, "digest").where("page_id != refers_to").select("page_id", "refers_to"))
    return rows.join(revisits, "page_id", "left")


def record(page_id: int, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC record, not compressed."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.0", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%/:=&?~#+!$,;'@()*[]"))
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = GZIP_LEVEL) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write(pages: DataFrame, folder: str, min_bytes: int = 0, level: int = GZIP_LEVEL) -> DataFrame:
    """Write the pages as archives below ``folder``; returns the manifest (file, bytes, records)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _filesystem(folder)
        out, name, size, count = None, "", 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    task = TaskContext.get()
                    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}.warc.gz"
                    fs.create_dir(base, recursive=True)
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                data = member(record(row["page_id"], row["url"], row["html"].encode(), row["refers_to"]), level)
                out.write(data)
                size, count = size + len(data), count + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"file": f"{folder}/{name}", "bytes": size, "records": count}])

    spark = pages.sparkSession
    manifest = folder.rstrip("/") + "-manifest"
    plan_records(pages, min_bytes).mapInArrow(run, "file string, bytes bigint, records bigint").write.parquet(manifest)
    return spark.read.parquet(manifest)


def read(manifest: DataFrame, split_bytes: int = SPLIT_BYTES, payload: bool = True) -> DataFrame:
    """Records of the manifest's files (columns file, bytes), read by byte ranges; ``html`` with ``payload``."""
    splits = manifest.where("bytes > 0").select(
        "file", "bytes", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(split_bytes))).alias("first"))
    splits = splits.withColumn("last", F.least(F.col("first") + split_bytes, F.col("bytes")))
    # A range is a row of a few bytes, so adaptive execution would merge them all: the number of tasks is given.
    ranges = manifest.where("bytes > 0").agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0]
    splits = splits.repartitionByRange(max(1, min(int(ranges or 0), MAX_TASKS)), "file", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in batch.to_pylist():
                rows, weight = [], 0
                for at, data in members(s["file"], s["first"], s["last"], s["bytes"]):
                    row, body = parse(data)
                    rows.append(row | {"file": s["file"], "at": at} | ({"html": body} if payload else {}))
                    weight += len(body) if payload else 200
                    if weight > SPLIT_BYTES:
                        yield _batch(rows, payload)
                        rows, weight = [], 0
                if rows:
                    yield _batch(rows, payload)

    return splits.mapInArrow(run, RECORD_SCHEMA + (", html string" if payload else ""))


_FIELDS = [("page_id", pa.int64()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
           ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("file", pa.string()),
           ("at", pa.int64()), ("intact", pa.bool_())]


def _batch(rows: list[dict], payload: bool) -> pa.RecordBatch:
    rows = [r | {"html": r["html"].decode("utf-8", "replace")} for r in rows] if payload else rows
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(_FIELDS + [("html", pa.string())] * payload))


def inflate(source, at: int, size: int) -> tuple[bytes, int] | None:
    """(content, end) of the gzip member at ``at`` if it is a whole member holding a WARC record, else None."""
    unpacker, out, pos, checked = zlib.decompressobj(31), [], at, False
    try:
        while not unpacker.eof:
            source.seek(pos)
            raw = source.read(min(SCAN_BYTES, size - pos))
            if not raw:
                return None
            out.append(unpacker.decompress(raw))
            pos += len(raw)
            if not checked and sum(map(len, out)) >= 8:
                if not b"".join(out).startswith(b"WARC/1."):
                    return None
                checked = True
    except zlib.error:
        return None
    return (b"".join(out), pos - len(unpacker.unused_data)) if checked else None


def members(uri: str, first: int, last: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of the records that start in [first, last) of the file."""
    fs, path = _filesystem(uri)
    with fs.open_input_file(path) as source:
        at = first
        while at < last:
            source.seek(at)
            # the magic may cross the end of what is scanned, so two more bytes are read
            raw = source.read(min(SCAN_BYTES, last - at) + 2)
            found = raw.find(MAGIC)
            if found < 0 or at + found >= last:
                at += max(len(raw) - 2, 1)
                continue
            got = inflate(source, at + found, size)
            if got is None:
                at += found + 1
            else:
                yield at + found, got[0]
                at = got[1]


def parse(data: bytes) -> tuple[dict, bytes]:
    """Result columns and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    whole = fields["WARC-Type"] == "response"
    page = lambda name: int(re.fullmatch(r"<urn:page:(-?\d+)>", fields[name])[1])
    found = base64.b32encode(hashlib.sha1(payload).digest()).decode() if whole else stated
    return {
        "page_id": page("WARC-Record-ID"), "record_type": fields["WARC-Type"],
        "payload_bytes": len(payload) if whole else length, "payload_digest": found,
        "refers_to": page("WARC-Refers-To") if "WARC-Refers-To" in fields else None,
        "url": fields.get("WARC-Target-URI"), "intact": not whole or (found == stated and len(payload) == length),
    }, payload


def round_trip(pages: DataFrame, spark: SparkSession, min_bytes: int = 0, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of the pages' archives, written to a shared folder and read back."""
    manifest = write(pages, shared_path(spark, "warc"), min_bytes)
    return read(manifest, split_bytes, payload=False)

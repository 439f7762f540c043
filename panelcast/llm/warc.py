"""WARC archives of gzip members: deduplicating writer and splittable reader.

Files are opened with pyarrow's file systems (file, hdfs, s3, gs, abfs), in the tasks only. An
archive lies in the folder that all executors share.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAGIC = b"\x1f\x8b\x08"
BLOCK = 1 << 20  # bytes read at a time
FEED = 1 << 16  # bytes given to the decoder at a time
SPLIT_BYTES = 32 << 20
MAX_TASKS = 50_000  # splits share tasks beyond this
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # pages carry no time of capture
_PREFIX = 0x70616E656C63  # first 48 bits of the record ids made here
_LOW = (1 << 62) - 1


def record_uuid(page_id: int | None, digest: bytes = b"") -> str:
    """A record id from which the page id can be read back; without one, from the digest."""
    value = int.from_bytes(digest[:8], "big") if page_id is None else page_id & (1 << 64) - 1
    own = 0x800 if page_id is None else 0
    high = _PREFIX << 16 | 0x8000 | own | value >> 62
    return str(uuid.UUID(int=high << 64 | 2 << 62 | value & _LOW))


def page_of(record_id: str | None) -> int | None:
    """The page id in a record id; None for another's id or a page without one."""
    found = re.search(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", record_id or "")
    value = uuid.UUID(found[0]).int if found else 0
    if value >> 80 != _PREFIX or value >> 64 & 0x800:
        return None
    page = (value >> 64 & 3) << 62 | value & _LOW
    return page - (1 << 64) if page >> 63 else page


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


def first_of_equal(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, sha1, refers_to): refers_to is the smallest page_id with the same payload.

    It is null for that page itself and its repeated rows, for payloads under ``min_bytes`` and for
    rows without page_id. Null html is an empty payload. Digests are grouped with partial sums, and
    the join's partitions can be split, so a payload of a third of all rows is no single task.
    """
    own = pages.select(
        F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html")
    ).withColumn("sha1", F.sha1("html"))
    first = own.groupBy("sha1").agg(F.min("page_id").alias("first"))
    refers = F.when((F.col("page_id") > F.col("first")) & (F.octet_length("html") >= min_bytes), F.col("first"))
    return own.join(first, "sha1").select("page_id", "url", "html", "sha1", refers.alias("refers_to"))


def member(page_id, url, html: bytes, sha1: str, refers_to, level: int = 6) -> bytes:
    """One record as one gzip member: a response, or a revisit without payload."""
    raw = bytes.fromhex(sha1)
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(html)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{record_uuid(page_id, raw)}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(raw).decode()}",
        "Content-Type: application/http;msgtype=response",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is None:
        block += html
    else:
        head += [f"WARC-Refers-To: <urn:uuid:{record_uuid(refers_to)}>", f"WARC-Profile: {PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    record = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return zlib.compress(record, level, 31)


def write_warc(pages: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Write ``first_of_equal`` rows, one archive a task; (file, bytes, records) of each archive.

    A task writes under a name of its own attempt and then renames, so a repeated task replaces the
    archive with the same records. No archive is written for a task without rows.
    """

    def run(batches):
        context = TaskContext.get()
        path = f"{folder}/pages-{context.partitionId():06d}.warc.gz"
        system, final = opened(path)
        part, out, size, records = f"{final}.{context.taskAttemptId()}.part", None, 0, 0
        for batch in batches:
            if batch.num_rows and out is None:
                system.create_dir(final.rpartition("/")[0], recursive=True)
                out = system.open_output_stream(part)
            for page_id, url, html, sha1, refers in zip(*(c.to_pylist() for c in batch.columns)):
                made = member(page_id, url, html, sha1, refers, level)
                out.write(made)
                size, records = size + len(made), records + 1
        if out is not None:
            out.close()
            system.move(part, final)
            yield pa.RecordBatch.from_pydict({"file": [path], "bytes": [size], "records": [records]})

    rows = pages.select("page_id", "url", F.col("html").cast("binary").alias("html"), "sha1", "refers_to")
    return rows.mapInArrow(run, "file string, bytes long, records long")


def members(source, start: int, stop: int) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, decoded bytes) of every record that begins in [start, stop).

    A gzip magic counts only if what follows decodes to a WARC header, and the whole member must
    decode. After a record the search goes on at its end, which may lie beyond ``stop``.
    """
    buffer, base, at = b"", start, start

    def more() -> bool:
        nonlocal buffer
        got = source.read_at(BLOCK, base + len(buffer)) if base + len(buffer) < size else b""
        buffer += got
        return bool(got)

    size = source.size()
    while at < stop:
        if at - base >= BLOCK:
            buffer, base = buffer[at - base :], at
        found = buffer.find(MAGIC, at - base)
        if found < 0:
            at = max(at, base + len(buffer) - len(MAGIC) + 1)
            if at >= stop or not more():
                return
            continue
        at = base + found
        if at >= stop:
            return
        decoder, parts, fed, head = zlib.decompressobj(31), [], at, b""
        try:
            while not decoder.eof:
                if fed - base >= len(buffer) and not more():
                    break
                piece = buffer[fed - base : fed - base + FEED]
                fed += len(piece)
                parts.append(decoder.decompress(piece))
                if len(head) < 5:
                    head += parts[-1][:5]
                    if not b"WARC/".startswith(head[:5]) and head[:5] != b"WARC/":
                        break
        except zlib.error:
            pass
        if decoder.eof and head[:5] == b"WARC/":
            end = fed - len(decoder.unused_data)
            yield at, end - at, b"".join(parts)
            at = end
        else:
            at += 1


def parsed(record: bytes) -> dict:
    """Header fields and payload facts of one decoded record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "replace").split("\r\n")[1:] if ": " in x)
    block = rest[: int(fields.get("Content-Length", 0))]
    payload, kind = block, fields.get("WARC-Type")
    length = len(block)
    if fields.get("Content-Type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        stated = re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)
        length = int(stated[1]) if kind == "revisit" and stated else len(payload)
    digest = fields.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None
    if kind != "revisit":
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return {
        "record_type": kind,
        "record_id": fields.get("WARC-Record-ID"),
        "refers_to_id": fields.get("WARC-Refers-To"),
        "target_uri": fields.get("WARC-Target-URI"),
        "payload_bytes": length,
        "payload_digest": digest,
        "intact": kind == "revisit" or fields.get("WARC-Payload-Digest", f"sha1:{digest}") == f"sha1:{digest}",
        "page_id": page_of(fields.get("WARC-Record-ID")),
        "refers_to": page_of(fields.get("WARC-Refers-To")),
        "payload": payload if kind != "revisit" else None,
    }


RECORD = (
    "file string, offset long, length long, record_type string, record_id string, refers_to_id string, "
    "target_uri string, payload_bytes long, payload_digest string, intact boolean, page_id long, refers_to long"
)


def read_warc(archives: DataFrame, split_bytes: int = SPLIT_BYTES, payload: bool = True) -> DataFrame:
    """Records of archives (file, bytes): each file is cut into byte ranges, each range read by itself.

    Digest and length are those of the full payload: recomputed for a record that has one, taken from
    the headers for a revisit. ``intact`` is false where header and payload disagree.
    """
    begin = F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))
    splits = archives.where("bytes > 0").select("file", "bytes", F.explode(begin).alias("begin"))
    total = archives.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0] or 1
    names = [x.split()[0] for x in RECORD.split(", ")] + ["payload"] * payload
    schema = RECORD + ", payload binary" * payload
    arrow = pa.schema([(n, _ARROW[t]) for n, t in (x.split() for x in schema.split(", "))])

    def run(batches):
        rows, held = [], 0
        for batch in batches:
            for file, size, start in zip(*(c.to_pylist() for c in batch.columns)):
                system, path = opened(file)
                with system.open_input_file(path) as source:
                    for offset, length, record in members(source, start, min(start + split_bytes, size)):
                        row = {"file": file, "offset": offset, "length": length, **parsed(record)}
                        rows.append({n: row[n] for n in names})
                        held += len(record) if payload else 256
                        if held > BLOCK * 4:
                            yield pa.RecordBatch.from_pylist(rows, arrow)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, arrow)

    dealt = splits.repartition(int(min(total, MAX_TASKS)), "file", "begin")
    return dealt.mapInArrow(run, schema)


_ARROW = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}

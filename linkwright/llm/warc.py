"""WARC records in ZIP-packaged archives: written beside an index, read back by range without extraction."""

from __future__ import annotations

import gzip
import hashlib
import io
import struct
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Work, int64, table

#: Names of an archive's stored members.
RECORDS, INDEX = "archive/records.warc.gz", "indexes/records.idx"
_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Warc:
    """least: bytes from which equal payloads become revisits. archive: bytes of records after which an
    archive is closed. level: of the compression of each record, which is a gzip member of its own, so
    the stored member can still be read by range. date: of the records, which the pages do not have.
    zip64: write ZIP64 fields whatever the size."""

    least: int = 1000
    archive: int = 16 << 20
    level: int = 6
    date: str = "2024-01-01T00:00:00Z"
    zip64: bool = False


# ---------------------------------------------------------------- records


def record(page_id, url: str | None, payload: bytes, refers_to, date: str) -> bytes:
    """One WARC record; refers_to None makes it a response, else a revisit without the payload."""
    kind = b"response" if refers_to is None else b"revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    head = [b"WARC/1.1", b"WARC-Type: " + kind, b"WARC-Record-ID: <urn:x-page:%s>" % (b"" if page_id is None else str(page_id).encode()), b"WARC-Date: " + date.encode()]
    if url is not None:
        head.append(b"WARC-Target-URI: " + b"".join(url.encode().split()))
    head.append(b"WARC-Payload-Digest: sha1:" + hashlib.sha1(payload).hexdigest().encode())
    if refers_to is not None:
        head += [b"WARC-Refers-To: <urn:x-page:%d>" % refers_to, b"WARC-Profile: " + _PROFILE]
    head += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The fields of one record; a response's payload is checked against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        raise ValueError("no WARC record here")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in lines[1:])}
    block = rest[: int(fields[b"content-length"])]
    if len(block) != int(fields[b"content-length"]):
        raise ValueError("a WARC record is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = fields[b"warc-payload-digest"].removeprefix(b"sha1:").decode()
    kind = fields[b"warc-type"].decode()
    if kind == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("a payload does not match its digest")

    def page(name: bytes):
        value = fields.get(name, b"").removeprefix(b"<urn:x-page:").removesuffix(b">")
        return int(value) if value else None

    uri = fields.get(b"warc-target-uri")
    return {"page_id": page(b"warc-record-id"), "url": None if uri is None else uri.decode(), "payload": payload if kind == "response" else None, "payload_bytes": length, "payload_digest": digest, "record_type": kind, "refers_to": page(b"warc-refers-to")}


# ---------------------------------------------------------------- ZIP archives


def pack(records: bytes, index: bytes, zip64: bool) -> bytes:
    """An archive that stores both members as they are."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name, data in ((RECORDS, records), (INDEX, index)):
            with z.open(zipfile.ZipInfo(name), "w", force_zip64=zip64) as f:
                f.write(data)
    packed = out.getvalue()
    return _as_zip64(packed) if zip64 else packed


def _as_zip64(packed: bytes) -> bytes:
    """The same archive with its directory in ZIP64 form, as one of over 4 GiB has it."""
    *_, n, size, at, _ = struct.unpack("<4s4H2LH", packed[-22:])
    entries, pos = [], at
    for _ in range(n):
        fields = list(struct.unpack_from("<4s6H3L5H2L", packed, pos))
        name = packed[pos + 46 : pos + 46 + fields[10]]
        extra = struct.pack("<2H3Q", 1, 24, fields[9], fields[8], fields[16])
        pos += 46 + sum(fields[10:13])
        fields[8] = fields[9] = fields[16] = 0xFFFFFFFF
        fields[11], fields[12] = len(extra), 0
        entries.append(struct.pack("<4s6H3L5H2L", *fields) + name + extra)
    directory = b"".join(entries)
    end64 = struct.pack("<4sQ2H2L4Q", b"PK\6\6", 44, 45, 45, 0, 0, n, n, len(directory), at)
    locator = struct.pack("<4sLQL", b"PK\6\7", 0, at + len(directory), 1)
    return packed[:at] + directory + end64 + locator + struct.pack("<4s4H2LH", b"PK\5\6", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)


def stored_members(read, size: int) -> dict[str, tuple[int, int]]:
    """Where each stored member's bytes are: name to (offset, length).

    read(offset, length) reads a range. Finds the end record in the tail, follows the ZIP64 locator where
    its fields overflow, walks the central directory with its ZIP64 extra fields, and reads each local
    header for where the data begin. A compressed or encrypted member is an error.
    """
    tail_at = max(0, size - 65_557)
    tail = read(tail_at, size - tail_at)
    end = tail.rfind(b"PK\5\6")
    while end >= 0 and (end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(b"PK\5\6", 0, end)
    if end < 0:
        raise ValueError("no ZIP archive: its end record is missing")
    _, _, _, _, n, length, at, _ = struct.unpack_from("<4s4H2LH", tail, end)
    if 0xFFFF in (n,) or 0xFFFFFFFF in (length, at):
        locator = read(tail_at + end - 20, 20)
        if locator[:4] != b"PK\6\7":
            raise ValueError("a ZIP64 locator is missing")
        record64 = read(struct.unpack_from("<Q", locator, 8)[0], 56)
        if record64[:4] != b"PK\6\6":
            raise ValueError("a ZIP64 end record is missing")
        n, length, at = struct.unpack_from("<3Q", record64, 32)
    directory, pos, out = read(at, length), 0, {}
    for _ in range(n):
        sig, _, _, flags, method, _, _, _, packed, full, name_n, extra_n, note_n, _, _, _, where = struct.unpack_from("<4s6H3L5H2L", directory, pos)
        if sig != b"PK\1\2":
            raise ValueError("the central directory is damaged")
        name = directory[pos + 46 : pos + 46 + name_n].decode()
        extra, x = directory[pos + 46 + name_n : pos + 46 + name_n + extra_n], 0
        while x + 4 <= len(extra):
            tag, width = struct.unpack_from("<2H", extra, x)
            if tag == 1:
                values = iter(struct.unpack_from(f"<{width // 8}Q", extra, x + 4))
                full, packed, where = (next(values) if v == 0xFFFFFFFF else v for v in (full, packed, where))
            x += 4 + width
        if method != 0 or flags & 1 or packed != full:
            raise ValueError(f"{name} is not stored as it is")
        local = read(where, 30)
        if local[:4] != b"PK\3\4":
            raise ValueError(f"the local header of {name} is missing")
        out[name] = (where + 30 + sum(struct.unpack_from("<2H", local, 26)), full)
        pos += 46 + name_n + extra_n + note_n
    return out


# ---------------------------------------------------------------- operators


def write_archives(pages: DataFrame, folder: str, config: Warc) -> DataFrame:
    """pages: page_id, url, html, refers_to (long or null). One row per archive: path, records.

    folder: one that driver and executors share, as a URI. An archive appears under its name once it is
    whole; rows name only those of tasks that ended well, so a repeated task does no harm.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)

        def close(held: list[bytes]) -> pa.RecordBatch:
            name = f"{root}/{uuid.uuid4().hex}.wacz"
            with files.open_output_stream(name + ".part") as f:
                f.write(pack(b"".join(held), b"".join(b"%d\n" % len(x) for x in held), config.zip64))
            files.move(name + ".part", name)
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name.rpartition('/')[2]}"]), int64([len(held)])], ["path", "records"])

        held, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                held.append(gzip.compress(record(row["page_id"], row["url"], (row["html"] or "").encode(), row["refers_to"], config.date), config.level, mtime=0))
                size += len(held[-1])
                if size >= config.archive:
                    yield close(held)
                    held, size = [], 0
        if held:
            yield close(held)

    return pages.select("page_id", "url", "html", "refers_to").mapInArrow(run, "path string, records long")


RESULT = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(archives: DataFrame) -> DataFrame:
    """archives: path, of ZIP archives that hold records and their index as stored members. Each record:
    page_id, url, payload (null for a revisit), payload_bytes, payload_digest, record_type, refers_to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.strip().split(" ")[0] for x in RESULT.split(",")]
        schema = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[x.strip().split(" ")[1]]) for n, x in zip(names, RESULT.split(","), strict=True)])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, name = pafs.FileSystem.from_uri(path)
                with files.open_input_file(name) as f:
                    members = stored_members(lambda at, n, f=f: f.read_at(n, at), f.size())
                    at, n = members[INDEX]
                    lengths = [int(x) for x in f.read_at(n, at).split()]
                    at, n = members[RECORDS]
                    if sum(lengths) != n:
                        raise ValueError(f"the index of {path} does not fit its records")
                    rows, size = [], 0
                    for length in lengths:
                        rows.append(parse_record(gzip.decompress(f.read_at(length, at))))
                        at, size = at + length, size + rows[-1]["payload_bytes"]
                        if size >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return archives.select("path").mapInArrow(run, RESULT)


def archive_pages(spark: SparkSession, pages: DataFrame, config: Warc = Warc()) -> DataFrame:
    """pages: page_id (long), url, html. Writes a WARC record per row and reads all back: see RESULT.

    The payload is the html in UTF-8. Of records with equal payloads of at least `least` bytes the one
    with the largest page_id is the response, the others revisit it. Nulls: a null html is an empty
    payload, a null url gives no target URI, a row with null page_id is always a response and nothing
    refers to it. Repeated rows, and ties of the largest page_id: all of them are responses. A very long
    html is one record, held whole by the task that writes or reads it. Empty input gives no rows. Other
    columns are ignored, whatever their names.
    """
    work = Work(spark, "warc")
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    plain = plain.withColumn("digest", F.when(F.octet_length("html") >= config.least, F.sha2(F.col("html").cast("binary"), 256)))
    firsts = plain.where("digest is not null and page_id is not null").groupBy("digest").agg(F.max("page_id").alias("top"), F.count("*").alias("c")).where("c > 1").drop("c")
    firsts = work.save(firsts, "firsts")
    roles = plain.join(firsts.hint("merge"), "digest", "left").withColumn("refers_to", F.when(F.col("page_id") < F.col("top"), F.col("top")))
    archives = work.save(write_archives(roles, f"{work.path}/archives", config), "written")
    return read_archives(archives)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(spark, table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
r AS (SELECT *, max(page_id) OVER (PARTITION BY d) AS top FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id < top THEN top END AS refers_to FROM r
"""

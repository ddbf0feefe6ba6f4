"""WARC archives of pages: sorted records, files rolled by compressed size, temporary names and a manifest."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainloom.llm.shared import kept, run_folder

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, n_records long, n_bytes long, sha256 string"
CHUNK = 1 << 20


@dataclass(frozen=True)
class Archive:
    """roll_bytes: a file ends with the record that takes it to so many compressed bytes. least_bytes: payloads
    of so many bytes and more are stored once. date: of all records, so that a second run gives the same files."""

    prefix: str = "pages"
    roll_bytes: int = 64 << 20
    least_bytes: int = 0
    level: int = 6
    date: str = "2024-01-01T00:00:00Z"


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _header(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A record of header fields and a block. Control characters in a value are percent-encoded."""
    lines = ["WARC/1.1"]
    for name, value in [*fields, ("WARC-Block-Digest", f"sha1:{sha1(block)}"), ("Content-Length", str(len(block)))]:
        if value is not None:
            lines.append(f"{name}: " + "".join(c if " " <= c != "\x7f" else f"%{ord(c):02X}" for c in value))
    return "\r\n".join([*lines, "", ""]).encode() + block + b"\r\n\r\n"


def page_record(archive: Archive, page_id: int | None, url: str | None, payload: bytes, original: int | None, revisit: bool) -> bytes:
    """A response with its payload, or a revisit of the original page with the HTTP head alone."""
    digest = sha1(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", archive.date),
        ("WARC-Target-URI", url),
        ("WARC-Page-ID", None if page_id is None else str(page_id)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(original, digest)), ("WARC-Refers-To-Page-ID", str(original))]
    return _header(fields, head if revisit else head + payload)


class _Roller:
    """Writes records into files; a file has its real name only once it is whole."""

    def __init__(self, archive: Archive, folder: str, part: int):
        self.archive, self.part, self.number, self.done = archive, part, 0, []
        self.files, self.path = fs.FileSystem.from_uri(folder)
        self.stream = None

    def add(self, record: bytes) -> None:
        if self.stream is None:
            self.name = f"{self.archive.prefix}-{self.part:06d}-{self.number:05d}.warc.gz"
            self.temporary = f"{self.path}/.{self.name}.{uuid.uuid4().hex}"
            self.stream, self.size, self.records, self.hash = self.files.open_output_stream(self.temporary, compression=None), 0, 0, hashlib.sha256()
            info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, self.name)), ("WARC-Date", self.archive.date), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")]
            self._put(_header(info, b"software: chainloom\r\nformat: WARC File Format 1.1\r\n"))
        self._put(record)
        self.records += 1
        if self.size >= self.archive.roll_bytes:
            self.close()

    def _put(self, record: bytes) -> None:
        member = gzip.compress(record, self.archive.level, mtime=0)
        self.stream.write(member)
        self.hash.update(member)
        self.size += len(member)

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.files.move(self.temporary, f"{self.path}/{self.name}")
            self.done.append((self.name, self.records, self.size, self.hash.hexdigest()))
            self.stream, self.number = None, self.number + 1


def write_archives(pages: DataFrame, folder: str, archive: Archive = Archive()) -> DataFrame:
    """Write pages (page_id, url, html) and return the manifest: a row for each archive.

    Records are range-sorted by page and payload; what a page repeats comes as a narrow row that sorts in front
    of it, so the payloads are shuffled once. A task that is done again writes the same names. The manifest is
    a table that Spark commits after all files have their names; readers open the files it lists, nothing else.
    """
    payload = F.coalesce(F.encode(F.col("html"), "UTF-8"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload"), F.unhex(F.sha2(payload, 256)).alias("digest"))
    narrow = rows.where(F.octet_length("payload") >= archive.least_bytes).select("digest", "page_id")
    first = narrow.groupBy("digest").agg(F.min("page_id").alias("original"), F.count("*").alias("n")).where("n > 1 and original is not null").drop("n")
    again = narrow.join(first, "digest").where(~F.col("page_id").eqNullSafe(F.col("original"))).select("page_id", "digest", "original").distinct()
    marked = again.select("page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "digest", "original")
    both = rows.withColumn("original", F.lit(None).cast("long")).unionByName(marked)
    ordered = both.repartitionByRange("page_id", "digest").sortWithinPartitions("page_id", "digest", F.col("payload").isNotNull(), "url")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        roller, mark = _Roller(archive, folder, TaskContext.get().partitionId()), None
        for batch in batches:
            for page_id, url, body, digest, original in zip(*(c.to_pylist() for c in batch.columns)):
                if body is None:
                    mark = (page_id, digest, original)
                    continue
                revisit = mark is not None and mark[:2] == (page_id, digest)
                roller.add(page_record(archive, page_id, url, body, mark[2] if revisit else None, revisit))
        roller.close()
        columns = list(zip(*roller.done)) or [[], [], [], []]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "n_records", "n_bytes", "sha256"])

    scheme_free = fs.FileSystem.from_uri(folder)
    scheme_free[0].create_dir(scheme_free[1], recursive=True)
    return kept(ordered.mapInArrow(task, MANIFEST), "manifest")


def records(stream) -> Iterator[bytes]:
    """The members of a gzip file one after the other, never more than one in memory."""
    left = b""
    while True:
        member, parts = zlib.decompressobj(31), []
        while not member.eof:
            chunk = left or stream.read(CHUNK)
            left = b""
            if not chunk:
                if parts:
                    raise ValueError("the archive ends inside a record")
                return
            parts.append(member.decompress(chunk))
            left = member.unused_data
        yield b"".join(parts)


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record, its length and block digest checked."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a record: {lines[0][:40]}")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n" or fields["WARC-Block-Digest"] != f"sha1:{sha1(block)}":
        raise ValueError("a record is damaged")
    return fields, block


COLUMNS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_archives(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """The records of the archives of a manifest; a revisit has no payload of its own."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with files.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for record in records(stream):
                        fields, block = parse_record(record)
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        head, _, body = block.partition(b"\r\n\r\n")
                        length = int(head.rpartition(b"Content-Length: ")[2])
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        revisit = fields["WARC-Type"] == "revisit"
                        if not revisit and (len(body) != length or sha1(body) != digest):
                            raise ValueError("a payload is damaged")
                        page, of = fields.get("WARC-Page-ID"), fields.get("WARC-Refers-To-Page-ID")
                        rows.append((page and int(page), fields.get("WARC-Target-URI"), length, digest, fields["WARC-Type"], of and int(of), None if revisit else body))
                        size += len(body)
                        if size > 8 * CHUNK or len(rows) > 5_000:
                            yield _batch(rows)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows)

    return manifest.select("file").repartition(max(1, manifest.count()), "file").mapInArrow(task, COLUMNS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def round_trip(pages: DataFrame, archive: Archive = Archive(), folder: str | None = None) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every page, from archives written here.

    A null html is an empty payload. Of equal payloads the smallest page's is stored and the others revisit it;
    rows that repeat a page and its payload are all like the first. A null page is larger than any other; if only
    null pages have a payload, all are responses. A null url has no target line. An empty table gives no archive
    and no rows; other columns are not read.
    """
    spark = pages.sparkSession
    folder = folder or run_folder(spark, "warc")
    return read_archives(spark, write_archives(pages, folder, archive), folder).drop("url", "payload")

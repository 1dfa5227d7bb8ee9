r"""WARC records in ZIP packages, read back by ranges without unpacking.

Writing: each task writes packages of bounded size into the shared folder, the WARC file (one gzip
member per record) and its index as stored members.  A package's name is the attempt's own, and only
packages named in the written manifest are read, so a repeated task leaves no double records.

Reading: the end of a package gives the central directory, in its ZIP64 form where the short one is too
small; the directory gives the members, the index gives each record's range.  The ranges are dealt out
to tasks, which read and unpack single records.

Of records with equal payloads of at least ``least`` bytes, the one with the largest page_id is a
response, the others are revisits that refer to it; smaller ones are all responses.  Defined cases: a
null html is an empty payload; a null page_id refers to nothing and is a response only if all with that
payload are null, else a revisit; rows that repeat the largest page_id are all responses; a null url is
left out of the record; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioworks.llm.common import by_value, whole
from folioworks.session import fresh_path, written

LEAST_BYTES = 0
PACKAGE_BYTES = 32 << 20
RANGE_BYTES = 4 << 20
#: Tasks that read at most; beyond that each reads more ranges, one after the other.
MOST_TASKS = 20_000
#: The table has no time of capture.
DATE = "2024-01-01T00:00:00Z"
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"


def open_folder(folder: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path of a folder that all tasks reach."""
    if folder.startswith("s3a://"):
        folder = "s3://" + folder[6:]
    return arrow_fs.FileSystem.from_uri(folder)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    number = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record.  A revisit keeps the HTTP headers, with the length, but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    headers = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
        f"Content-Length: {len(block)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        headers.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        headers += [f"WARC-Refers-To: {_name(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(lines: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in lines.decode().split("\r\n")[1:] if ": " in line)


def read_record(raw: bytes) -> tuple[int | None, int, str, str, int | None]:
    """page_id, payload bytes, digest, type and the page referred to; a payload that differs from its digest is an error."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = _headers(head)
    http, _, payload = rest[: int(warc["Content-Length"])].partition(b"\r\n\r\n")
    told, kind = warc["WARC-Payload-Digest"].removeprefix("sha1:"), warc["WARC-Type"]
    size = int(_headers(http)["Content-Length"])
    if kind == "response" and (len(payload) != size or digest_of(payload) != told):
        raise ValueError(f"record {warc['WARC-Record-ID']} is damaged")
    return _page(warc["WARC-Record-ID"]), size, told, kind, _page(warc.get("WARC-Refers-To"))


class _Counted(io.RawIOBase):
    """Passes bytes on, counting them; not seekable, like an object store's stream."""

    def __init__(self, stream) -> None:
        super().__init__()
        self.stream, self.n = stream, 0

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.stream.write(bytes(data))
        self.n += len(data)
        return len(data)


class Package:
    """A ZIP package in the making: records go straight to the file, index lines wait for the end."""

    def __init__(self, files: arrow_fs.FileSystem, folder: str) -> None:
        self.path = f"{folder}/{uuid.uuid4().hex}.wacz"
        self.stream = files.open_output_stream(self.path)
        self.out = _Counted(self.stream)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(DATA, "w", force_zip64=True)
        self.at, self.lines = 0, []

    def add(self, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> None:
        raw = gzip.compress(record(page_id, url, payload, refers_to), 4, mtime=0)
        self.data.write(raw)
        entry = {"url": url, "page": page_id, "offset": self.at, "length": len(raw), "filename": DATA}
        self.lines.append(f"{quote(url or '-')} {DATE} {json.dumps(entry)}\n")
        self.at += len(raw)

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        with self.zip.open(INDEX, "w", force_zip64=True) as index:
            for line in self.lines:
                index.write(line.encode())
        described = {"profile": "data-package", "resources": [{"path": DATA, "bytes": self.at}, {"path": INDEX}]}
        self.zip.writestr("datapackage.json", json.dumps(described))
        self.zip.close()
        self.stream.close()
        return self.path, len(self.lines), self.out.n


class Archive:
    """Reads a ZIP package by ranges: end record, ZIP64 end record, central directory, members."""

    def __init__(self, files: arrow_fs.FileSystem, path: str) -> None:
        self.file = files.open_input_file(path)
        self.members = {name: rest for name, *rest in self._directory()}

    def read(self, at: int, n: int) -> bytes:
        data = self.file.read_at(n, at)
        if len(data) != n:
            raise ValueError("the package is cut off")
        return data

    def _end(self) -> tuple[int, int, int]:
        """Entries, size and place of the central directory."""
        size = self.file.size()
        tail = self.read(max(size - 65_557, 0), min(size, 65_557))
        at = tail.rfind(b"PK\x05\x06")
        if at < 0:
            raise ValueError("no end record: not a ZIP package")
        n, length, place = struct.unpack("<HII", tail[at + 10 : at + 20])
        if n == 0xFFFF or length == 0xFFFFFFFF or place == 0xFFFFFFFF:
            locator = self.read(size - len(tail) + at - 20, 20)
            if locator[:4] != b"PK\x06\x07":
                raise ValueError("no ZIP64 locator")
            record_at = struct.unpack("<Q", locator[8:16])[0]
            end = self.read(record_at, 56)
            if end[:4] != b"PK\x06\x06":
                raise ValueError("no ZIP64 end record")
            n, length, place = struct.unpack("<QQQ", end[32:56])
        return n, length, place

    def _directory(self) -> Iterator[tuple[str, int, int, int]]:
        """Name, method, place of the local header and stored size of each member."""
        n, length, place = self._end()
        entries, at = self.read(place, length), 0
        for _ in range(n):
            if entries[at : at + 4] != b"PK\x01\x02":
                raise ValueError("damaged central directory")
            method = struct.unpack("<H", entries[at + 10 : at + 12])[0]
            packed, plain, names, extras, comments = struct.unpack("<IIHHH", entries[at + 20 : at + 34])
            header = struct.unpack("<I", entries[at + 42 : at + 46])[0]
            name = entries[at + 46 : at + 46 + names].decode()
            extra = entries[at + 46 + names : at + 46 + names + extras]
            while len(extra) >= 4:
                tag, size = struct.unpack("<HH", extra[:4])
                if tag == 1:  # ZIP64: only what did not fit, in this order
                    wide = list(struct.unpack(f"<{size // 8}Q", extra[4 : 4 + size // 8 * 8]))
                    plain = wide.pop(0) if plain == 0xFFFFFFFF else plain
                    packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                    header = wide.pop(0) if header == 0xFFFFFFFF else header
                extra = extra[4 + size :]
            yield name, method, header, packed
            at += 46 + names + extras + comments

    def stored(self, name: str) -> tuple[int, int]:
        """Place and size of a member's bytes."""
        method, header, size = self.members[name]
        if method != 0:
            raise ValueError(f"{name} is not stored")
        names, extras = struct.unpack("<HH", self.read(header, 30)[26:30])
        return header + 30 + names + extras, size

    def lines(self, name: str, step: int = 1 << 20) -> Iterator[bytes]:
        at, size = self.stored(name)
        end, rest = at + size, b""
        while at < end:
            piece = self.read(at, min(step, end - at))
            at += len(piece)
            *whole_lines, rest = (rest + piece).split(b"\n")
            yield from whole_lines
        if rest:
            yield rest


MANIFEST = "path string, n_records bigint, n_bytes bigint"


def write_packages(pages: DataFrame, folder: str, least: int = LEAST_BYTES) -> DataFrame:
    """Writes all pages to packages in a shared folder and returns the manifest."""
    rows = pages.select("page_id", "url", whole("html").alias("html")).withColumn("_sha", F.sha1(F.col("html").cast("binary")))
    equal = (
        rows.filter(F.octet_length("html") >= least).groupBy("_sha").agg(F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    )
    told = rows.join(equal.select(F.col("_sha").alias("_equal"), "_first"), F.col("_sha") == F.col("_equal"), "left")
    refers = F.when(F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))
    told = told.select("page_id", "url", "html", refers.cast("bigint").alias("refers_to"))
    files, path = open_folder(folder)
    files.create_dir(path, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = open_folder(folder)
        package = None
        for batch in batches:
            for page_id, url, html, refers_to in zip(*[batch.column(c).to_pylist() for c in range(4)], strict=True):
                package = package or Package(files, path)
                package.add(page_id, url, html.encode("utf-8", "replace"), refers_to)
                if package.at >= PACKAGE_BYTES:
                    yield told_of([package.close()])
                    package = None
        if package:
            yield told_of([package.close()])

    def told_of(packages: list[tuple[str, int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*packages, strict=True)], names=["path", "n_records", "n_bytes"])

    return written(told.mapInArrow(run, MANIFEST), "manifest")


RANGES = "path string, start bigint, length bigint"
RECORDS = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
    ]
)


def read_packages(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """One row per record of the packages in the manifest."""

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = open_folder(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                archive = Archive(files, path)
                data, size = archive.stored(DATA)
                rows = []
                for line in archive.lines(INDEX):
                    entry = json.loads(line.split(b" ", 2)[2])
                    if entry["offset"] + entry["length"] > size:
                        raise ValueError(f"{path}: the index leads out of the data")
                    rows.append((path, data + entry["offset"], entry["length"]))
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["path", "start", "length"])
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["path", "start", "length"])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = open_folder(folder)
        path, archive = None, None
        for batch in batches:
            rows = []
            for own, start, length in zip(*[batch.column(c).to_pylist() for c in range(3)], strict=True):
                if own != path:
                    path, archive = own, files.open_input_file(own)
                rows.append(read_record(gzip.decompress(archive.read_at(length, start))))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)

    n_packages, n_bytes = manifest.agg(F.count("path"), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    # By number, as the planner would go by the bytes of the ranges' rows, which tell nothing of the records.
    tasks = lambda n: max(1, min(n, MOST_TASKS))
    found = manifest.select("path").repartition(tasks(n_packages), "path").mapInArrow(ranges, RANGES)
    # Stretches of a package, not whole packages, are dealt to the tasks.
    dealt = found.repartition(tasks(n_bytes // RANGE_BYTES), "path", F.floor(F.col("start") / RANGE_BYTES)).sortWithinPartitions("path", "start")
    return dealt.mapInArrow(records, RECORDS)


_ARROW = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def round_trip(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """Writes every page and reads the packages back."""
    spark = pages.sparkSession
    folder = fresh_path(spark, "packages")
    return read_packages(spark, write_packages(pages, folder, least), folder)


SQL = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
h AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS hex, max(page_id) OVER (PARTITION BY payload) AS latest FROM p),
b AS (SELECT *, list_aggregate(list_transform(range(1, 41), lambda i: ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011',
    '1100','1101','1110','1111'][instr('0123456789abcdef', hex[i])]), 'string_agg', '') AS bits FROM h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[CAST(1 + 16 * bits[5*i+1]::INT + 8 * bits[5*i+2]::INT
    + 4 * bits[5*i+3]::INT + 2 * bits[5*i+4]::INT + bits[5*i+5]::INT AS BIGINT)]), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM latest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM latest THEN latest END AS refers_to FROM b
"""

by_value(__name__)

"""WARC records in ZIP packages, written and read back by ranges.

A package is a ZIP file with two stored (uncompressed) members: ``archive/data.warc.gz``, one
gzip member per record, and ``indexes/index.cdx``, a line per record with its place in the
archive. The writer streams records and keeps only the index of its package in memory.

The reader opens a package at its end: it finds the end-of-central-directory record, follows
the ZIP64 locator where sizes or counts overflow, reads the central directory, and takes from
the local headers where the stored members begin. The index gives the records; each is read
by its own range. Nothing is extracted, and a package is only read where it is asked for.

Files are reached by URI through the file systems that Arrow knows, in the shared folder of
the session. A task writes to names of its own; only the names that its committed result
lists are ever read, so a repeated or lost task leaves no half package behind.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwise.llm.batches import in_batches
from driftwise.llm.hot_keys import hot_join
from driftwise.session import new_table_path, stage

PACKAGE_BYTES = 256 << 20
#: Records that one reading task takes at a time.
RANGE_RECORDS = 2_000
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
_LIMIT = 0xFFFFFFFF
# Fixed values of the ZIP format.
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"


def open_uri(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if ":" in uri else (pafs.LocalFileSystem(), uri)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# -- writing ---------------------------------------------------------------------------------


def warc_record(record_id: str, uri: str, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """One WARC 1.1 resource-like record. A revisit has no block; its payload lies in the
    record it refers to."""
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: text/html; charset=utf-8",
    ]
    if refers_to is not None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <{refers_to}>",
        ]
    block = payload if refers_to is None else b""
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class PackageWriter:
    """Writes stored members one after the other to a stream that only moves forward.

    Sizes and checksums follow each member in a data descriptor; the central directory holds
    them too. ZIP64 fields are written where 32 bits are not enough, or always if asked for.
    """

    def __init__(self, out, always_zip64: bool = False) -> None:
        self._out, self._at, self._zip64 = out, 0, always_zip64
        self._members: list[tuple[str, int, int, int]] = []
        self._open: tuple[str, int] | None = None

    def _write(self, data: bytes) -> None:
        self._out.write(data)
        self._at += len(data)

    def begin(self, name: str) -> None:
        raw = name.encode()
        self._open, self._crc, self._size = (name, self._at), 0, 0
        # the empty ZIP64 field makes the descriptor's sizes 64 bits wide
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self._write(LOCAL + struct.pack("<HHHHHIIIHH", 45, 0x808, 0, 0, 33, 0, _LIMIT, _LIMIT, len(raw), len(extra)) + raw + extra)

    def add(self, data: bytes) -> int:
        """Appends to the open member; gives the place inside it."""
        at = self._size
        self._crc = zlib.crc32(data, self._crc)
        self._size += len(data)
        self._write(data)
        return at

    def end(self) -> None:
        name, start = self._open
        self._write(b"PK\x07\x08" + struct.pack("<IQQ", self._crc, self._size, self._size))
        self._members.append((name, start, self._size, self._crc))
        self._open = None

    def close(self) -> None:
        begin = self._at
        for name, start, size, crc in self._members:
            raw, wide = name.encode(), self._zip64 or max(start, size) >= _LIMIT
            extra = struct.pack("<HHQQQ", 1, 24, size, size, start) if wide else b""
            small = (_LIMIT, _LIMIT) if wide else (size, size)
            self._write(
                CENTRAL
                + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0x808, 0, 0, 33, crc, *small, len(raw), len(extra), 0, 0, 0, 0, _LIMIT if wide else start)
                + raw + extra
            )
        length, n = self._at - begin, len(self._members)
        wide = self._zip64 or begin >= _LIMIT or length >= _LIMIT or n >= 0xFFFF
        if wide:
            end = self._at
            self._write(END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, length, begin))
            self._write(LOCATOR64 + struct.pack("<IQI", 0, end, 1))
        counts = (0xFFFF, 0xFFFF, _LIMIT, _LIMIT) if wide else (n, n, length, begin)
        self._write(END + struct.pack("<HHHHIIH", 0, 0, *counts, 0))


def write_packages(
    records: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES, always_zip64: bool = False
) -> DataFrame:
    """Writes (page_id, url, payload, refers_to) rows; gives (package, records) of every
    package, written once."""
    schema = "package string, records long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_uri(folder)
        fs.create_dir(root)
        out = writer = None
        index: list[str] = []
        size = 0

        def finish() -> pa.RecordBatch:
            writer.end()
            writer.begin(INDEX)
            for line in index:
                writer.add(line.encode())
            writer.end()
            writer.close()
            out.close()
            return pa.RecordBatch.from_pylist([{"package": name, "records": len(index)}])

        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                for row in batch.slice(low, 64).to_pylist():
                    if writer is None:
                        name = f"{uuid.uuid4().hex}.zip"
                        out = fs.open_output_stream(f"{root}/{name}")
                        writer, index, size = PackageWriter(out, always_zip64), [], 0
                        writer.begin(DATA)
                    raw = warc_record(
                        f"urn:page:{row['page_id'] or 'null'}", row["url"] or "", row["payload"], payload_digest(row["payload"]),
                        None if row["refers_to"] is None else f"urn:page:{row['refers_to']}",
                        "1970-01-01T00:00:00Z",
                    )
                    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                    packed = packer.compress(raw) + packer.flush()
                    at = writer.add(packed)
                    size += len(packed)
                    # offset, length, size of the payload (a revisit does not hold it)
                    index.append(f"{at} {len(packed)} {len(row['payload'])}\n")
                    if size >= package_bytes:
                        yield finish()
                        writer = None
        if writer is not None:
            yield finish()

    named = records.select(_json("page_id"), "url", "payload", _json("refers_to"))
    return stage(in_batches(named, run, schema), "packages")


# -- reading ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Member:
    name: str
    start: int
    size: int
    stored: bool


class PackageReader:
    """The members of a ZIP file that can be read at any place."""

    def __init__(self, source) -> None:
        self._source = source
        self.members = {m.name: m for m in self._directory()}

    def read(self, start: int, size: int) -> bytes:
        self._source.seek(start)
        data = self._source.read(size)
        if len(data) != size:
            raise ValueError("the package ends too early")
        return data

    def _directory(self) -> Iterator[Member]:
        total = self._source.seek(0, io.SEEK_END) or self._source.tell()
        # the record has 22 bytes and a comment of at most 65,535
        tail_size = min(total, 22 + 0xFFFF)
        tail = self.read(total - tail_size, tail_size)
        # the comment may hold the mark of the record: only the length that fits counts
        at = tail.rfind(END)
        while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
            at = tail.rfind(END, 0, at + 3)
        if at < 0:
            raise ValueError("no end of central directory")
        n, length, begin = struct.unpack_from("<HII", tail, at + 10)
        if 0xFFFF in (n,) or _LIMIT in (length, begin):
            locator = self.read(total - tail_size + at - 20, 20)
            if locator[:4] != LOCATOR64:
                raise ValueError("no ZIP64 locator")
            (where,) = struct.unpack_from("<Q", locator, 8)
            end64 = self.read(where, 56)
            if end64[:4] != END64:
                raise ValueError("no ZIP64 end of central directory")
            n, length, begin = struct.unpack_from("<QQQ", end64, 32)
        directory, at = self.read(begin, length), 0
        for _ in range(n):
            if directory[at : at + 4] != CENTRAL:
                raise ValueError("broken central directory")
            method, packed, size, name_size, extra_size, note_size, start = struct.unpack_from(
                "<H8xIIHHH8xI", directory, at + 10
            )
            name = directory[at + 46 : at + 46 + name_size].decode()
            extra = directory[at + 46 + name_size : at + 46 + name_size + extra_size]
            size, packed, start = _wide(extra, size, packed, start)
            yield Member(name, self._data_start(start), size, method == 0)
            at += 46 + name_size + extra_size + note_size

    def _data_start(self, header: int) -> int:
        local = self.read(header, 30)
        if local[:4] != LOCAL:
            raise ValueError("broken local header")
        name_size, extra_size = struct.unpack_from("<HH", local, 26)
        return header + 30 + name_size + extra_size

    def stored(self, name: str, offset: int = 0, size: int | None = None) -> bytes:
        """A range of a stored member."""
        member = self.members[name]
        if not member.stored:
            raise ValueError(f"{name} is compressed, ranges cannot be read")
        size = member.size - offset if size is None else size
        if offset < 0 or offset + size > member.size:
            raise ValueError("range outside the member")
        return self.read(member.start + offset, size)


def _wide(extra: bytes, *values: int) -> list[int]:
    """Values that overflow 32 bits stand in the ZIP64 field, in order."""
    wide, at = b"", 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            wide = extra[at + 4 : at + 4 + length]
        at += 4 + length
    out, used = [], 0
    for value in values:
        if value == _LIMIT:
            (value,) = struct.unpack_from("<Q", wide, used)
            used += 8
        out.append(value)
    return out


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields, rest[: int(fields["content-length"])]


def read_packages(packages: DataFrame, folder: str, range_records: int = RANGE_RECORDS) -> DataFrame:
    """Every record of the listed packages: page (JSON of the id), url, payload (null for a
    revisit), payload_bytes, payload_digest, record_type, refers_to (JSON).

    First each package's directories and index are read and its records dealt into ranges;
    then the ranges are read wherever there is room, so that a large package is no hot task.
    """

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_uri(folder)
        for batch in batches:
            for name in batch["package"].to_pylist():
                with fs.open_input_file(f"{root}/{name}") as source:
                    index = PackageReader(source).stored(INDEX).splitlines()
                for low in range(0, len(index), range_records):
                    lines = b"\n".join(index[low : low + range_records]).decode()
                    yield pa.RecordBatch.from_pylist([{"package": name, "lines": lines}])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(f"{root}/{row['package']}") as source:
                    reader = PackageReader(source)
                    lines = [tuple(map(int, line.split())) for line in row["lines"].split("\n")]
                    for low in range(0, len(lines), 100):
                        yield _read(reader, lines[low : low + 100])

    ranges = in_batches(packages.select("package"), plan, "package string, lines string")
    schema = (
        "page string, url string, payload binary, payload_bytes long, payload_digest string, "
        "record_type string, refers_to string"
    )
    return in_batches(ranges.repartition(_tasks(packages)), run, schema)


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _read(reader: PackageReader, lines: list[tuple[int, int, int]]) -> pa.RecordBatch:
    rows = []
    for offset, length, payload_bytes in lines:
        fields, block = parse_record(zlib.decompress(reader.stored(DATA, offset, length), 31))
        revisit = fields["warc-type"] == "revisit"
        if not revisit and (len(block) != payload_bytes or f"sha1:{payload_digest(block)}" != fields["warc-payload-digest"]):
            raise ValueError("a record does not hold what its index says")
        rows.append(
            {
                "page": _page(fields["warc-record-id"]),
                "url": fields["warc-target-uri"],
                "payload": None if revisit else block,
                "payload_bytes": payload_bytes,
                "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:"),
                "record_type": fields["warc-type"],
                "refers_to": _page(fields["warc-refers-to"]) if revisit else None,
            }
        )
    return pa.RecordBatch.from_pylist(
        rows,
        schema=pa.schema(
            [("page", pa.string()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
             ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string())]
        ),
    )


def _page(urn: str) -> str:
    return urn.removeprefix("<urn:page:").removesuffix(">")


# -- both ------------------------------------------------------------------------------------


def archived(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    source: str = "html",
    package_bytes: int = PACKAGE_BYTES,
    range_records: int = RANGE_RECORDS,
    always_zip64: bool = False,
) -> DataFrame:
    """Writes every page as a record, repeated payloads as revisits of the page with the
    smallest id, and reads all records back from the packages.

    Null html is an empty payload. A null id never becomes the one that others refer to
    unless no copy has an id; such copies are all responses. Of rows that repeat an id and a
    payload each is a response. An empty table writes and reads nothing. Line breaks in an
    address become spaces.
    """
    payload = F.coalesce(F.col(source), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(key).alias("page_id"),
        F.regexp_replace(F.coalesce(F.col(url), F.lit("")), r"\s+", " ").alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("sha1"),
    )
    # only the payloads that repeat are joined back, by the unique page, never the payloads
    slim = rows.select("page_id", "sha1")
    first = slim.groupBy("sha1").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
    repeats = (
        hot_join(slim, first.where("n > 1"), "sha1", pages.count()).where("page_id <> refers_to")
        .select("page_id", "sha1", "refers_to").distinct()
    )
    marked = rows.join(repeats, ["page_id", "sha1"], "left").select(
        "page_id", "url", "payload", "refers_to"
    )
    folder = new_table_path(pages.sparkSession, "warc-packages")
    packages = write_packages(marked, folder, package_bytes, always_zip64)
    kind = pages.schema[key].dataType
    back = read_packages(packages, folder, range_records)
    return back.select(
        _value("page", kind).alias("page_id"),
        "url",
        F.decode("payload", "UTF-8").alias("html"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        _value("refers_to", kind).alias("refers_to"),
    )


def _json(column: str):
    """An id of any type as JSON text; a missing one stays missing."""
    text = F.to_json(F.struct(F.col(column).alias("v")))
    inner = F.substring(text, F.lit(len('{"v":') + 1), F.length(text) - len('{"v":}'))
    return F.when(F.col(column).isNotNull(), inner).alias(column)


def _value(column: str, kind: T.DataType):
    """The id from its JSON text."""
    wrapped = F.concat(F.lit('{"v":'), F.col(column), F.lit("}"))
    return F.from_json(wrapped, T.StructType([T.StructField("v", kind)]))["v"]


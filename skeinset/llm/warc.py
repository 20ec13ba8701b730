"""WARC archives as a Spark data source, ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Reading: each file is a part of the plan, small files share one. Filters on the record type and other
header fields are taken over by the source, so a record is judged by its header block alone. What follows
the header of an unwanted record is passed over: plain files are read on behind it, and members of gzip
files carry their length in an extra field ("sl"), so that what is not wanted is not even inflated. The
payload is only decoded where the schema has it.

Writing: each task writes files of its own that no other task or attempt names, and closes them at about
``roll_bytes``. The commit lists the files of the tasks that count in ``_files``; readers take that list,
so what a lost task has left is never read. Files are reached by pyarrow, so any store it knows will do;
a path must be the same place for driver and executors.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from skeinset.llm.common import salted_join

SCHEMA = (
    "record_id string, record_type string, target_uri string, warc_date string, refers_to string, "
    "payload_digest string, payload_length bigint, content_length bigint, payload binary"
)
_HEADERS = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "warc_date": "warc-date",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
    "content_length": "content-length",
}
PART_BYTES = 64 << 20
BATCH_BYTES = 8 << 20
DATE = "1970-01-01T00:00:00Z"


def register(spark: SparkSession) -> None:
    """Make the format known to a session, and let sources with ``take_filters`` take over filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


class WarcSource(DataSource):
    """Options: ``roll_bytes`` and ``date`` (writing), ``part_bytes``, ``record_types`` and ``take_filters`` (reading).

    Blocks of records that aren't wanted are passed over. ``record_types``, names with commas between, says
    which types are. With ``take_filters`` the source also takes over Spark's filters of header fields. Spark
    keeps the filters of the last plan with a loaded table and applies them to every other use of it, so such
    a table must be loaded anew for each use; without the option a table can be used as often as one likes.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        takes = self.options.get("take_filters", "false").lower() == "true"
        return (FilteringWarcReader if takes else WarcReader)(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options, schema, overwrite)


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or not path.startswith("file:") else "file://" + path[5:])


# --- records ---------------------------------------------------------------------------------


def one_line(value: str) -> str:
    """A header value without characters that would end or bend its line: those become %XX."""
    if value.isprintable() and " " not in value:
        return value
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record_bytes(kind: str, record_id: str | None, uri: str | None, refers_to: str | None, payload: bytes, date: str) -> bytes:
    """A response with its payload, or a revisit without; both tell the payload's digest and length."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if kind == "revisit" else http + payload
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {date}", "Content-Type: application/http; msgtype=response"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"Content-Length: {len(block)}"]
    if record_id is not None:
        lines.append(f"WARC-Record-ID: <{one_line(record_id)}>")
    if uri is not None:
        lines.append(f"WARC-Target-URI: {one_line(uri)}")
    if refers_to is not None:
        lines.append(f"WARC-Refers-To: <{one_line(refers_to)}>")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    """One gzip member whose extra field "sl" tells its own length and that of the data."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    total = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, total & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04" + b"\x00" * 5 + b"\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def parse_header(block: bytes) -> dict[str, str]:
    """Header fields by lower-case name; lines that go on with a blank belong to the one before."""
    fields, last = {}, None
    for line in block.split(b"\r\n")[1:]:
        if line[:1] in (b" ", b"\t") and last:
            fields[last] += " " + line.strip().decode("utf-8", "replace")
        elif b":" in line:
            name, value = line.split(b":", 1)
            last = name.strip().lower().decode("latin-1")
            fields[last] = value.strip().decode("utf-8", "replace")
    return fields


def _named(fields: dict[str, str]) -> dict:
    row = {column: fields.get(header) for column, header in _HEADERS.items()}
    for column in ("record_id", "refers_to"):
        if row[column] is not None:
            row[column] = row[column].strip("<>")
    row["content_length"] = int(row["content_length"] or 0)
    digest = row["payload_digest"] or ""
    if digest.lower().startswith("sha1:") and len(digest) == 37:
        row["payload_digest"] = "sha1:" + base64.b32decode(digest[5:].upper()).hex()
    return row


class _Members:
    """The records of a file: header fields first, the block only on demand."""

    def __init__(self, file: io.BufferedReader):
        self.file, self.zipped = file, file.peek(2)[:2] == b"\x1f\x8b"

    def __iter__(self) -> Iterator[tuple[dict, _Block]]:
        return self._gzip() if self.zipped else self._plain(self.file)

    def _plain(self, file) -> Iterator[tuple[dict, _Block]]:
        while True:
            head = _until_blank_line(file)
            if not head:
                return
            fields = _named(parse_header(head))
            block = _Block(file, fields["content_length"])
            yield fields, block
            block.skip()

    def _gzip(self) -> Iterator[tuple[dict, _Block]]:
        while True:
            start = self.file.tell()
            length = _member_length(self.file)
            self.file.seek(start)
            if length is None:  # a writer that doesn't tell: inflate it all
                yield from self._plain(io.BufferedReader(gzip.GzipFile(fileobj=self.file)))
                return
            if not length:
                return
            inner = io.BufferedReader(_Inflated(self.file))
            fields = _named(parse_header(_until_blank_line(inner)))
            yield fields, _Block(inner, fields["content_length"])
            self.file.seek(start + length)  # the rest of the member is not inflated


class _Inflated(io.RawIOBase):
    """One gzip member, inflated as far as it is read."""

    def __init__(self, file):
        self.file, self.unzip = file, zlib.decompressobj(31)

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self.unzip.eof:
            raw = self.unzip.unconsumed_tail or self.file.read(16384)
            if not raw:
                raise EOFError("a gzip member ends early")
            data = self.unzip.decompress(raw, len(buffer))
            if data:
                buffer[: len(data)] = data
                return len(data)
        return 0


def _member_length(file) -> int | None:
    head = file.read(12)
    if not head:
        return 0
    if head[:2] != b"\x1f\x8b" or not head[3] & 4:
        return None
    extra = file.read(struct.unpack("<H", head[10:12])[0])
    while len(extra) >= 4:
        size = struct.unpack("<H", extra[2:4])[0]
        if extra[:2] == b"sl" and size == 8:
            return struct.unpack("<I", extra[4:8])[0] or None
        extra = extra[4 + size :]
    return None


def _until_blank_line(file) -> bytes:
    lines = []
    while True:
        line = file.readline()
        if not line or line in (b"\r\n", b"\n"):
            if line and not lines:
                continue  # blank lines between records
            return b"\r\n".join(lines)
        lines.append(line.rstrip(b"\r\n"))


class _Block:
    """What follows a header: read once or passed over."""

    def __init__(self, file, length: int):
        self.file, self.left = file, length

    def _read(self, n: int) -> bytes:
        data = self.file.read(n)
        self.left -= len(data)
        return data

    def http(self) -> dict[str, str]:
        """Fields of an HTTP head, which is read."""
        head = b""
        while self.left and not head.endswith(b"\r\n\r\n"):
            line = self.file.readline(self.left)
            if not line:
                break
            head += line
            self.left -= len(line)
        return parse_header(head)

    def rest(self) -> bytes:
        return self._read(self.left)

    def skip(self) -> None:
        if self.left and isinstance(getattr(self.file, "raw", None), gzip.GzipFile):
            while self.left and self._read(min(self.left, 1 << 16)):
                pass
        elif self.left:
            self.file.seek(self.left, 1)
            self.left = 0


# --- reading ---------------------------------------------------------------------------------


@dataclass
class Files(InputPartition):
    paths: list[str]


_TESTS = {
    EqualTo: lambda v, x: v == x,
    EqualNullSafe: lambda v, x: v == x,
    GreaterThan: lambda v, x: v > x,
    GreaterThanOrEqual: lambda v, x: v >= x,
    LessThan: lambda v, x: v < x,
    LessThanOrEqual: lambda v, x: v <= x,
    In: lambda v, x: v in x,
    StringStartsWith: lambda v, x: v.startswith(x),
}


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.part_bytes = options["path"], int(options.get("part_bytes", PART_BYTES))
        self.columns = schema.names
        self.kinds = {k.strip() for k in options.get("record_types", "").split(",") if k.strip()}
        self.tests: list[tuple[type, str, object]] = []

    def partitions(self) -> list[Files]:
        store, root = _store(self.path)
        listed = f"{root}/_files"
        if store.get_file_info(listed).type == fs.FileType.File:
            with store.open_input_stream(listed) as f:
                found = [(f"{root}/{name}", size) for name, size in json.loads(f.read())]
        else:
            info = store.get_file_info(root)
            infos = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(root, recursive=True))
            found = [(i.path, i.size) for i in infos if i.type == fs.FileType.File and i.base_name[0] not in "._"]
        parts, held, size = [], [], 0
        for path, n in sorted(found):
            if held and size + n > self.part_bytes:
                parts.append(Files(held))
                held, size = [], 0
            held.append(path)
            size += n
        return [*parts, Files(held)] if held or not parts else parts

    def _wanted(self, row: dict) -> bool:
        if self.kinds and row["record_type"] not in self.kinds:
            return False
        for kind, name, value in self.tests:
            have = row[name]
            if have is None:
                if kind is EqualNullSafe and value is None:
                    continue
                return False
            if kind is not IsNotNull and not _TESTS[kind](have, value):
                return False
        return True

    def read(self, part: Files) -> Iterator[pa.RecordBatch]:
        store, _ = _store(self.path)
        kinds = pa.schema(
            [(c, pa.binary() if c == "payload" else pa.int64() if c.endswith("_length") else pa.string()) for c in self.columns]
        )
        rows, size = [], 0
        for path in part.paths:
            with store.open_input_file(path) as raw:
                for row, block in _Members(io.BufferedReader(raw, 1 << 20)):
                    if not self._wanted(row):
                        continue
                    self._add_payload(row, block)
                    rows.append({c: row.get(c) for c in self.columns})
                    size += 400 + len(row.get("payload") or b"")
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, kinds)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, kinds)

    def _add_payload(self, row: dict, block: _Block) -> None:
        if row["record_type"] not in ("response", "revisit"):
            row["payload_length"] = row["content_length"]
            row["payload"] = block.rest() if "payload" in self.columns else None
        elif "payload" in self.columns or "payload_length" in self.columns:
            told = block.http().get("content-length")
            row["payload_length"] = int(told) if told else block.left
            if "payload" in self.columns and row["record_type"] == "response":
                row["payload"] = block.rest()


class FilteringWarcReader(WarcReader):
    """A reader that takes filters over, for tables that are used once."""

    def pushFilters(self, filters: list[Filter]):
        """Takes over comparisons of header fields with values; all others are left to Spark."""
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if isinstance(f, IsNotNull) and name in _HEADERS:
                self.tests.append((IsNotNull, name, None))
            elif type(f) in _TESTS and name in _HEADERS:
                self.tests.append((type(f), name, f.value))
            else:
                yield f


# --- writing ---------------------------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, int]]


class WarcWriter(DataSourceArrowWriter):
    """Takes ``record_id, record_type, target_uri, refers_to, payload`` (binary), in any order."""

    def __init__(self, options: dict, schema: StructType, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.roll, self.date = int(options.get("roll_bytes", PART_BYTES)), options.get("date", DATE)

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        files: list[tuple[str, int]] = []
        out, name = None, ""
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                payload = row.get("payload") or b""
                record = record_bytes(
                    row["record_type"], row.get("record_id"), row.get("target_uri"), row.get("refers_to"), payload, self.date
                )
                out.write(gzip_member(record))
                if out.tell() >= self.roll:
                    files.append((name, out.tell()))
                    out.close()
                    out = None
        if out is not None:
            files.append((name, out.tell()))
            out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        files = sorted(f for m in messages if m for f in m.files)
        listed = f"{root}/_files"
        if not self.overwrite and store.get_file_info(listed).type == fs.FileType.File:
            with store.open_input_stream(listed) as f:
                files = sorted([*map(tuple, json.loads(f.read())), *files])
        with store.open_output_stream(listed) as f:
            f.write(json.dumps(files).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, root = _store(self.path)
        for name, _ in (f for m in messages if m for f in m.files):
            store.delete_file(f"{root}/{name}")


# --- deduplicated archives -------------------------------------------------------------------


def with_revisits(pages: DataFrame, id_col: str, payload_col: str, min_bytes: int = 1000) -> DataFrame:
    """``pages`` with ``record_type`` and ``refers_to``; columns of these names are replaced.

    Of rows with equal payloads of at least ``min_bytes``, those with the largest id are responses and all
    others revisit that id; a null id is lower than any. Smaller payloads are all responses. The payload is
    a binary column without nulls. Payloads are told apart by SHA-1; only ids and digests are compared,
    and a payload moves once, to a task chosen by both.
    """
    base = pages.drop("record_type", "refers_to")
    keyed = base.withColumn("__digest", F.when(F.octet_length(payload_col) >= min_bytes, F.sha1(payload_col)))
    narrow = keyed.filter("__digest is not null").select("__digest", F.col(id_col).alias("__id"))
    latest = narrow.groupBy("__digest").agg(F.max("__id").alias("__latest"), F.count("*").alias("n")).filter("n > 1")
    older = salted_join(narrow, latest.drop("n"), "__digest", "__id").filter("__id is null or __id < __latest")
    revisits = older.filter("__latest is not null").distinct().withColumnsRenamed({"__digest": "__d", "__id": "__i"})
    met = keyed.join(revisits, (F.col("__digest") == F.col("__d")) & F.col(id_col).eqNullSafe(F.col("__i")), "left")
    return met.select(
        *base.columns,
        F.when(F.col("__d").isNull(), "response").otherwise("revisit").alias("record_type"),
        F.col("__latest").alias("refers_to"),
    )

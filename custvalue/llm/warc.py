"""WARC archives as a Spark data source: ``spark.read.format("warc")`` and ``df.write``.

Every record is a gzip member of its own, with its compressed length in the header's ``sl``
field, so a reader parses the record's headers, decides, and jumps over a payload it does not
want without inflating it. Members of other writers, without that field or with several records
in a member, and plain files are read too; there an unwanted payload is passed over.

Reading: files of a folder and of those in it are dealt to tasks by size; names end with .warc or
.warc.gz in any case, hidden ones (``.`` or ``_`` in front) are passed over, and any other stops
the read. The options ``types`` (record types, by comma), ``ids`` (record ids, by blank),
``uri_prefix``, ``date_prefix`` and ``payload`` (``full``; ``digest``: checked but not returned;
``none``: not read) are applied to the headers of a record before its payload is touched. With
``spark.sql.python.filterPushdown.enabled``, which is off by default, Spark's own filters on
record_type, record_id, target_uri, date, refers_to and payload_digest are applied there as well.

Writing: the columns are those of ``RECORD``; a task writes files of ``max_bytes`` at most under
``_temporary``, and the commit moves those of the tasks that count, so a lost or repeated task
leaves nothing. Paths are opened by pyarrow's file systems, local ones and those with a scheme.

Defined cases: a null payload is an empty one; null headers are left out; control characters and
blanks in a header value are percent-encoded; headers are read as UTF-8, and as Latin-1 where
they are not; an empty folder gives no rows; a very long payload is held once; a record whose
payload does not match its digest, or a cut file, stops the read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    StringStartsWith,
    WriterCommitMessage,
)

from custvalue.llm.common import settle, ship

RECORD = (
    "record_type string, record_id string, target_uri string, date string, refers_to string, "
    "payload_digest string, payload_length long, payload binary"
)
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "payload_length": "X-Payload-Length",
}
#: Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_OK = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
DATE = "1970-01-01T00:00:00Z"
HEAD_BYTES = 1 << 16
BLOCK = 1 << 20


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# Writing


def _value(text: str) -> str:
    return quote(text, safe="!#$%&'()*+,/:;=?@[]<>~|^`{}\"\\") if not text.isascii() or any(
        c <= " " or c == "\x7f" for c in text
    ) else text


def record_bytes(row: dict, date: str = DATE) -> bytes:
    """One record: headers, blank line, block, two line ends."""
    payload = row["payload"] or b""
    kind = row["record_type"]
    fields = {HEADERS[c]: row[c] for c in HEADERS if row[c] is not None}
    fields.setdefault("WARC-Date", date)
    if kind == "response":
        fields["Content-Type"] = "application/http; msgtype=response"
        block = HTTP_OK + b"Content-Length: %d\r\n\r\n" % len(payload) + payload
    elif kind == "revisit":
        fields["WARC-Profile"] = REVISIT_PROFILE
        fields["Content-Type"] = "application/http; msgtype=response"
        block = HTTP_OK + b"\r\n"
    else:
        block = payload
    lines = [VERSION.decode(), *(f"{k}: {_value(str(v))}" for k, v in fields.items())]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    """A gzip member that names its compressed and plain length."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    size = 10 + 2 + 12 + len(body) + 8
    if size >= 1 << 32 or len(data) >= 1 << 32:  # the field holds 32 bits
        head = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff"
    else:
        head = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + struct.pack(
            "<H2sHII", 12, b"sl", 8, size, len(data)
        )
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


@dataclass
class _Written(WriterCommitMessage):
    files: list[str]


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        scheme, _, rest = path.partition(":")
        return fs.FileSystem.from_uri(f"{scheme}://{rest}" if not rest.startswith("//") else path)
    return fs.LocalFileSystem(), path


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"].rstrip("/")
        self.level = int(options.get("level", 4))
        self.most = int(options.get("max_bytes", 1 << 30))
        self.overwrite = overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        import uuid

        files_of, base = _file_system(self.path)
        files_of.create_dir(f"{base}/_temporary", recursive=True)
        written: list[str] = []
        out = None
        try:
            for batch in iterator:
                for start in range(0, batch.num_rows, 64):
                    for row in batch.slice(start, 64).to_pylist():
                        data = member(record_bytes(row), self.level)
                        if out is not None and out.tell() + len(data) > self.most:
                            out.close()
                            out = None
                        if out is None:
                            name = f"part-{uuid.uuid4().hex}.warc.gz"
                            out = files_of.open_output_stream(f"{base}/_temporary/{name}", compression=None)
                            written.append(name)
                        out.write(data)
        finally:
            if out is not None:
                out.close()
        return _Written(written)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files_of, base = _file_system(self.path)
        files_of.create_dir(base, recursive=True)
        if self.overwrite:
            for info in files_of.get_file_info(fs.FileSelector(base)):
                if info.type == fs.FileType.File:
                    files_of.delete_file(info.path)
        for message in messages:
            for name in message.files if message else []:
                files_of.move(f"{base}/_temporary/{name}", f"{base}/{name}")
        self.abort(messages)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        files_of, base = _file_system(self.path)
        if files_of.get_file_info(f"{base}/_temporary").type == fs.FileType.Directory:
            files_of.delete_dir(f"{base}/_temporary")


# Reading


@dataclass
class WarcFiles(InputPartition):
    files: list[str]


def _headers(head: bytes) -> dict[str, str]:
    try:
        text = head.decode()
    except UnicodeDecodeError:
        text = head.decode("latin-1")
    lines = text.split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record but {lines[0][:40]!r}")
    found = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        found[name.strip().lower()] = value.strip()
    return found


class _Member:
    """What a gzip member holds, inflated as it is asked for."""

    def __init__(self, file, at: int):
        self.file, self.at = file, at
        file.seek(at)
        start = file.read(HEAD_BYTES)
        self.empty = not start
        if self.empty:
            return
        if start[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"no gzip member at {at}")
        #: Compressed and plain length, if the member names them.
        self.lengths = None
        if start[3] & 4 and start[12:14] == b"sl" and len(start) >= 24:
            self.lengths = struct.unpack("<II", start[16:24])
        self.inflater = zlib.decompressobj(31)
        self.used = len(start)
        self.held = self.inflater.decompress(start, HEAD_BYTES)
        self.passed = 0  # plain bytes that were taken

    def _more(self) -> bool:
        """Inflate some more; False at the member's end."""
        inflater = self.inflater
        if inflater.eof:
            return False
        data = inflater.unconsumed_tail
        if not data:
            data = self._read(self.at + self.used)
            self.used += len(data)
        self.held += inflater.decompress(data, BLOCK)
        return True

    def _read(self, at: int) -> bytes:
        self.file.seek(at)
        data = self.file.read(BLOCK)
        if not data:
            raise ValueError("the file ends within a record")
        return data

    def head(self) -> bytes | None:
        """Headers of the next record; None if there is none."""
        while True:
            while self.held[:1] in (b"\r", b"\n"):
                self.take(1, False)
            end = self.held.find(b"\r\n\r\n")
            if end >= 0:
                head = self.held[:end]
                self.take(end + 4, False)
                return head
            if not self._more():
                if self.held:
                    raise ValueError(f"the record at {self.at} is cut")
                return None

    def take(self, size: int, keep: bool) -> bytes:
        """The next plain bytes, or nothing if they are not kept."""
        parts, left = [], size
        while left:
            if not self.held and not self._more():
                raise ValueError(f"the record at {self.at} is cut")
            piece, self.held = self.held[:left], self.held[left:]
            left -= len(piece)
            if keep:
                parts.append(piece)
        self.passed += size
        return b"".join(parts)

    def end(self) -> int:
        """Where the next member starts, once this one is taken."""
        return self.at + self.used - len(self.inflater.unused_data)


class _Members:
    """Records of a gzip file, member by member."""

    def __init__(self, file):
        self.file = file

    def __iter__(self) -> Iterator[tuple[dict[str, str], callable]]:
        """Headers of every record, and a function that returns its block."""
        at = 0
        while not (member := _Member(self.file, at)).empty:
            at = None
            while (head := member.head()) is not None:
                headers = _headers(head)
                size, start = int(headers["content-length"]), member.passed
                yield headers, lambda keep, member=member, size=size: member.take(size, keep)
                alone = member.lengths and member.lengths[1] == start + size + 4
                if alone and member.passed == start:
                    at = member.at + member.lengths[0]  # without inflating the block
                    break
                member.take(start + size - member.passed, False)
            at = member.end() if at is None else at


class _Plain:
    """Records of a file that is not compressed."""

    def __init__(self, file):
        self.file = file

    def __iter__(self) -> Iterator[tuple[dict[str, str], callable]]:
        at = 0
        while True:
            self.file.seek(at)
            head = b""
            while b"\r\n\r\n" not in head:
                more = self.file.read(4096)
                if not more:
                    if head.strip():
                        raise ValueError("the file ends within a record")
                    return
                head += more
            start = head.partition(b"\r\n\r\n")[0]
            headers = _headers(start)
            begin, size = at + len(start) + 4, int(headers["content-length"])

            def pull(keep: bool, begin=begin, size=size) -> bytes:
                self.file.seek(begin)
                block = self.file.read(size)
                if len(block) < size:
                    raise ValueError("the file ends within a record")
                return block

            yield headers, pull
            at = begin + size + 4


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.payload = options.get("payload", "full")
        if self.payload not in ("full", "digest", "none"):
            raise ValueError(f"payload is full, digest or none, not {self.payload}")
        self.split = int(options.get("split_bytes", 128 << 20))
        self.equal: dict[str, set[str]] = {}
        self.prefixes: list[tuple[str, str]] = []
        if options.get("types"):
            self.equal["record_type"] = set(options["types"].split(","))
        if options.get("ids"):
            self.equal["record_id"] = set(options["ids"].split(" "))
        for column, name in (("target_uri", "uri_prefix"), ("date", "date_prefix")):
            if options.get(name):
                self.prefixes.append((column, options[name]))

    def partitions(self) -> list[InputPartition]:
        """Files dealt by size, large ones alone."""
        files_of, base = _file_system(self.path)
        if files_of.get_file_info(base).type == fs.FileType.File:
            return [WarcFiles([base])]
        files = []
        for info in files_of.get_file_info(fs.FileSelector(base, recursive=True)):
            names = info.path[len(base) :].strip("/").split("/")
            if info.type != fs.FileType.File or any(n.startswith((".", "_")) for n in names):
                continue
            if not names[-1].lower().endswith((".warc", ".warc.gz")):
                raise ValueError(f"{info.path} is no archive")
            files.append((info.path, info.size))
        files.sort()
        parts, size = [[]], 0
        for path, length in files:
            if parts[-1] and size + length > self.split:
                parts.append([])
                size = 0
            parts[-1].append(path)
            size += length
        return [WarcFiles(p) for p in parts]

    def _wanted(self, headers: dict[str, str]) -> bool:
        for column, values in self.equal.items():
            if _header(headers, column) not in values:
                return False
        return all((_header(headers, c) or "").startswith(p) for c, p in self.prefixes)

    def read(self, partition: WarcFiles) -> Iterator[pa.RecordBatch]:
        files_of, _ = _file_system(self.path)
        rows, size = [], 0
        for path in partition.files:
            with files_of.open_input_file(path) as raw, io.BufferedReader(raw, BLOCK) as file:
                records = _Members(file) if path.lower().endswith(".gz") else _Plain(file)
                for headers, pull in records:
                    if not self._wanted(headers):
                        continue
                    rows.append(self._row(headers, pull))
                    size += len(rows[-1]["payload"] or b"") + 500
                    if size > 16 << 20:
                        yield _batch(rows)
                        rows, size = [], 0
        if rows:
            yield _batch(rows)

    def _row(self, headers: dict[str, str], pull) -> dict:
        row = {c: _header(headers, c) for c in HEADERS}
        length = row["payload_length"]
        row["payload_length"] = int(length) if length is not None else None
        row["payload"] = None
        if row["record_type"] == "revisit" or self.payload == "none":
            return row
        block = pull(True)
        if headers.get("content-type", "").startswith("application/http"):
            block = block.partition(b"\r\n\r\n")[2]
        digest = payload_digest(block)
        if row["payload_digest"] not in (None, digest):
            raise ValueError(f"the payload of {row['record_id']} does not match its digest")
        row["payload_digest"], row["payload_length"] = digest, len(block)
        if self.payload == "full":
            row["payload"] = block
        return row


class PushingWarcReader(WarcReader):
    """Takes over filters on header columns; Spark evaluates the others."""

    def pushFilters(self, filters: list) -> Iterable:
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            known = column in HEADERS and column != "payload_length"
            if known and isinstance(f, EqualTo) and isinstance(f.value, str):
                values = {f.value}
            elif known and isinstance(f, In):
                values = {v for v in f.value if v is not None}
            elif known and isinstance(f, StringStartsWith):
                self.prefixes.append((column, f.value))
                continue
            else:
                yield f
                continue
            self.equal[column] = self.equal.get(column, values) & values


def _header(headers: dict[str, str], column: str) -> str | None:
    value = headers.get(HEADERS[column].lower())
    if value is None:
        return None
    if column == "payload_digest":
        return value.removeprefix("sha1:")
    return value


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"payload_length": pa.int64(), "payload": pa.binary()}
    names = [*HEADERS, "payload"]
    return pa.record_batch(
        [pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names], names=names
    )


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return RECORD

    def reader(self, schema) -> DataSourceReader:
        pushing = self.options.get("pushdown", "false") == "true"
        return (PushingWarcReader if pushing else WarcReader)(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if [f.name for f in schema.fields] != [*HEADERS, "payload"]:
            raise ValueError(f"the columns of an archive are {RECORD}")
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(WarcDataSource)


def read_warc(
    spark: SparkSession,
    path: str,
    types: tuple[str, ...] = (),
    payload: str = "full",
    ids: tuple[str, ...] = (),
    uri_prefix: str = "",
    date_prefix: str = "",
) -> DataFrame:
    """Records of the archives in a folder, or of one; what is empty is not asked for."""
    register(spark)
    options = {
        "payload": payload,
        "types": ",".join(types),
        "ids": " ".join(ids),
        "uri_prefix": uri_prefix,
        "date_prefix": date_prefix,
        "pushdown": spark.conf.get("spark.sql.python.filterPushdown.enabled", "false"),
    }
    return spark.read.format("warc").options(**{k: v for k, v in options.items() if v}).load(path)


def write_warc(records: DataFrame, path: str) -> None:
    """Write records, with the columns of ``RECORD``, into a folder."""
    register(records.sparkSession)
    records.select(*HEADERS, "payload").write.format("warc").mode("append").save(path)


# Pages


def page_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """A record per page; equal payloads of ``least_bytes`` or more are kept once.

    Of such pages that with the largest page_id is the response, the others revisit it. Rows
    that repeat that page_id are responses too; a null page_id revisits any other. Only pages
    that have copies are joined, by the digest; Spark splits a hot one.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"digest": F.sha1("payload"), "length": F.octet_length("payload").cast("long")}
    )
    copies = settle(
        rows.where(F.col("length") >= least_bytes)
        .groupBy("digest")
        .agg(F.count("*").alias("n"), F.max("page_id").alias("first"))
        .where("n > 1 and first is not null")
        .select(F.col("digest").alias("copied"), "first"),
        "payloads",
    )
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))

    def urn(column: str):
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(">"))

    return rows.join(
        copies, (F.col("digest") == F.col("copied")) & (F.col("length") >= least_bytes), "left"
    ).select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        urn("page_id").alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(None).cast("string").alias("date"),
        F.when(again, urn("first")).alias("refers_to"),
        F.concat(F.lit("sha1:"), base32(F.col("digest"))).alias("payload_digest"),
        F.col("length").alias("payload_length"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def base32(hexadecimal):
    """Base 32 of the 40 hexadecimal digits of a SHA-1."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"  # of the same values in ``conv``
    parts = [
        F.lpad(F.conv(F.substring(hexadecimal, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)
    ]
    return F.translate(F.concat(*parts), digits, letters)


def page_of(urn):
    """page_id of a record of ``page_records``."""
    return F.expr(f"try_cast(regexp_extract({urn}, '<urn:page:(-?[0-9]+)>', 1) AS BIGINT)")

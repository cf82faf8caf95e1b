"""Fetched pages in WARC archives: a data source that reads them in byte ranges.

An archive is a ``.warc.gz`` file: records one after another, each compressed by itself. Reading is dealt by
byte ranges of whole folders, so one large archive fills many tasks: a record belongs to the range its
first byte lies in, and a range that starts inside a record looks for the next one (bytes that open a gzip
member whose text opens a WARC record; pages are UTF-8, where these bytes cannot stand next to each other).
Responses and resources are pages, other records are passed over. Bodies are taken as stored, with
bytes that are no UTF-8 replaced. A record that ends early is an error.

As a stream, the offset is the size of every archive when it was last listed. New archives and whole records
added to known ones are new rows; keep archives large, since an offset names each of them. A record that is
being added when the folder is listed fails its task, which finds it whole when it is tried again.

Writing appends one archive a task. Tasks write to a folder of the run, and what they have written is moved
beside the other archives once all are done. Source, id and times are kept in the header of a record, nulls too.

Paths may be any that pyarrow's file systems know; executors open them by themselves.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition, WriterCommitMessage,
)
from pyspark.sql.types import StructType

from joblark.schemas import DETAIL_PAGE

FORMAT = "page_archive"
SUFFIX = ".warc.gz"
# Bytes of archives a task reads, and rows and bytes of HTML it hands on at a time.
RANGE_BYTES = 32 << 20
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20

_CHUNK = 256 << 10
# Enough bytes of a member to see how its text starts.
_LOOK = 4096
_MEMBER, _RECORD = b"\x1f\x8b\x08", b"WARC/1."
_FIELDS = {"source": "X-Page-Source", "job_id": "X-Page-Job-Id", "url": "X-Page-Url"}
_NO_BODY = "X-Page-Body"
_ARROW = {name: pa.string() for name in ("source", "url", "job_id", "html")} | {"crawled_at": pa.timestamp("us", "UTC")}


# ---- records -----------------------------------------------------------------------


def _utc(at: datetime) -> str:
    at = at.astimezone(timezone.utc) if at.tzinfo else at
    return f"{at.replace(tzinfo=None).isoformat(timespec='microseconds')}Z"


def to_member(page: dict) -> bytes:
    """A page as a compressed record."""
    url, html = page["url"], page["html"]
    head = ["WARC/1.1", "WARC-Type: resource", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", "Content-Type: text/html; charset=utf-8"]
    plain = bool(url) and url == url.strip(" <>") and url.isprintable()
    if plain:
        head.append(f"WARC-Target-URI: {url}")
    # what has no header of its own is written as JSON, which keeps any character on one line
    head += [f"{h}: {json.dumps(page[c])}" for c, h in _FIELDS.items() if page[c] is not None and not (c == "url" and plain)]
    if page["crawled_at"] is not None:
        head.append(f"WARC-Date: {_utc(page['crawled_at'])}")
    if html is None:
        head.append(f"{_NO_BODY}: none")
    body = (html or "").encode()
    text = "\r\n".join([*head, f"Content-Length: {len(body)}", "", ""]).encode() + body + b"\r\n\r\n"
    packed = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packed.compress(text) + packed.flush()


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


def _time(value: str | None) -> datetime | None:
    try:
        at = datetime.fromisoformat(value or "")
    except ValueError:
        return None
    return at if at.tzinfo else at.replace(tzinfo=timezone.utc)


def to_page(record: bytes) -> dict | None:
    """The page of a record, if it holds one."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = _headers(head)
    length = int(fields["content-length"])
    if len(rest) < length:
        raise EOFError(f"a record of {length} bytes holds {len(rest)}")
    body, kind = rest[:length], fields.get("warc-type")
    if kind == "response":
        body = body.partition(b"\r\n\r\n")[2]
    elif kind != "resource":
        return None
    page = {c: json.loads(fields[h.lower()]) if h.lower() in fields else None for c, h in _FIELDS.items()}
    if page["url"] is None and "warc-target-uri" in fields:
        page["url"] = fields["warc-target-uri"].strip("<>")
    page["html"] = None if _NO_BODY.lower() in fields else body.decode("utf-8", "replace")
    return page | {"crawled_at": _time(fields.get("warc-date"))}


# ---- byte ranges -------------------------------------------------------------------


def _opens_record(data: bytes) -> bool:
    try:
        return zlib.decompressobj(31).decompress(data, len(_RECORD)) == _RECORD
    except zlib.error:
        return False


def first_record(file, start: int, end: int) -> int | None:
    """Where the first record of a range starts."""
    file.seek(start)
    data, base, i = file.read(_CHUNK), start, 0
    while True:
        i = data.find(_MEMBER, i)
        keep = i if i >= 0 else max(0, len(data) - len(_MEMBER) + 1)
        if base + keep >= end:
            return None
        if i < 0 or len(data) - i < _LOOK:  # the rest of a match, or of its first bytes, lies in the next chunk
            more = file.read(_CHUNK)
            if more:
                data, base, i = data[keep:] + more, base + keep, 0
                continue
            if i < 0:
                return None
        if _opens_record(data[i : i + _LOOK]):
            return base + i
        i += 1


def records(file, start: int, end: int) -> Iterator[bytes]:
    """The records that start in a range of an archive."""
    at = first_record(file, start, end) if start else 0
    if at is None:
        return
    file.seek(at)
    data = b""
    while at < end:
        data = data or file.read(_CHUNK)
        if not data:
            return
        member, parts, used = zlib.decompressobj(31), [], 0
        while True:
            parts.append(member.decompress(data))
            used += len(data)
            if member.eof:
                break
            data = file.read(_CHUNK)
            if not data:
                raise EOFError(f"the record at byte {at} ends early")
        data = member.unused_data
        at += used - len(data)
        yield b"".join(parts)


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int

    def __post_init__(self):
        super().__init__((self.path, self.start))


def _archives(folder: str) -> dict[str, int]:
    """Archives below a folder with their sizes, in order of their names."""
    system, root = fs.FileSystem.from_uri(folder)
    root = root.rstrip("/")
    found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    names = {f.path[len(root) + 1 :]: f.size for f in found if f.type == fs.FileType.File and f.path.endswith(SUFFIX)}
    hidden = lambda name: any(part[0] in "_." for part in name.split("/"))
    return {n: names[n] for n in sorted(names) if not hidden(n)}


def _ranges(sizes: dict[str, int], done: dict[str, int], step: int) -> list[Range]:
    return [
        Range(name, start, min(start + step, size))
        for name, size in sizes.items()
        for start in range(done.get(name, 0), size, step)
    ]


class _Pages:
    """Pages of a folder's archives as batches of the wanted columns."""

    def __init__(self, options: dict, schema: StructType):
        self.folder = options["path"]
        self.step = int(options.get("rangeBytes", RANGE_BYTES))
        self.names = schema.fieldNames()
        unknown = set(self.names) - set(_ARROW)
        if unknown or self.step < 1:
            raise ValueError(f"no column of pages: {sorted(unknown)}" if unknown else "rangeBytes has to be positive")

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(self.folder)
        schema = pa.schema([(n, _ARROW[n]) for n in self.names])
        held, size = [], 0
        with system.open_input_file(f"{root.rstrip('/')}/{partition.path}") as file:
            for record in records(file, partition.start, partition.end):
                page = to_page(record)
                if page is None:
                    continue
                held.append(page)
                size += len(record)
                if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)


class ArchiveReader(_Pages, DataSourceReader):
    def partitions(self) -> list[Range]:
        return _ranges(_archives(self.folder), {}, self.step) or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return super().read(partition) if partition.path else iter(())


class ArchiveStream(_Pages, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return _archives(self.folder)

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return _ranges(dict(sorted(end.items())), start, self.step)

    def commit(self, end: dict) -> None:
        """Archives stay where they are."""


# ---- writing -----------------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    name: str | None


class ArchiveWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, schema: StructType):
        missing = set(_ARROW) - set(schema.fieldNames())
        if missing:
            raise ValueError(f"pages lack {sorted(missing)}")
        self.folder, self.run = folder, f"_writing-{uuid.uuid4().hex}"

    def _place(self) -> tuple[fs.FileSystem, str]:
        system, root = fs.FileSystem.from_uri(self.folder)
        return system, root.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = self._place()
        name, out = f"{uuid.uuid4().hex}{SUFFIX}", None
        for batch in iterator:
            if not batch.num_rows:
                continue
            if out is None:
                system.create_dir(f"{root}/{self.run}", recursive=True)
                out = system.open_output_stream(f"{root}/{self.run}/{name}", compression=None)
            for page in batch.to_pylist():
                out.write(to_member(page))
        if out is None:
            return Written(None)
        out.close()
        return Written(name)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = self._place()
        names = [m.name for m in messages if m is not None and m.name]
        for name in names:
            system.move(f"{root}/{self.run}/{name}", f"{root}/{name}")
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        system, root = self._place()
        if system.get_file_info(f"{root}/{self.run}").type != fs.FileType.NotFound:
            system.delete_dir(f"{root}/{self.run}")


class PageArchive(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return DETAIL_PAGE

    def reader(self, schema: StructType) -> ArchiveReader:
        return ArchiveReader(self.options, schema)

    def streamReader(self, schema: StructType) -> ArchiveStream:
        return ArchiveStream(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> ArchiveWriter:
        if overwrite:
            raise ValueError("archives are only added to")
        return ArchiveWriter(self.options["path"], schema)


def append_archive(pages: DataFrame, folder: str) -> None:
    """Add pages to a folder of archives."""
    pages.sparkSession.dataSource.register(PageArchive)
    pages.select(*DETAIL_PAGE.fieldNames()).write.format(FORMAT).mode("append").save(folder)


def read_archive(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All pages of a folder of archives."""
    spark.dataSource.register(PageArchive)
    return spark.read.format(FORMAT).option("rangeBytes", range_bytes).load(folder)


def archive_stream(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Pages that come to a folder of archives."""
    spark.dataSource.register(PageArchive)
    return spark.readStream.format(FORMAT).option("rangeBytes", range_bytes).load(folder)

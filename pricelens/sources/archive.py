"""Stored crawl archives as a data source: batch reader, stream reader, writer.

An archive is a folder of ``*.warc.gz`` files: one gzip member a record, so a
file can be read from any member on.  A split is a range of bytes, and the
members that start in it are its own: its reader looks for the first gzip header
in the range whose content opens a record, and reads on until a member starts
beyond the range's end.  So one large file is read by many tasks, each holding
one record and one output batch.

    write_archive(pages, path)             # one load = one folder, published whole
    read_archive(spark, path)              # PAGE_SCHEMA
    read_archive_stream(spark, path)       # the same for files that land later

The writer keeps every column of ``PAGE_SCHEMA``, nulls included, in a header of
its own (``Page-Meta``).  Records without it, of other writers, give the target
URI as ``url``, the record's date as ``fetched_at`` and the HTTP body as ``html``;
records that are no responses are passed over.  Undecodable bytes become U+FFFD.

Loads: tasks write under ``_temporary``; the commit drops what attempts that lost
have left and renames the load's folder, so a load is seen whole or not at all.
A failed load's folder is renamed and deleted, and tasks that still run cannot
make it again (on a store that makes parent folders by itself, they can).
Streams: folders and files must land under names that ascend (those of the writer
do), for the offset is the last name read.  A file cut short raises.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader,
                                    InputPartition, WriterCommitMessage)

from pricelens.schema import PAGE_SCHEMA
from pricelens.session import share_package

FORMAT = "page_archive"
SUFFIX = ".warc.gz"
SPLIT_BYTES = 64 << 20
# an output batch is closed at either bound
BATCH_PAGES = 256
BATCH_BYTES = 16 << 20
# what is read at a time; the rest of a chunk is copied once a member
CHUNK = 64 << 10
MAGIC = b"\x1f\x8b\x08"
OPENING = b"WARC/"
# compressed bytes that surely inflate to an opening
HEAD = 1024

_META = [f.name for f in PAGE_SCHEMA.fields if f.name != "html"]
_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string()),
                    ("fetched_at", pa.timestamp("us", tz="UTC")), ("site", pa.string()), ("page_type", pa.string())])
_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


# ---------------------------------------------------------------- files
def store_of(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder, and the folder's path in it."""
    if path.startswith("file:/"):
        path = "file:///" + path[len("file:"):].lstrip("/")
    store, at = pafs.FileSystem.from_uri(path)
    return store, at.rstrip("/")


def archive_files(path: str) -> list[tuple[str, int]]:
    """(name below ``path``, bytes) of every published file, by name."""
    store, root = store_of(path)
    found = store.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
    names = [(f.path[len(root):].lstrip("/"), f.size) for f in found if f.type == pafs.FileType.File]
    return sorted((n, s) for n, s in names if n.endswith(SUFFIX) and not any(p[0] in "_." for p in n.split("/")))


@dataclass
class Split(InputPartition):
    """The members of a file that start in [start, end)."""

    name: str
    start: int
    end: int


def splits(files: list[tuple[str, int]], size: int) -> list[Split]:
    return [Split(name, at, min(at + size, n)) for name, n in files for at in range(0, n, size)]


# ---------------------------------------------------------------- members and records
def _opens(head: bytes) -> bool:
    try:
        return zlib.decompressobj(31).decompress(head, len(OPENING)) == OPENING
    except zlib.error:
        return False


def first_member(f, start: int, end: int) -> int | None:
    """Where the first member at or after ``start`` and before ``end`` begins."""
    at = start
    while at < end:
        # two more bytes, for a header across the chunk's end
        buf = f.read_at(min(CHUNK, end - at) + len(MAGIC) - 1, at)
        i = buf.find(MAGIC)
        while i >= 0:
            if _opens(f.read_at(HEAD, at + i)):
                return at + i
            i = buf.find(MAGIC, i + 1)
        at += CHUNK
    return None


def members(f, start: int, end: int) -> Iterator[bytes]:
    """The inflated members that start in [start, end)."""
    at = first_member(f, start, end)
    if at is None:
        return
    f.seek(at)
    buf = b""
    while at < end:
        inflate, out = zlib.decompressobj(31), []
        while not inflate.eof:
            if not buf:
                buf = f.read(CHUNK)
                if not buf:
                    raise ValueError(f"archive file ends inside the record at byte {at}")
            n = len(buf)
            out.append(inflate.decompress(buf))
            buf = inflate.unused_data
            at += n - len(buf)
        yield b"".join(out)


def records(member: bytes) -> Iterator[tuple[dict, bytes]]:
    """(headers by lower-case name, block) of a member's records."""
    at = 0
    while at < len(member):
        top = member.find(b"\r\n\r\n", at)
        if top < 0 or not member.startswith(OPENING, at):
            raise ValueError("not an archive record")
        lines = member[at:top].decode("utf-8", "replace").split("\r\n")[1:]
        head = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        body = top + 4
        end = body + int(head["content-length"])
        if end > len(member):
            raise ValueError("archive record shorter than its stated length")
        yield head, member[body:end]
        # two line ends close a record
        at = end + 4


def page_of(head: dict, block: bytes) -> tuple | None:
    """A record as a row of ``PAGE_SCHEMA``; None where it is no response."""
    if "page-meta" in head:
        meta = json.loads(head["page-meta"])
        stamp = meta["fetched_at"]
        if stamp is not None:
            stamp = _EPOCH + dt.timedelta(microseconds=stamp)
        return (meta["page_id"], meta["url"], block.decode("utf-8", "replace") if meta["html"] else None, stamp, meta["site"], meta["page_type"])
    if head.get("warc-type") not in ("response", "resource"):
        return None
    if head.get("content-type", "").startswith("application/http"):
        block = block.partition(b"\r\n\r\n")[2]
    try:
        stamp = dt.datetime.fromisoformat(head["warc-date"].replace("Z", "+00:00"))
        stamp = stamp if stamp.tzinfo else stamp.replace(tzinfo=dt.timezone.utc)
    except (KeyError, ValueError):
        stamp = None
    url = head.get("warc-target-uri")
    return (None, url.strip("<>") if url else None, block.decode("utf-8", "replace"), stamp, None, None)


def record_of(row: dict) -> bytes:
    """One page as a gzip member."""
    meta = {c: row.get(c) for c in _META}
    if meta["fetched_at"] is not None:
        meta["fetched_at"] = (meta["fetched_at"] - _EPOCH) // dt.timedelta(microseconds=1)
    html = row.get("html")
    meta["html"] = html is not None
    block = (html or "").encode()
    # JSON escapes line ends and all beyond ASCII, so a value cannot end its header
    lines = ["WARC/1.0", "WARC-Type: resource", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
             f"WARC-Target-URI: {quote(meta['url'] or '', safe=';/?:@&=+$,#%~')}", f"Page-Meta: {json.dumps(meta)}",
             "Content-Type: text/html", f"Content-Length: {len(block)}", "", ""]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + pack.flush()


# ---------------------------------------------------------------- the data source
def _read(path: str, split: Split) -> Iterator[pa.RecordBatch]:
    store, root = store_of(path)
    rows, size = [], 0
    with store.open_input_file(f"{root}/{split.name}") as f:
        for member in members(f, split.start, split.end):
            for head, block in records(member):
                row = page_of(head, block)
                if row is None:
                    continue
                rows.append(row)
                size += len(block)
                if len(rows) >= BATCH_PAGES or size >= BATCH_BYTES:
                    yield _batch(rows)
                    rows, size = [], 0
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)


class _Reader(DataSourceReader):
    def __init__(self, path: str, size: int):
        self.path, self.size = path, size

    def partitions(self) -> list[Split]:
        # Spark needs one partition at least
        return splits(archive_files(self.path), self.size) or [Split("", 0, 0)]

    def read(self, split: Split) -> Iterator[pa.RecordBatch]:
        return _read(self.path, split) if split.end > split.start else iter(())


class _StreamReader(DataSourceStreamReader):
    def __init__(self, path: str, size: int):
        self.path, self.size = path, size

    def initialOffset(self) -> dict:  # noqa: N802
        return {"after": ""}

    def latestOffset(self) -> dict:  # noqa: N802
        files = archive_files(self.path)
        return {"after": files[-1][0] if files else ""}

    def partitions(self, start: dict, end: dict) -> list[Split]:
        return splits([f for f in archive_files(self.path) if start["after"] < f[0] <= end["after"]], self.size)

    def read(self, split: Split) -> Iterator[pa.RecordBatch]:
        return _read(self.path, split)


@dataclass
class _Written(WriterCommitMessage):
    name: str | None


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path
        self.load = f"load-{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        # made here and by no task: one that outlives a failed load must not make it again
        store_of(path)[0].create_dir(self._folder, recursive=True)

    @property
    def _folder(self) -> str:
        return f"{store_of(self.path)[1]}/_temporary/{self.load}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        from pyspark import TaskContext
        task = TaskContext.get()
        name, out = f"part-{task.partitionId():06d}-{task.taskAttemptId()}{SUFFIX}", None
        store, _ = store_of(self.path)
        try:
            for batch in iterator:
                # a row at a time: an input batch may hold many long pages
                for i in range(batch.num_rows):
                    if out is None:
                        out = store.open_output_stream(f"{self._folder}/{name}", compression=None)
                    out.write(record_of(batch.slice(i, 1).to_pylist()[0]))
        finally:
            if out is not None:
                out.close()
        return _Written(name if out is not None else None)

    def commit(self, messages: list) -> None:
        store, root = store_of(self.path)
        names = {m.name for m in messages if m is not None and m.name}
        if not names:
            self.abort(messages)
            return
        for f in store.get_file_info(pafs.FileSelector(self._folder)):
            if f.base_name not in names:
                store.delete_file(f.path)
        store.move(self._folder, f"{root}/{self.load}")

    def abort(self, messages: list) -> None:
        store, _ = store_of(self.path)
        if store.get_file_info(self._folder).type == pafs.FileType.Directory:
            # under another name first, so that no late task adds a file while it is emptied
            gone = f"{self._folder}-aborted"
            store.move(self._folder, gone)
            store.delete_dir(gone)


class PageArchive(DataSource):
    """``format("page_archive")``; options ``path`` and ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return PAGE_SCHEMA

    def _size(self) -> int:
        size = int(self.options.get("splitBytes", SPLIT_BYTES))
        if size <= 0:
            raise ValueError("splitBytes must be positive")
        return size

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], self._size())

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return _StreamReader(self.options["path"], self._size())

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("an archive only grows: write with mode append")
        return _Writer(self.options["path"])


def register(spark: SparkSession) -> None:
    share_package(spark)
    spark.dataSource.register(PageArchive)


def write_archive(pages: DataFrame, path: str) -> None:
    """Append ``pages`` (columns of ``PAGE_SCHEMA``; those it lacks are null) as one load."""
    register(pages.sparkSession)
    have = [f.name for f in PAGE_SCHEMA.fields if f.name in pages.columns]
    pages.select(*have).write.format(FORMAT).mode("append").save(path)


def read_archive(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    register(spark)
    return spark.read.format(FORMAT).option("splitBytes", split_bytes).load(path)


def read_archive_stream(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    register(spark)
    return spark.readStream.format(FORMAT).option("splitBytes", split_bytes).load(path)

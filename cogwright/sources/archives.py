"""Web archives by byte ranges: a data source that splits files, an index of their records, and reads of single captures.

Compressed archives have a gzip member for each record, so a split finds its first one and any record can be read by
its own bytes. A file system that pyarrow knows is named by a URI; other paths are local.
"""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .warc import parse_warc

SPLIT_BYTES = 64 << 20
CHUNK = 1 << 20
#: Bytes of records after which a task hands on what it has.
BATCH_BYTES = 8 << 20
MAGIC = b"\x1f\x8b\x08"
_ROW = "record_id string, kind string, url string, captured_at string, digest string, truncated string, status int, headers map<string,string>, body binary, error string"
MEMBERS = f"file string, offset long, length long, {_ROW}"


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        uri = "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), path


def _one(raw: bytes, kinds: Sequence[str] = ()) -> tuple:
    """The columns of _ROW of the first record of these bytes that has one of the kinds (of any, if none are named)."""
    for _, *row in parse_warc(raw):
        if row[-1] is not None or not kinds or row[1] in kinds:
            return tuple(row)
    return (*[None] * 9, "no record")


class _Members:
    """Gzip members of an open file from a place on: (offset, length, bytes or None if it is broken)."""

    def __init__(self, f, size: int) -> None:
        self.f, self.size = f, size

    def _at(self, offset: int, n: int = CHUNK) -> bytes:
        self.f.seek(offset)
        return self.f.read(min(n, max(self.size - offset, 0)))

    def _begins(self, offset: int) -> bool:
        try:
            return zlib.decompressobj(31).decompress(self._at(offset, 4096), 8).startswith(b"WARC/")
        except zlib.error:
            return False

    def first(self, start: int, end: int) -> int:
        """The first place from start on, and before end, where a member of a record begins; else end."""
        while start < end:
            block = self._at(start)
            at = block.find(MAGIC)
            while at >= 0 and start + at < end:
                if self._begins(start + at):
                    return start + at
                at = block.find(MAGIC, at + 1)
            if start + len(block) >= min(end, self.size):
                break
            start += len(block) - len(MAGIC) + 1
        return end

    def between(self, start: int, end: int) -> Iterator[tuple[int, int, bytes | None]]:
        at = self.first(start, end)
        while at < end:
            d, out, read = zlib.decompressobj(31), [], at
            try:
                while not d.eof:
                    block = self._at(read)
                    if not block:
                        break
                    out.append(d.decompress(block))
                    read += len(block) - len(d.unused_data)
            except zlib.error:
                pass
            if d.eof:
                yield at, read - at, b"".join(out)
                at = read if read >= end or self._at(read, 3) == MAGIC else self.first(read, end)
            else:
                following = self.first(at + 1, self.size)
                yield at, following - at, None
                at = following


def file_members(path: str, start: int, end: int) -> Iterator[tuple]:
    """Rows of MEMBERS, without the file, of the records that begin in start..end-1. An archive that isn't compressed is read whole by its first split."""
    store, name = open_store(path)
    with store.open_input_file(name) as f:
        size = f.size()
        if f.read(2) != MAGIC[:2]:
            if start == 0:
                yield from _plain_members(f, size)
            return
        for offset, length, raw in _Members(f, size).between(start, min(end, size)):
            if raw is None:
                yield offset, length, *[None] * 9, "broken"
            elif raw:  # an empty member ends a record whose length has a high byte
                yield offset, length, *_one(raw)


def _plain_members(f, size: int) -> Iterator[tuple]:
    """From header to header by their lengths, as a body may hold what looks like a record."""
    at = 0
    while at < size:
        f.seek(at)
        head = b""
        while (stop := head.find(b"\r\n\r\n")) < 0 and (more := f.read(4096)):
            head += more
        length = next((int(v) for k, _, v in (x.partition(b":") for x in head[: max(stop, 0)].split(b"\r\n")) if k.strip().lower() == b"content-length" and v.strip().isdigit()), None)
        if stop < 0 or length is None:
            yield at, size - at, *[None] * 9, "not a record"
            return
        n = stop + 4 + length
        f.seek(at)
        raw = f.read(n)
        yield at, n, *(_one(raw) if len(raw) == n else (*[None] * 9, "broken"))
        at += n
        f.seek(at)
        while (gap := f.read(1)) in (b"\r", b"\n"):
            at += 1
        if not gap:
            return


@dataclass
class Split(InputPartition):
    file: str
    start: int
    end: int


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.split = options["path"], int(options.get("splitbytes", SPLIT_BYTES))

    def partitions(self) -> list[Split]:
        store, root = open_store(self.path)
        info = store.get_file_info(root)
        files = [info] if info.type == pafs.FileType.File else store.get_file_info(pafs.FileSelector(root, recursive=True))
        prefix = self.path.split("://")[0] + "://" if "://" in self.path else ("file://" if self.path.startswith("file:") else "")
        named = sorted((x.path, x.size) for x in files if x.type == pafs.FileType.File and x.size and not x.base_name.startswith(("_", ".")))
        return [Split(prefix + p, at, min(at + self.split, n)) for p, n in named for at in range(0, n, self.split)]

    def read(self, partition: Split) -> Iterator[tuple]:
        if not isinstance(partition, Split):  # Spark asks for one partition where there is none
            return
        for row in file_members(partition.file, partition.start, partition.end):
            yield partition.file, *row


class ArchiveSource(DataSource):
    """Records of the archives below option `path`, dealt over tasks by splits of `splitBytes`."""

    @classmethod
    def name(cls) -> str:
        return "archive_members"

    def schema(self) -> str:
        return MEMBERS

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader({k.lower(): v for k, v in self.options.items()})


def scan_archives(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """MEMBERS of all archives below a path; what can't be read is a row with an error."""
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("archive_members").option("path", path).option("splitBytes", split_bytes).load()


def index_lines(members: DataFrame) -> DataFrame:
    """(file, line, value): index lines of scanned members, as capture_index() reads them; line is the place in the archive."""
    stamp = F.regexp_replace("captured_at", "[^0-9]", "")
    fields = F.struct("url", F.col("status").cast("string").alias("status"), "digest", stamp.alias("timestamp"), F.col("file").alias("filename"), F.col("offset").cast("string").alias("offset"), F.col("length").cast("string").alias("length"))
    return members.filter("error is null and url is not null").select("file", F.col("offset").alias("line"), F.to_json(fields).alias("value"))


def read_captures(index: DataFrame, kinds: Sequence[str] = ("response",)) -> DataFrame:
    """MEMBERS of the places (filename, offset, length) of an index, each read by its own bytes.

    Places are dealt in ranges of file and offset, so a file's captures are read by one task or a few, in their order, and a large
    file by many. Of a place with several records the first of these kinds counts. A place beyond its file, or that isn't
    a record, is a row with an error.
    """
    columns = [x.split()[0] for x in _ROW.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, f, rows, held = None, None, [], 0

        def frame() -> pd.DataFrame:
            return pd.DataFrame(rows, columns=["file", "offset", "length", *columns]).astype({"status": "Int64"})

        for pdf in batches:
            for file, offset, length in zip(pdf["file"], pdf["offset"], pdf["length"], strict=True):
                if file != name:
                    store, at = open_store(file)
                    name, f = file, store.open_input_file(at) if store.get_file_info(at).type == pafs.FileType.File else None
                raw = b""
                if f is not None and 0 <= offset <= f.size():
                    f.seek(offset)
                    raw = f.read(length)
                if f is None or len(raw) != length:
                    rows.append((file, offset, length, *[None] * 9, "no such range"))
                else:
                    rows.append((file, offset, length, *_one(raw, kinds)))
                held += len(raw)
                if held > BATCH_BYTES or len(rows) >= 1000:
                    yield frame()
                    rows, held = [], 0
        yield frame()

    places = index.select(F.col("filename").alias("file"), F.col("offset").cast("long").alias("offset"), F.col("length").cast("long").alias("length"))
    return places.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset").mapInPandas(run, MEMBERS)


def _member(kind: str, url: str, captured_at: str, record_id: str, status: int, headers: dict | list | None, body: bytes | None) -> bytes:
    clean = lambda x: str(x).replace("\r", " ").replace("\n", " ")
    entries = headers.items() if isinstance(headers, dict) else headers or []
    block = f"HTTP/1.1 {status} -\r\n".encode() + "".join(f"{clean(k)}: {clean(v)}\r\n" for k, v in entries).encode() + b"\r\n" + (body or b"")
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{clean(record_id)}>\r\nWARC-Date: {captured_at}\r\nWARC-Target-URI: {clean(url)}\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}\r\n\r\n"
    raw = gzip.compress(head.encode() + block + b"\r\n\r\n", mtime=0)
    return raw if raw[-1] == 0 else raw + gzip.compress(b"", mtime=0)


def write_archive(captures: DataFrame, path: str) -> None:
    """Write captures (kind, url, captured_at as text, record_id, status, headers, body) below a path, a gzip member for each.

    Files come from Spark's committer, so a task that is run again leaves one copy. The text sink ends each row with a byte: that is
    the last one of the member, which is the high byte of its length and so zero (records of 16 MB and more get an
    empty member after them).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            columns = [pdf[c] for c in ("kind", "url", "captured_at", "record_id", "status", "headers", "body")]
            yield pd.DataFrame({"value": [_member(*row)[:-1] for row in zip(*columns, strict=True)]})

    rows = captures.select("kind", "url", "captured_at", "record_id", "status", "headers", "body").mapInPandas(run, "value binary")
    rows.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\u0000").option("compression", "none").text(path)

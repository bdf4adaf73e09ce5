"""Records of web archives: each compressed file is read by one task, record by record."""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

SCHEMA = "file string, position int, record_id string, kind string, url string, captured_at string, digest string, truncated string, status int, headers map<string,string>, body binary, error string"


def _head(f: io.BufferedIOBase) -> dict[str, str] | None:
    """Header lines up to a blank line; None at the end of the file."""
    out: dict[str, str] = {}
    first = f.readline()
    while first in (b"\r\n", b"\n"):
        first = f.readline()
    if not first:
        return None
    out[""] = first.decode("latin-1").strip()
    for line in iter(f.readline, b""):
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if not text:
            break
        k, _, v = text.partition(":")
        out[k.strip().lower()] = v.strip()
    return out


def parse_warc(raw: bytes) -> Iterator[tuple]:
    """(position, record_id, kind, url, date, digest, truncated, status, headers, body, error) of each record."""
    f: io.BufferedIOBase = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(raw))) if raw[:2] == b"\x1f\x8b" else io.BytesIO(raw)
    position = 0
    try:
        while (head := _head(f)) is not None:
            if not head[""].startswith("WARC/"):
                yield position, None, None, None, None, None, None, None, None, None, "not a record"
                return
            block = f.read(int(head.get("content-length", "0")))
            status, headers, body = None, None, block
            if head.get("warc-type") in ("response", "revisit") and block.startswith(b"HTTP/"):
                inner = io.BytesIO(block)
                http = _head(inner) or {"": ""}
                words = http.pop("").split()
                status = int(words[1]) if len(words) > 1 and words[1].isdigit() else None
                headers, body = http, inner.read()
            yield position, head.get("warc-record-id"), head.get("warc-type"), head.get("warc-target-uri"), head.get("warc-date"), head.get("warc-payload-digest"), head.get("warc-truncated"), status, headers, body, None
            position += 1
    except (OSError, EOFError, ValueError) as e:
        yield position, None, None, None, None, None, None, None, None, None, f"broken: {type(e).__name__}"


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives below a path; what can't be read is a row with an error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["position", "record_id", "kind", "url", "captured_at", "digest", "truncated", "status", "headers", "body", "error"]
        for pdf in batches:
            for file, content in zip(pdf["path"], pdf["content"], strict=True):
                rows = []
                for row in parse_warc(content):
                    rows.append((file, *row))
                    if len(rows) == 256:
                        yield pd.DataFrame(rows, columns=["file", *columns]).astype({"status": "Int64"})
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=["file", *columns]).astype({"status": "Int64"})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, SCHEMA)

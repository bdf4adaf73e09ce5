"""Archives read by splits and by single ranges."""

import gzip
import random

import pytest

from cogwright.sources import archives, warc

CAPTURES = "kind string, url string, captured_at string, record_id string, status int, headers map<string,string>, body binary"


def captures(n, seed=1):
    rng = random.Random(seed)
    body = lambda i: b"\x1f\x8b\x08\x00WARC/1.0\r\n" * (i % 3) + rng.randbytes(rng.randrange(0, 3000))
    return [("revisit" if i % 5 == 4 else "response", f"http://h{i % 3}/{i}", f"2024-01-01T00:00:{i % 60:02d}Z", f"urn:x:{i}", 304 if i % 5 == 4 else 200, {"etag": f'"{i}"', "bad": "a\r\nb"}, bytearray(body(i))) for i in range(n)]


@pytest.fixture
def archive(spark, tmp_path):
    rows = captures(300)
    archives.write_archive(spark.createDataFrame(rows, CAPTURES).repartition(3), str(tmp_path / "a"))
    return str(tmp_path / "a"), rows


def test_splits_and_ranges(spark, archive):
    path, rows = archive
    whole = archives.scan_archives(spark, path, 20_000)
    assert whole.rdd.getNumPartitions() > 6
    got = whole.collect()
    assert sorted((r.kind, r.url, r.status, r.headers["etag"], bytes(r.body)) for r in got) == sorted((r[0], r[1], r[4], r[5]["etag"], bytes(r[6])) for r in rows)
    assert len(archives.scan_archives(spark, path).collect()) == len(archives.scan_archives(spark, path, 777).collect()) == 300
    index = spark.createDataFrame([(r.file, r.offset, r.length) for r in got if r.kind == "response"], "filename string, offset long, length long")
    by_place = {(r.file, r.offset): r for r in got}
    found = archives.read_captures(index).collect()
    assert len(found) == index.count() and all(r == by_place[r.file, r.offset] for r in found)
    # The files are plain gzip: any reader has all records in them.
    assert sorted(r.record_id for r in warc.read_warc(spark, path + "/part-*").collect()) == sorted(r.record_id for r in got)


def test_lines_of_index(spark, archive):
    from cogwright.sources.documents import capture_index

    path, rows = archive
    lines = archives.index_lines(archives.scan_archives(spark, path))
    listed = capture_index(lines, "h1", "")
    found = archives.read_captures(listed, ("response", "revisit"))
    assert sorted(r.url for r in found.collect()) == sorted(r[1] for r in rows if r[1].startswith("http://h1/"))


def test_broken_members_and_places(spark, tmp_path):
    (tmp_path / "d").mkdir()
    good = [archives._member("response", f"http://h/{i}", "2024-01-01T00:00:00Z", f"r{i}", 200, {}, b"x" * 500) for i in range(3)]
    (tmp_path / "d" / "a.gz").write_bytes(good[0] + good[1][:40] + good[2])
    found = archives.scan_archives(spark, str(tmp_path / "d")).orderBy("offset").collect()
    assert [(r.url, r.error) for r in found] == [("http://h/0", None), (None, "broken"), ("http://h/2", None)]
    file = str(tmp_path / "d" / "a.gz")
    odd = spark.createDataFrame([(file, 0, len(good[0])), (file, 5, 10), (file, 10**9, 4), (file + "no", 0, 4), (file, 0, 20)], "filename string, offset long, length long")
    got = sorted((r.offset, r.length, r.url, r.error) for r in archives.read_captures(odd).collect())
    assert [x[2:] for x in got] == [(None, "no such range"), (None, "broken: EOFError"), ("http://h/0", None), (None, "not a record"), (None, "no such range")]


def test_plain_archive(spark, tmp_path):
    """Without compression records are found by their lengths, not by how they look."""
    inner = gzip.decompress(archives._member("response", "http://inner", "2024-01-01T00:00:00Z", "i", 200, {}, b"z"))
    raw = b"".join(gzip.decompress(archives._member("response", f"http://h/{i}", "2024-01-01T00:00:00Z", f"r{i}", 200, {}, b"\r\n\r\n" + inner * i)) for i in range(3))
    (tmp_path / "a.warc").write_bytes(raw)
    rows = archives.scan_archives(spark, str(tmp_path / "a.warc"), 100).orderBy("offset").collect()
    assert [(r.url, r.error) for r in rows] == [(f"http://h/{i}", None) for i in range(3)]
    index = spark.createDataFrame([(r.file, r.offset, r.length) for r in rows], "filename string, offset long, length long")
    assert archives.read_captures(index).orderBy("offset").collect() == rows
    (tmp_path / "b.warc").write_bytes(b"no archive at all")
    assert [r.error for r in archives.scan_archives(spark, str(tmp_path / "b.warc")).collect()] == ["not a record"]
    (tmp_path / "empty").mkdir()
    assert archives.scan_archives(spark, str(tmp_path / "empty")).count() == 0


def test_large_record():
    raw = archives._member("response", "http://h", "2024-01-01T00:00:00Z", "r", 200, {}, b"\x01" * (17 << 20))
    assert raw[-1] == 0 and len(gzip.decompress(raw)) > 17 << 20

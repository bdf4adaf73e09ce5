"""Quoted files split by blocks, against csv.reader on the whole file."""

import csv
import io
import random

import pytest

from cogwright.sources import bulk, quoted

SPEC = bulk.DatasetSpec("t", (), ("A",), delimiter=",", header=True, quote='"')


@pytest.fixture
def small_splits(spark):
    for k, v in {"spark.sql.files.maxPartitionBytes": "60", "spark.sql.files.openCostInBytes": "1"}.items():
        spark.conf.set(k, v)
    yield
    for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(k)


def plain(raw):
    text = raw.decode("latin-1").translate(quoted.CP1252)
    reader = csv.reader(io.StringIO(text, newline=""))
    return sorted((reader.line_num, row) for row in reader if any(x.strip() for x in row))


def split(spark, path):
    states = quoted.block_states(spark, str(path), ",", '"')
    from pyspark.sql import functions as F

    found = quoted.quoted_records(spark, str(path), states.drop("head").withColumn("layout", F.lit(0)), ",", '"').collect()
    return sorted((r.line, r.fields) for r in found)


@pytest.mark.parametrize("seed", range(4))
def test_as_csv_reader(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    ends = ["\n", "\r\n", "\n", "\r"] if seed % 2 else ["\n"]
    text = "".join(rng.choice([*'ab,,"', '""', ' "', '",', 'x" y', "word\x92s", "", "\x0b\x1c", *ends]) for _ in range(700))
    raw = (text + ("\n" if seed % 3 else "")).encode("latin-1")
    (tmp_path / "a.csv").write_bytes(raw)
    assert split(spark, tmp_path / "a.csv") == plain(raw)


@pytest.mark.parametrize("text", ['a,b\n1,6" bolt\n2,b\n3,"c\nd"\n4,""\n5,end\n', 'a\n"never closed\n' + "x\n" * 80, 'a\n"x"y,"z\n', "", "\n\n", '"', 'a,b\n"' + "q\n" * 70 + '",1\n2,3'])
def test_stray_and_unclosed(spark, tmp_path, small_splits, text):
    (tmp_path / "a.csv").write_bytes(text.encode())
    assert split(spark, tmp_path / "a.csv") == plain(text.encode())


def test_stray_quote_loses_nothing(spark, tmp_path):
    (tmp_path / "a.csv").write_text('A,B\n1,6" bolt\n2,b\n3,"c\nd"\n4,""\n5,end\n')
    records, rejects = bulk.read_dataset(spark, str(tmp_path / "a.csv"), SPEC)
    assert sorted((r.A, r.B, r.line) for r in records.collect()) == [("1", '6" bolt', 2), ("2", "b", 3), ("3", "c\nd", 5), ("4", "", 6), ("5", "end", 7)]
    assert rejects.count() == 0


def test_long_record_is_a_reject(spark, tmp_path, small_splits, monkeypatch):
    monkeypatch.setattr(quoted, "RECORD_CHARS", 100)
    (tmp_path / "a.csv").write_text('A,B\n1,x\n2,"' + "line\n" * 60 + '"\n3,y\n')
    records, rejects = bulk.read_dataset(spark, str(tmp_path / "a.csv"), SPEC)
    assert sorted((r.A, r.B) for r in records.collect()) == [("1", "x"), ("3", "y")]
    assert [(r.error_type, r.raw_text, r.line) for r in rejects.collect()] == [("too_long", None, 63)]
    monkeypatch.setattr(quoted, "SENT_BLOCKS", 0)
    assert bulk.read_dataset(spark, str(tmp_path / "a.csv"), SPEC)[0].count() == 2

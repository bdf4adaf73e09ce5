"""The pipeline's stages on odd tables: nulls, repeated rows, clashing names, very long texts, and nothing at all; archives into revisits."""

import pytest

import corpus_pipeline
from cogwright.llm import revisits
from cogwright.llm.common import materialize

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, _id string, _row long, _mark string, anchor long, length string, _key string, _size string"


def documents():
    prose = "the quick brown fox jumps over the lazy dog while many other animals look on and wonder why it does"
    rows = [
        (1, prose, "en", "a"), (1, prose, "en", "a"), (2, prose + " today", "en", "a"), (None, "a text without an id that says enough to be judged", None, None), (None, None, None, "b"), (3, "", "en", None), (4, " \n\t", "de", "b"),
        (5, "first line here\nsecond line here\nthird", "en", "b"), (6, "first line here\nsecond line here\nother", "en", "b"), (7, "word " * 60_000, "en", "c"), (8, "x" * 200_000, None, "c"),
    ]
    return [(*r, len(r[1] or ""), "id", 1, "m", 2, "l", "k", "s") for r in rows]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame(documents(), COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (4, 0, 0), (7, 0, 0), (2, 1, 0), (None, 0, 1), (9, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.mark.parametrize("stage", range(4))
def test_stage_keeps_columns(spark, folder, stage):
    name, f = corpus_pipeline.STAGES[stage]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = f(spark, docs, folder)
    assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
    got = out.collect()
    again = sorted(map(repr, f(spark, docs, folder).collect()))
    assert sorted(map(repr, got)) == again
    empty = f(spark, materialize(docs.limit(0), "none"), folder)
    assert empty.columns == docs.columns and empty.count() == 0
    if name == "near dedup":
        assert sorted(r.doc_id for r in got if r.doc_id in (1, 2)) == [1, 1]
    if name == "line dedup":
        assert {r.doc_id: r.text for r in got if r.doc_id in (5, 6)} == {5: "first line here\nsecond line here\nthird", 6: "other"}
    if name in ("near dedup", "line dedup"):
        assert sum(r.text is None for r in got) == 1 and sum(r.text == "" for r in got) == 1


def test_run(spark, folder, tmp_path):
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = out.collect()
    assert rows and all(0 < r.length <= 1024 and r.offset + r.length <= 1024 for r in rows)
    none = str(tmp_path)
    spark.createDataFrame([], COLUMNS).write.parquet(f"{none}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{none}/labels.parquet")
    assert corpus_pipeline.run(spark, none).collect() == []


def test_unlabelled_documents_stay(spark, folder):
    from cogwright.llm import quality

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert quality.keep_good(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == docs.count()


def test_archive_into_revisits(spark, sf_dir):
    plain = sorted(map(tuple, revisits.revisit_report(spark, sf_dir).collect()))
    through = sorted(map(tuple, revisits.archive_report(spark, sf_dir).collect()))
    assert plain == through and any(r[3] == "resolved" for r in plain)


def test_odd_archive_records(spark):
    schema = "record_id string, url string, captured_at string, kind string, status int, headers map<string,string>, error string"
    rows = [("<urn:x:5>", "http://a", "2024-01-01T00:00:00Z", "response", 200, {"etag": "e"}, None), ("odd", "http://a", "never", "revisit", 304, None, None), ("<r:1>", "u", None, "revisit", 200, {}, None), (None, None, None, None, None, None, "broken")]
    got = revisits.archive_captures(spark.createDataFrame(rows, schema)).collect()
    assert [(r.kind, r.etag, r.captured_at is None) for r in got] == [("response", "e", False), ("revisit", None, True)] and got[0].record_id == 5

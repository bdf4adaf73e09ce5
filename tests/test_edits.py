"""Edits of one key in one batch do what they would do in batches of their own."""

import hashlib
import json
import random

from cogwright.operators import edits

REQUEST = "k string, request_id long, action string, payload string, expected_revision long, expected_base_sha256 string"
HEAD = "k string, revision long, payload string, status string"


def base_of(source):
    return hashlib.sha256(json.dumps(source, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def fold(spark, heads, requests, sources):
    return edits.fold_edits(spark.createDataFrame(heads, HEAD), spark.createDataFrame(requests, REQUEST), spark.createDataFrame(sources, "k string, payload string"), ["k"]).collect()


def test_chain_in_one_batch(spark):
    source = {"name": "é", "n": 1, "x": None}
    base = base_of(source)
    asked = [
        ("a", 1, "update", '{"name":"new"}', 0, base), ("a", 2, "retire", None, 1, None), ("a", 3, "retire", None, 2, None), ("a", 4, "update", '{"n":2}', 2, base), ("a", 5, "update", '{"n":3}', 2, base),
        ("a", 6, "restore", None, 3, None), ("a", 7, "update", '{"name":"é","x":null}', 4, base), ("a", 8, "update", '{"n":9}', 5, "old"), ("a", 9, "restore", None, 5, None),
        ("gone", 1, "update", "{}", 0, base), ("m", 1, "update", '{"q":null}', 4, base_of({})), ("a", 10, "drop", None, 5, None),
    ]
    heads = [("m", 4, '{"q":1}', "active"), ("still", 7, '{"z":1}', "retired")]
    sources = [("a", json.dumps(source)), ("b", "{}")]
    got = fold(spark, heads, asked, sources)
    assert {(r.k, r.request_id): r.reason for r in got if r.kind == "conflict"} == {("a", 3): "retired", ("a", 5): "revision", ("a", 8): "source_changed", ("a", 9): "not_retired", ("a", 10): "action", ("gone", 1): "not_found"}
    assert {r.k: (r.revision, r.status, r.payload) for r in got if r.kind == "head"} == {"a": (5, "active", '{"n":2}'), "m": (5, "active", '{"q":null}'), "still": (7, "retired", '{"z":1}')}
    # The same, one request a batch.
    events, now = [], heads
    for request in sorted(asked, key=lambda r: r[1]):
        rows = fold(spark, now, [request], sources) if request[0] == "a" else []
        if rows:
            events += [r for r in rows if r.kind == "event"]
            now = [(r.k, r.revision, r.payload, r.status) for r in rows if r.kind == "head"]
    assert [r.after for r in events] == [r.after for r in sorted((r for r in got if r.kind == "event" and r.k == "a"), key=lambda r: r.request_id)]
    assert {h[0]: h[1:] for h in now}["a"] == (5, '{"n":2}', "active")


def test_many_edits_of_one_key(spark):
    asked = [("hot", i, "update", json.dumps({"v": i}), i, base_of({})) for i in range(12_000)]
    random.Random(1).shuffle(asked)
    got = fold(spark, [], asked, [("hot", "{}")])
    assert [r.payload for r in got if r.kind == "head"] == ['{"v":11999}'] and sum(r.kind == "event" for r in got) == 12_000


def test_progress(spark):
    events = [("a", "error", "e1", 1), ("a", "pending", None, 2), ("b", "done", None, 1), ("b", "error", "late", 2), ("c", "pending", None, 9), ("d", "error", "x" * 600, 2), ("d", "done", None, 3), ("f", "pending", None, 1), ("g", "error", "y" * 600, 1)]
    existing = [("c", "done", None), ("d", "pending", None), ("e", "error", "old"), ("c2", "error", "kept")]
    got = edits.fold_progress(spark.createDataFrame(events, "k string, status string, error string, t int"), spark.createDataFrame(existing, "k string, status string, error string"), ["k"], ["t"])
    assert {r.k: (r.status, r.error) for r in got.collect()} == {
        "a": ("error", "e1"), "b": ("error", "late"), "c": ("done", None), "d": ("done", None), "e": ("error", "old"), "c2": ("error", "kept"), "f": ("pending", None), "g": ("error", "y" * 500),
    }

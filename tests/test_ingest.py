"""Eight types of records from pages, with ids that stay."""

from pyspark.sql import functions as F

from cogwright.operators import ingest

SCHEMAS = {
    "vehicles": "page_id long, catalog_brand string, external_id string, model string, prod_period string, name string, source_url string",
    "taxonomies": "page_id long, place int, path array<string>, source_url string",
    "diagrams": "page_id long, place int, code string, name string, range string, path array<string>, source_url string",
    "parts": "page_id long, place int, brand string, number string, name string, diagram_code string, diagram_name string, callout string, quantity string, range string, condition string, note string, source_url string",
    "hints": "page_id long, place int, brand string, number string, text string, source_url string",
    "relations": "page_id long, place int, number string, to_number string, relation_type string, source_url string",
}
ROWS = {
    "vehicles": [(1, "B", "x", "m", None, "n", "u1"), (2, "B", "x", "m", None, "n", "u1"), (3, "B", "y", "m", "p", "n", "u3")],
    "taxonomies": [(1, 0, ["a", "b"], "u1"), (1, 1, ["a", "c"], "u1"), (2, 0, ["a", "b"], "u1"), (3, 0, ["z"], "u3"), (9, 0, ["lost"], "u9")],
    "diagrams": [(1, 0, "D1", "One", None, ["a", "b"], "u1"), (1, 1, "D2", "Two", None, ["q"], "u1"), (2, 0, "D1", "One", None, ["a", "b"], "u1"), (3, 0, None, "Only", None, None, "u3")],
    "parts": [
        (1, 0, None, "N-1", "ASSY, x", "D1", None, "1", "2", None, None, None, "u1"), (1, 1, "Q", "N-2", None, None, "Two", None, None, None, None, None, "u1"), (1, 2, None, "N-3", None, "none", None, None, None, None, None, None, "u1"),
        (2, 0, None, "N-1", None, "D1", None, "1", "2", None, None, None, "u1"), (3, 0, None, "N-4", None, None, None, None, None, None, None, None, "u3"), (9, 0, None, "N-9", None, None, None, None, None, None, None, None, "u9"),
    ],
    "hints": [(1, 0, "B", "N-1", "fits", "u1"), (1, 1, "B", "N-1", "fits", "u1"), (1, 2, None, "N-9", "fits too", "u1")],
    "relations": [(1, 0, "N-9", "N-10", "replaces", "u1")],
}


def pages(spark, keep=lambda page: True):
    return {k: spark.createDataFrame([r for r in ROWS[k] if keep(r[0])], s) for k, s in SCHEMAS.items()}


def records(store, kind, *columns):
    return sorted(tuple(r[c] for c in ("id", *columns)) for r in store[kind].collect())


def test_ids_and_edges(spark):
    store, created = ingest.ingest_pages(pages(spark), ingest.empty_store(spark), "p1", False, "page")
    assert {r.record_type: r.created for r in created.collect()} == {"vehicle": 2, "taxonomy_node": 4, "diagram": 3, "part_number": 5, "part_occurrence": 3, "fitment": 3, "compatibility_hint": 2, "part_relation": 1}
    assert records(store, "taxonomy_node", "vehicle_id", "path", "parent_path") == [(1, 1, "a", None), (2, 1, "a > b", "a"), (3, 1, "a > c", "a"), (4, 2, "z", None)]
    assert records(store, "diagram", "code", "taxonomy_id") == [(1, "D1", 2), (2, "D2", None), (3, None, 4)]
    assert records(store, "part_number", "brand", "number", "is_assembly") == [(1, "B", "N-1", True), (2, "Q", "N-2", False), (3, "B", "N-3", False), (4, None, "N-9", False), (5, "B", "N-4", False)]
    assert records(store, "part_occurrence", "part_id", "diagram_id")[0] == (1, 1, 1)
    edges = {(r.record_type, r.record_id, r.page_id) for r in store["record_source"].collect()}
    assert {("vehicle", 1, 1), ("vehicle", 1, 2), ("part_occurrence", 1, 1), ("part_occurrence", 1, 2)} <= edges
    again, nothing = ingest.ingest_pages(pages(spark), store, "p1", False, "page")
    assert {r.created for r in nothing.collect()} == {0}
    assert all(sorted(map(tuple, again[k].collect()), key=repr) == sorted(map(tuple, store[k].collect()), key=repr) for k in store)


def test_later_pages_follow(spark):
    first, _ = ingest.ingest_pages(pages(spark, lambda p: p != 1), ingest.empty_store(spark), "p1", True, "page")
    both, created = ingest.ingest_pages(pages(spark), first, "p1", True, "page")
    before = dict((r.id, r.number) for r in first["part_number"].collect())
    after = dict((r.id, r.number) for r in both["part_number"].collect())
    assert before.items() <= after.items() and sorted(after) == list(range(1, len(after) + 1))
    assert {r.record_type: r.created for r in created.collect()}["vehicle"] == 0
    assert {r.confidence for r in both["fitment"].collect()} == {1.0}


def test_empty(spark):
    store, created = ingest.ingest_pages(pages(spark, lambda p: False), ingest.empty_store(spark), "p1", True, "page")
    assert all(df.count() == 0 for df in store.values()) and {r.created for r in created.collect()} == {0}


def test_derived_columns_and_narrower_keys(spark):
    store = spark.createDataFrame([(1, 5, None, "FIVE")], "id long, k long, k2 string, name string")
    rows = spark.createDataFrame([(1, 5, None, "five"), (2, 6, "x", "six"), (3, 6, "x", "later"), (4, 6, None, "none")], "page_id long, k int, k2 string, text string")
    table, resolved, created = ingest.get_or_create(store.withColumn("text", F.lower("name")), rows, ["k", "k2"], ["page_id"], {"name": F.upper("text")})
    assert sorted((r.page_id, r.id) for r in resolved.collect()) == [(1, 1), (2, 2), (3, 2), (4, 3)]
    assert sorted((r.id, r.k, r.name) for r in table.collect()) == [(1, 5, "FIVE"), (2, 6, "SIX"), (3, 6, "NONE")]
    assert created.count() == 2


def test_lookups_beyond_the_bound(spark, monkeypatch):
    """Vehicles and diagrams that are too many to broadcast give the same records."""
    store, _ = ingest.ingest_pages(pages(spark), ingest.empty_store(spark), "p1", False, "page")
    monkeypatch.setattr(ingest, "BROADCAST_ROWS", 0)
    joined, _ = ingest.ingest_pages(pages(spark), ingest.empty_store(spark), "p1", False, "page")
    assert all(sorted(map(tuple, joined[k].collect()), key=repr) == sorted(map(tuple, store[k].collect()), key=repr) for k in store)

"""Reviewed links, part fitments with manual rows, and vehicles by the names that brands use, on literal rows."""

from pyspark.sql import functions as F

from cogwright.operators import entities, mappings, overlay
from cogwright.sources.pages import vehicle_record

DECODE = "vin string, make string, model string, engine string, trim string, model_year int, error_code string"
LINK = "mapping_id long, vin string, vehicle_id long, make string, model string, engine string, trim string, model_year int, source string, reference string"
PART = "part_id long, vehicle_id long, make string, model string, engine string, trim string, production_from string, production_to string, part_name string, part_range string, part_from string, part_to string"


def vehicle(part, v, engine="E-1", model="Corolla", start="2000-01", end="2005-12", **more):
    row = {"part_name": "bolt", "part_range": None, "part_from": None, "part_to": None} | more
    return (part, v, "Toyota", model, engine, "GL", start, end, row["part_name"], row["part_range"], row["part_from"], row["part_to"])


def statuses(spark, decodes, links, parts):
    out = mappings.mapping_view(spark.createDataFrame(decodes, DECODE), spark.createDataFrame(links, LINK), spark.createDataFrame(parts, PART))
    return {(r.vin, r.mapping_id): r.mapping_status for r in out.collect()}


FULL = ("V1", "TOYOTA", "corolla", "E1", "gl", 2003, "0")
LINKED = (1, "V1", 7, "toyota", "COROLLA", "e1", "G-L", 2003, "vpic", None)


def test_link_by_keys_needs_the_only_vehicle(spark):
    assert statuses(spark, [FULL], [LINKED], [vehicle(1, 7)]) == {("V1", 1): "confirmed"}
    assert statuses(spark, [FULL], [LINKED], [vehicle(1, 7), vehicle(2, 8)]) == {("V1", 1): "stale"}
    # The other vehicle has no months, or was not made that year: it is no candidate.
    assert statuses(spark, [FULL], [LINKED], [vehicle(1, 7), vehicle(2, 8, start=None, end=None), vehicle(3, 9, end="2002-01")]) == {("V1", 1): "confirmed"}
    assert statuses(spark, [FULL], [(*LINKED[:7], 2004, *LINKED[8:])], [vehicle(1, 7)]) == {("V1", 1): "stale"}
    assert statuses(spark, [FULL], [LINKED], []) == {("V1", 1): "stale"}


def test_links_by_hand(spark):
    named = (2, "V1", 7, "TOYOTA", "corolla", "E1", "gl", 2003, mappings.BY_NAME, "ref")
    assert statuses(spark, [FULL], [named], [vehicle(1, 7, engine="other", model="Levin")]) == {("V1", 2): "confirmed_manual_override"}
    assert statuses(spark, [FULL], [(*named[:9], " ")], [vehicle(1, 7)]) == {("V1", 2): "stale"}
    assert statuses(spark, [FULL], [(*named[:4], "Corolla", *named[5:])], [vehicle(1, 7)]) == {("V1", 2): "stale"}
    assert statuses(spark, [FULL], [named], [vehicle(1, 7, start=None, end=None)]) == {("V1", 2): "stale"}
    few = ("V2", "Toyota", " Corolla ", None, "", 2003, "8")
    sparse = (3, "V2", 7, "Toyota", "Corolla", "E-1", "GL", 2003, mappings.SPARSE, "ref")
    assert statuses(spark, [few], [sparse], [vehicle(1, 7)]) == {("V2", 3): "confirmed_manual_override"}
    # What the decode lacks has to be the vehicle's.
    assert statuses(spark, [few], [sparse], [vehicle(1, 7, engine="E-2")]) == {("V2", 3): "stale"}


def test_decodes_without_links_nulls_and_repeats(spark):
    none = (None, None, None, None, None, None, None)
    got = statuses(spark, [FULL, ("V3", None, None, None, None, None, None), none], [LINKED, (4, "V1", None, *[None] * 7), (None, None, 7, *[None] * 7)], [vehicle(1, 7), vehicle(1, 7)])
    assert got == {("V1", 1): "confirmed", ("V1", 4): "unmapped", ("V3", None): "unmapped", (None, None): "unmapped"}


def test_parts_by_links(spark):
    parts = [
        vehicle(1, 7), vehicle(2, 7, part_from="2004-01"), vehicle(3, 7, part_from="2002-05", part_to="2003-01"), vehicle(4, 7, part_range="odd"), vehicle(5, 7, part_name=" "),
        vehicle(6, 7, part_from="2003-09", part_to="2003-02"), vehicle(7, 7, part_to="2010-01"), vehicle(8, 9, end="2002-01"),
    ]
    rows = mappings.fitments_by_link(spark.createDataFrame([FULL], DECODE), spark.createDataFrame([LINKED], LINK), spark.createDataFrame(parts, PART)).collect()
    assert {(r.part_id, r.fitment_from, r.fitment_to) for r in rows} == {(1, "2000-01", "2005-12"), (3, "2002-05", "2003-01"), (7, "2000-01", "2005-12")} and len(rows) == 3
    assert {r.derivation for r in rows} == {"compatible_by_model_year_engine_trim"} and min(r.id for r in rows) == 2**32 + 1
    # Where the catalog is blank, a link of a sparse decode may speak for it.
    blank = [vehicle(1, 7, engine=None)]
    sparse = [(3, "V1", 7, "TOYOTA", "corolla", "E1", "gl", 2003, mappings.SPARSE, "ref")]
    rows = mappings.fitments_by_link(spark.createDataFrame([FULL], DECODE), spark.createDataFrame(sparse, LINK), spark.createDataFrame(blank, PART)).collect()
    assert [(r.part_id, r.derivation) for r in rows] == [(1, "manual_vehicle_override")]
    assert statuses(spark, [FULL], sparse, blank) == {("V1", 3): "stale"}


def test_part_fitments_follow_edits(spark):
    snapshot = spark.createDataFrame([(i, n, "p", "mk", "md", 2000, None) for i, n in ((1, "a-1"), (2, "b 2"), (3, "c3"), (4, "d4"), (5, None), (6, " - "))], "part_id long, part_number string, part_name string, make string, model string, year_from int, year_to int")
    heads = spark.createDataFrame([(1, "z 9", None, "active", 3), (2, "y8", None, "draft", 1), (3, None, "named", "draft", 2), (4, None, None, "retired", 1)], "part_id long, number string, name string, status string, revision int")
    manual = spark.createDataFrame([("Z-9", "by hand", "mk", "md", 1, 2), (None, "none", "mk", "md", 1, 2)], "part_number string, part_name string, make string, model string, year_from int, year_to int")
    got = sorted(tuple(r) for r in mappings.part_fitments(snapshot, heads, manual).select("number", "kind", "part_number", "part_name", "revision").collect())
    assert got == [("C3", "catalog", "c3", "named", 2), ("Z9", "catalog", "z 9", "p", 3), ("Z9", "manual", "Z-9", "by hand", 0)]


def test_vehicle_names_of_brands(spark):
    rows = [
        (1, {"Brand": "Toyota", "Frame": "ZZE", "Model": "", "Destination": "EU", "Grade": "G"}), (2, {"make": "AUDI AG", "Sales Type": "8P", "Model Year:": "01.2010 - 03.2012"}),
        (3, {"brand": "", "make": "Renault", "Type": "T", "Gearbox": "B"}), (4, {"NPL": "n", "Frame": "f"}), (5, {"frame": "f", "options": "o"}), (6, {}), (7, None),
    ]
    df = spark.createDataFrame(rows, "k long, m map<string,string>").select("k", vehicle_record(F.col("m")).alias("v"))
    got = {r.k: r.v for r in df.collect()}
    # The first name that is there counts, even where it is empty.
    assert (got[1].model, got[1].options, got[1].description, got[1].brand_normalized) == ("", "EU", "G", "TOYOTA")
    assert (got[2].brand, got[2].model, got[2].production_from, got[2].production_to, got[2].production_precision) == ("AUDI AG", "8P", "2010-01", "2012-03", "month")
    assert (got[3].model, got[3].options, got[3].brand, got[3].brand_normalized) == ("T", "B", "", None)
    assert (got[4].model, got[4].production_precision) == ("n", "unknown")
    assert got[5] is None and got[6] is None and got[7] is None
    # Names that are one count by the last; a missing value is an empty one.
    pairs = lambda *kv: vehicle_record(F.create_map(*(F.lit(x) for x in kv)))["model"]
    assert list(spark.range(1).select(pairs("Model", "a", "model:", "b"), pairs("model:", "b", " MODEL ", None, "brand", "x")).first()) == ["b", ""]


def test_diagrams_keep_nulls_and_need_a_category(spark):
    groups = spark.createDataFrame([(1, 5, "c", None, None, "u"), (2, 6, "c", "n", "x", None)], "group_id long, category_id long, code string, name string, uid string, url string")
    got = entities.diagrams(groups, spark.createDataFrame([(5, 9, None)], "category_id long, vehicle_id long, cid string")).collect()
    assert [(r.id, r.taxonomy_node_id, r.diagram_name_raw, r.metadata_json) for r in got] == [(1, 3, "", '{"category_id":5,"category_cid":null,"group_uid":null}')]
    runs = spark.createDataFrame([(1, "sample", 5), (2, "sample", 5), (3, "full", 9)], "run_id long, status string, started_at int")
    view = spark.createDataFrame([(10,), (20,), (30,)], "id long")
    seen = spark.createDataFrame([(10, 1), (20, 2), (30, 3)], "id long, run_id long")
    assert [r.id for r in entities.of_last_sample(view, seen, runs).collect()] == [20]
    assert entities.of_last_sample(view, seen, runs.filter("status = 'none'")).count() == 0


def test_categories_of_several_origins(spark):
    two, four = "category_main string, category_group string", "category_main string, category_group string, category_small string, label string"
    published = spark.createDataFrame([("a", None), ("a", None), ("b", "g"), (None, "g")], two)
    labels = spark.createDataFrame([("a", "", "", "A"), ("b", "g", "s", "B"), (None, "g", "", "never")], four)
    got = {tuple(r) for r in overlay.category_list(published, spark.createDataFrame([("b", "g")], two), labels).collect()}
    none = "unavailable_in_current_hierarchy"
    assert got == {
        ("verified_bounded", "a", "", None, none, "A"), ("verified_bounded", "b", "g", None, none, None), ("verified_bounded", None, "g", None, none, None), ("sample_not_published", "b", "g", None, none, None),
        ("manual_only", "a", "", None, none, "A"), ("manual_only", "b", "g", "s", "manual_only", "B"), ("manual_only", None, "g", None, none, None),
    }


def test_repeated_rows_are_dealt_by_their_number(spark, monkeypatch):
    from cogwright.plans import base

    monkeypatch.setattr(base, "ROWS_PER_TASK", 50)
    rows = spark.range(400).select((F.col("id") % 300).alias("k"), F.when(F.col("id") >= 300, F.lit("a")).otherwise("b").alias("v"))
    taken = base.once(rows, ["k"], ["v"])
    assert taken.rdd.getNumPartitions() == 8
    assert sorted(map(tuple, taken.collect())) == [(k, "a" if k < 100 else "b") for k in range(300)]

"""Pages of a list that is laid out by its order, and how many files they read."""

import pytest
from pyspark.sql import functions as F

from cogwright.operators import overlay, pagestore


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    df = spark.range(10_000).select(F.concat(F.lit("K"), (F.col("id") * 7919 % 10_007).cast("string")).alias("name"), F.col("id"), F.lit("x" * 20).alias("v")).withColumn("name", F.when(F.col("id") % 500 != 3, F.col("name")))
    path = str(tmp_path_factory.mktemp("list"))
    pagestore.write_list(df.repartition(7), path, ["name", "id"], 700)
    rows = sorted(((r.name is not None, r.name or "", r.id) for r in df.collect()))
    return pagestore.PagedList(spark, path, df.schema, ["name", "id"]), [(n if known else None, i) for known, n, i in rows]


def test_pages(stored):
    listed, rows = stored
    assert listed.total == 10_000
    for number in (1, 5, 23, 50, 51, 0):
        page, n = listed.page(number, 200)
        assert n == min(max(number, 1), 50) and [(r.name, r.id) for r in page.collect()] == rows[(n - 1) * 200 : n * 200]
        assert len(page.inputFiles()) <= 2
    assert len(listed.page(1, 10_000)[0].collect()) == 10_000


def test_key_and_prefix(stored):
    listed, rows = stored
    for at in (0, 40, 4_321, 9_999):
        page, n = listed.page_of(rows[at], 200)
        assert n == at // 200 + 1 and rows[at] in [(r.name, r.id) for r in page.collect()] and len(page.inputFiles()) <= 2
    assert listed.rank(("L", 0)) == 10_000 and listed.rank(("A", 0)) == 20
    for prefix in ("K12", "K9", "K", "A", "Z", "K5005"):
        want = [r for r in rows if r[0] and r[0].startswith(prefix)]
        page, n, total = listed.prefix_page(prefix, 2, 50)
        assert total == len(want) and [(r.name, r.id) for r in page.collect()] == want[(n - 1) * 50 : n * 50], prefix


def test_overlay_of_a_page(spark, stored):
    listed, rows = stored
    heads = spark.createDataFrame([(rows[805][1], '{"v":"edited"}', "active"), (rows[806][1], "{}", "retired"), (rows[0][1], '{"v":"other"}', "active")], "id long, payload string, status string")
    page = overlay.effective(listed.page(5, 200)[0], heads, "id", ["v"]).collect()
    assert len(page) == 199 and [r.id for r in page if r.v == "edited"] == [rows[805][1]]


def test_empty(spark, tmp_path):
    df = spark.createDataFrame([], "name string, id long")
    pagestore.write_list(df, str(tmp_path), ["name", "id"])
    listed = pagestore.PagedList(spark, str(tmp_path), df.schema, ["name", "id"])
    assert listed.page(3, 10)[0].collect() == [] and listed.prefix_page("a", 1, 10)[2] == 0 and listed.rank(("a", 1)) == 0

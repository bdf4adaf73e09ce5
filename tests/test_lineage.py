"""Chains of parents and full-run verification."""

from pyspark.sql import functions as F

from cogwright.operators import ancestry, fullrun
from cogwright.plans import evidence as evidence_plans
from cogwright.plans import lineage as lineage_plans


def test_long_chain_and_cycles(spark):
    rows = [(i, i - 1 if i else None) for i in range(300)] + [(1000, 1001), (1001, 1002), (1002, 1000), (1003, 1000), (2000, 1999), (2001, 2000), (None, 5), (7, 6)]
    got = {r.k: (r.root, r.depth, r.defect) for r in ancestry.resolve_chains(spark.createDataFrame(rows, "k long, up long"), "k", "up").collect()}
    assert all(got[i] == (0, i, None) for i in range(300))
    assert all(got[i] == (None, None, "cycle") for i in range(1000, 1004))
    assert got[2000][2] == got[2001][2] == "missing_parent" and len(got) == 306


def test_kinds_in_order(spark):
    order = ("a", "b", "c")
    rows = [("a1", "a", None), ("b1", "b", "a1"), ("c1", "c", "b1"), ("c2", "c", "a1"), ("b2", "b", None), ("c3", "c", "b2"), ("x", "z", None), ("a2", "a", "b1"), ("c4", "c", "gone")]
    got = {r.key: (r.ancestors, r.defect) for r in ancestry.resolve_chains(spark.createDataFrame(rows, "key string, kind string, parent string"), "key", "parent", "kind", order).collect()}
    assert got == {
        "a1": ([], None), "b1": (["a1"], None), "c1": (["b1", "a1"], None), "c2": (None, "wrong_type"), "b2": (None, "no_parent"), "c3": (None, "no_parent"), "x": (None, "wrong_type"), "a2": (None, "wrong_type"), "c4": (None, "missing_parent"),
    }
    assert ancestry.resolve_chains(spark.createDataFrame([], "key string, kind string, parent string"), "key", "parent", "kind", order).collect() == []


def test_full_run_is_merged(spark):
    artifacts = spark.range(50).select(F.col("id").alias("artifact_id"), *(F.lit(n).alias(c) for n, c in ((4, "parsed_record_count"), (3, "accepted_record_count"), (1, "skipped_record_count"))))
    records = spark.range(200).select((F.col("id") % 50).alias("artifact_id"), F.when(F.col("id") < 150, "part").otherwise("quarantine_part").alias("record_type"), (F.col("id") < 150).alias("accepted"), F.col("id").alias("part_id"), F.md5(F.col("id").cast("string")).alias("record_sha256"))
    parts = spark.range(150).select(F.col("id").alias("part_id"), F.md5(F.when(F.col("id") == 9, "0").otherwise(F.col("id").cast("string"))).alias("evidence_record_sha256"))
    columns = ["artifact_id", "record_type", "part_id", "record_sha256"]
    row = fullrun.verify_full_run(artifacts, records, parts, columns, 5).first()
    assert (row.artifact_count, row.record_count, row.accepted_count, row.artifacts_off, row.part_count, row.digest, row.missing_part) == (50, 200, 150, 0, 150, 1, 0)
    again = fullrun.verify_full_run(artifacts.orderBy(F.desc("artifact_id")), records.repartition(9), parts, columns, 7).first()
    assert again.manifest_sha256 == row.manifest_sha256
    changed = fullrun.verify_full_run(artifacts, records.withColumn("record_sha256", F.when(F.col("part_id") == 3, "x").otherwise(F.col("record_sha256"))), parts, columns, 5).first()
    assert changed.manifest_sha256 != row.manifest_sha256 and changed.digest == 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a, r = fullrun.stored_by(artifacts, "artifact_id", 5, "a"), fullrun.stored_by(records, "artifact_id", 5, "r")
        plan = fullrun.artifact_lines(a, r, columns)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_leaves_are_not_rewritten(spark, monkeypatch):
    """A thousand records below a chain of nine are written twice, however many rounds the chain takes."""
    kept, seen = ancestry.written, []

    def counted(df, name):
        out = kept(df, name)
        seen.append(out.count())
        return out

    monkeypatch.setattr(ancestry, "written", counted)
    rows = spark.range(1009).selectExpr("id AS k", "CASE WHEN id = 0 THEN NULL WHEN id < 9 THEN id - 1 ELSE 8 END AS up")
    got = {(r.k, r.root, r.depth) for r in ancestry.resolve_chains(rows, "k", "up").collect()}
    assert got == {(k, 0, min(k, 9)) for k in range(1009)}
    assert sum(seen) < 2 * 1009 + 100


def test_evidence_lines_are_taken_together_once(spark, sf_dir):
    """The fixtures of evidence read written lines; none of them takes the table's lines together again."""
    made = evidence_plans._tables(spark, sf_dir)
    assert all("lineitem" not in f for k in ("parts", "records", "artifacts", "receipts") for f in made[k].inputFiles())


def _plain_evidence(parts, records, order):
    """part_evidence() by resolve_chains() over all records."""
    chains = ancestry.resolve_chains(records, "key", "parent", "kind", order).select(F.col("key").alias("_key"), "ancestors", F.col("defect").alias("_chain"))
    mine = records.filter(F.col("accepted") & (F.col("kind") == order[-1])).groupBy("part_id").agg(F.count("*").alias("_n"), F.min(F.struct("key", "parent", "record_sha256", "source_url")).alias("r"))
    j = parts.join(mine, "part_id", "left").join(chains, F.col("r.key") == F.col("_key"), "left")
    off = [("r.key", "key", "key"), ("r.parent", "group_key", "parent"), ("r.record_sha256", "record_sha256", "payload"), ("r.source_url", "source_url", "url")]
    defect = F.coalesce(F.when(F.col("_n").isNull(), "no_record"), F.when(F.col("_n") > 1, "several_records"), *(F.when(~F.col(a).eqNullSafe(F.col(b)), name) for a, b, name in off), "_chain")
    return j.select("part_id", F.when(defect.isNull(), F.col("ancestors")).alias("ancestors"), defect.alias("defect"))


def test_part_evidence_on_shared_keys(spark):
    """Keys that several records have or point to, parents that are gone, of a wrong kind, null or in a circle, records without a key."""
    order = ("a", "b", "c")
    rows = [("a1", "a", None), ("b1", "b", "a1"), ("b2", "b", "gone"), ("b3", "b", "p1"), ("b4", "b", "b4"), ("s", "b", "a1"), ("n", "b", None), (None, "b", "a1"), ("z", "z", None), ("k", None, "a1")]
    leaves = [(1, "p1", "b1"), (2, "p2", "b2"), (3, "p3", "b3"), (4, "p4", "b4"), (5, "p5", "a1"), (6, "p6", "lost"), (7, "p7", None), (8, "s", "b1"), (9, "p9", "p1"), (10, "p10", "p10"), (11, None, "b1"), (12, "t", "b1"), (13, "t", "b2"), (14, "p14", "n"), (15, "p15", "b1"), (15, "p16", "b1"), (16, "p17", "z"), (17, "p18", "k"), (18, "p19", "s"), (19, "p20", "b1"), (20, "p21", "b1")]
    schema = "key string, kind string, parent string, accepted boolean, part_id long, record_sha256 string, source_url string"
    records = spark.createDataFrame([(*r, False, None, None, None) for r in rows] + [(k, "c", up, i != 19, i, f"h{i}", "u") for i, k, up in leaves], schema)
    parts = spark.createDataFrame([(i, k, up, "x" if i == 20 else f"h{i}", "u") for i, k, up in leaves] + [(99, "p99", "b1", "h", "u")], "part_id long, key string, group_key string, record_sha256 string, source_url string")
    for o in (order, ("c",), ("b", "c")):
        got, want = (sorted(map(repr, f(parts, records, o).collect())) for f in (ancestry.part_evidence, _plain_evidence))
        assert got == want
    found = {(r.part_id, r.defect) for r in ancestry.part_evidence(parts, records, order).collect()}
    assert {(1, None), (2, "missing_parent"), (5, "wrong_type"), (6, "missing_parent"), (7, "no_parent"), (9, "wrong_type"), (15, "several_records"), (19, "no_record"), (20, "payload"), (99, "no_record")} <= found


def test_parts_do_not_follow_chains_one_by_one(spark, monkeypatch):
    """A thousand parts below a chain of five are compared and take over their parent's chain; only the chain's records are written."""
    kept, seen = ancestry.written, []

    def counted(df, name):
        out = kept(df, name)
        seen.append(out.count())
        return out

    monkeypatch.setattr(ancestry, "written", counted)
    above = spark.range(5).selectExpr("concat('k', id) AS key", "concat('t', id) AS kind", "CASE WHEN id > 0 THEN concat('k', id - 1) END AS parent", "false AS accepted", "CAST(NULL AS BIGINT) AS part_id", "CAST(NULL AS STRING) AS record_sha256", "'u' AS source_url")
    leaves = spark.range(1000).selectExpr("concat('p', id) AS key", "'t5' AS kind", "'k4' AS parent", "true AS accepted", "id AS part_id", "md5(CAST(id AS STRING)) AS record_sha256", "'u' AS source_url")
    parts = leaves.select("part_id", "key", F.col("parent").alias("group_key"), "record_sha256", "source_url")
    got = ancestry.part_evidence(parts, above.unionByName(leaves), [f"t{i}" for i in range(6)]).collect()
    assert len(got) == 1000 and {(tuple(r.ancestors), r.defect) for r in got} == {(("k4", "k3", "k2", "k1", "k0"), None)}
    assert sum(seen) < 100


def test_parts_and_records_meet_without_a_shuffle(spark, sf_dir):
    """Lines are taken together once; parts and their records are made of them where they are stored, by the key they meet by."""
    parts, records = lineage_plans._of_lines(spark, sf_dir, lineage_plans._PARTS, lineage_plans._RECORDS)
    assert not any("lineitem" in f for df in (parts, records) for f in df.inputFiles())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = parts.join(records.filter("accepted and kind = 'part'").groupBy("part_id").agg(F.min("key")), "part_id", "left")
        plan = met._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
